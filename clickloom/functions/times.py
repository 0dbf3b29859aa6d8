"""Date and time column expressions over time strings or timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
TIME = "yyyy-MM-dd HH:mm:ss"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"
DATE_HOUR = "yyyy-MM-dd_HH"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(value: Column | str) -> Column:
    """Time string to ``timestamp_ntz``; the hour may lack its leading zero, and
    text that is no time gives null."""
    return as_column(value).try_cast("timestamp_ntz")


def parse_date_key(value: Column | str) -> Column:
    """``yyyyMMdd`` to a date."""
    return F.to_date(as_column(value), DATE_KEY)


def before(first: Column | str, second: Column | str) -> Column:
    return parse_time(first) < parse_time(second)


def after(first: Column | str, second: Column | str) -> Column:
    return parse_time(first) > parse_time(second)


def minus(first: Column | str, second: Column | str) -> Column:
    """Whole seconds from ``second`` to ``first``."""
    return F.timestamp_diff("SECOND", parse_time(second), parse_time(first))


def format_date(value: Column | str) -> Column:
    return F.date_format(parse_time(value), DATE)


def format_time(value: Column | str) -> Column:
    return F.date_format(parse_time(value), TIME)


def format_date_key(value: Column | str) -> Column:
    return F.date_format(parse_time(value), DATE_KEY)


def format_minute(value: Column | str) -> Column:
    return F.date_format(parse_time(value), MINUTE_KEY)


def date_hour(value: Column | str) -> Column:
    """Hour bucket ``yyyy-MM-dd_HH``."""
    return F.date_format(parse_time(value), DATE_HOUR)


def today() -> Column:
    return F.date_format(F.current_date(), DATE)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE)


def minute_key_parts(key: Column | str) -> tuple[Column, Column, Column]:
    """Minute key ``yyyyMMddHHmm`` to its date, hour and minute strings."""
    key = as_column(key)
    date = F.concat_ws(
        "-", F.substring(key, 1, 4), F.substring(key, 5, 2), F.substring(key, 7, 2)
    )
    return date, F.substring(key, 9, 2), F.substring(key, 11, 2)
