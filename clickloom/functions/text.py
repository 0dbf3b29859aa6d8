"""String and number column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.times import as_column


def round_half_up(value: Column | str, scale: int = 2) -> Column:
    """Decimal rounding, halves away from zero."""
    return F.round(as_column(value), scale)


def is_empty(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit("")) == ""


def is_not_empty(value: Column | str) -> Column:
    return ~is_empty(value)


def trim_comma(value: Column | str) -> Column:
    """Drop one comma at each edge."""
    return F.regexp_replace(as_column(value), "^,|,$", "")


def pad_two(value: Column | str) -> Column:
    """Put a zero before anything that is not two characters long."""
    value = as_column(value)
    return F.when(F.length(value) == 2, value).otherwise(F.concat(F.lit("0"), value))


def kv_get(record: Column | str, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in a ``k=v|k=v`` record; null where absent or empty."""
    sep = re.escape(delimiter)
    pattern = rf"(?:^|{sep}){re.escape(field)}=((?:(?!{sep})[^=])+)=*(?:{sep}|$)"
    return F.nullif(F.regexp_extract(as_column(record), pattern, 1), F.lit(""))


def kv_set(record: Column | str, field: str, value: Column | str, delimiter: str = "|") -> Column:
    """Replace the value ``field`` has in a ``k=v|k=v`` record; a record without the
    field stays as it is."""
    value = F.lit(value) if isinstance(value, str) else value
    pairs = F.split(as_column(record), re.escape(delimiter))
    replaced = F.transform(
        pairs,
        lambda pair: F.when(
            F.split_part(pair, F.lit("="), F.lit(1)) == field, F.concat(F.lit(f"{field}="), value)
        ).otherwise(pair),
    )
    return F.array_join(replaced, delimiter)


def id_list(value: Column | str) -> Column:
    """Comma list of ids to an array; parts that are no number are dropped."""
    ids = F.transform(
        F.split(as_column(value), ","), lambda part: F.trim(part).try_cast("bigint")
    )
    return F.filter(ids, lambda part: part.isNotNull())


def json_field(document: Column | str, field: str) -> Column:
    """Top-level field of a JSON string, as text; null for text that is no JSON. Dots and brackets
    in ``field`` are part of the name; a name with a single quote cannot be asked for."""
    return F.get_json_object(as_column(document), f"$['{field}']")


def join_id_name(id_: Column | str, name: Column | str, separator: str = ":") -> Column:
    """``id:name``."""
    return F.concat_ws(separator, as_column(id_).cast("string"), as_column(name))


def group_concat_distinct(value: Column | str, separator: str = ",") -> Column:
    """Aggregate: the distinct values in ascending order, joined; null for none.

    ``collect_set`` merges on the map side, so what is shuffled per group and task is
    its distinct values and not its rows.
    """
    joined = F.array_join(F.array_sort(F.collect_set(as_column(value))), separator)
    return F.nullif(joined, F.lit(""))
