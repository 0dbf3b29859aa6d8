"""Filter predicates. Each passes every row when its parameter is missing, and
fails a row whose value is missing when it is not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.times import as_column
from clickloom.params import split_list
from clickloom.schemas import ABSENT_ID


def _strict(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def in_range(value: Column | str, low: int | None, high: int | None) -> Column:
    """Inclusive range; no filter unless both bounds are given."""
    if low is None or high is None:
        return F.lit(True)
    return _strict(as_column(value).between(low, high))


def one_of(value: Column | str, wanted: str | None) -> Column:
    """A single value is in the comma list ``wanted``."""
    options = split_list(wanted)
    if not options:
        return F.lit(True)
    value = as_column(value).cast("string")
    return _strict(value.isin(options) & (value != str(ABSENT_ID)))


def any_of(values: Column | str, wanted: str | None) -> Column:
    """A comma list shares a value with the comma list ``wanted``."""
    options = split_list(wanted)
    if not options:
        return F.lit(True)
    values = as_column(values)
    shared = F.arrays_overlap(F.split(values, ","), F.array(*[F.lit(o) for o in options]))
    return _strict(shared & (values != str(ABSENT_ID)))


def equals(value: Column | str, wanted: str | None) -> Column:
    if not wanted:
        return F.lit(True)
    return _strict(as_column(value) == wanted)


def clicked() -> Column:
    """The action is a click on a category."""
    return _strict(F.col("click_category_id") != ABSENT_ID)


def ordered() -> Column:
    return F.col("order_category_ids").isNotNull()


def paid() -> Column:
    return F.col("pay_category_ids").isNotNull()
