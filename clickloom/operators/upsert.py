"""Keyed updates of a result table, as pure DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INCREMENT = "increment"
OVERWRITE = "overwrite"
REPLACE_GROUP = "replace_group"
MODES = (INCREMENT, OVERWRITE, REPLACE_GROUP)


def upsert(
    existing: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str, value: str = "clickCount"
) -> DataFrame:
    """``existing`` after ``updates``.

    * ``increment``: ``value`` is added to that of the row with equal keys;
    * ``overwrite``: a row replaces the one with equal keys (``updates`` has one per key);
    * ``replace_group``: ``keys`` name a group; the rows of every group in ``updates`` go,
      and its rows come.
    """
    keys = list(keys)
    if mode == INCREMENT:
        return existing.unionByName(updates).groupBy(*keys).agg(F.sum(value).alias(value))
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    touched = updates.select(*keys)
    if mode == REPLACE_GROUP:
        touched = touched.distinct()
    return existing.join(touched, keys, "left_anti").unionByName(updates)


def new_rows(existing: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct ``rows`` whose keys ``existing`` lacks: what an insert-only sink adds."""
    return rows.dropDuplicates(list(keys)).join(
        existing.select(*keys), list(keys), "left_anti"
    )

