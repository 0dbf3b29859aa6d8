"""Ad click statistics, as functions of a (micro-)batch or of the whole history."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions.times import DATE, MINUTE_KEY, minute_key_parts
from clickloom.operators.skew import heavy_keys, salted_join, top_per_group

USER_KEYS = ["date", "userid", "adid"]
STAT_KEYS = ["date", "province", "city", "adid"]
PROVINCE_KEYS = ["date", "province"]
TREND_KEYS = ["date", "hour", "minute", "adid"]


def with_date(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("date", F.date_format("ts", DATE))


def count_by(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("clickCount"))


def sum_by(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("clickCount").alias("clickCount"))


def user_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per date, user and ad."""
    return count_by(with_date(clicks), USER_KEYS)


def stat_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per date, province, city and ad."""
    return count_by(with_date(clicks), STAT_KEYS)


def current_counts(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored count of each key, 0 where there is none."""
    found = keys.join(stored, USER_KEYS, "left")
    return found.withColumn("clickCount", F.coalesce("clickCount", F.lit(0)))


def users_over(counts: DataFrame, threshold: int) -> DataFrame:
    """Users with ``threshold`` or more clicks on one ad on one day."""
    return counts.where(F.col("clickCount") >= threshold).select("userid").distinct()


def drop_listed(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks (or click counts) of users not on the blacklist.

    Catalyst would move an anti-join below the counting, onto the single clicks of a hot
    user; it leaves a left join where it is.
    """
    listed = blacklist.select("userid", F.lit(True).alias("_listed"))
    joined = clicks.join(listed, "userid", "left")
    return joined.where(F.col("_listed").isNull()).drop("_listed")


def listing_batches(clicks: DataFrame, threshold: int) -> DataFrame:
    """``(userid, listed_in)``: the ``batch`` in which each user reaches the threshold.

    A user's clicks all count until the batch that lists them, so a running sum over the
    per-batch counts finds that batch without replaying the loop.
    """
    per_batch = count_by(with_date(clicks), ["batch", *USER_KEYS])
    so_far = F.sum("clickCount").over(Window.partitionBy(*USER_KEYS).orderBy("batch"))
    reached = per_batch.withColumn("so_far", so_far).where(F.col("so_far") >= threshold)
    return reached.groupBy("userid").agg(F.min("batch").alias("listed_in"))


def replay_blacklist(clicks: DataFrame, threshold: int, spread: Sequence[str]) -> DataFrame:
    """The clicks the blacklist loop lets through: a user's up to and including the batch
    that lists them. ``spread`` are columns that tell clicks of a user apart."""
    listed = listing_batches(clicks, threshold)
    joined = salted_join(clicks, listed, "userid", "left", heavy_keys(clicks, "userid"), spread)
    kept = F.col("listed_in").isNull() | (F.col("batch") <= F.col("listed_in"))
    return joined.where(kept).drop("listed_in")


def top_ads(
    stats: DataFrame, n: int = 3, partition: Sequence[str] = ("date", "province")
) -> DataFrame:
    """The ``n`` most-clicked ads of each date and province (or of each province over its
    dates' rows, with ``partition=["province"]``)."""
    counts = sum_by(stats, ["date", "province", "adid"])
    order = [F.desc("clickCount"), F.asc("adid"), F.asc("date")]
    return top_per_group(counts, list(partition), order, n).select(
        "date", "province", "adid", "clickCount"
    )


def minute_counts(clicks: DataFrame, ts: str = "ts") -> DataFrame:
    """Clicks per minute and ad, ``(date, hour, minute, adid)``."""
    counted = count_by(clicks.withColumn("_minute", F.date_trunc("minute", F.col(ts))), ["_minute", "adid"])
    return trend_rows(counted, "_minute")


def trend_rows(counts: DataFrame, minute: str) -> DataFrame:
    """Result rows of per-minute counts."""
    date, hour, minute = minute_key_parts(F.date_format(minute, MINUTE_KEY))
    return counts.select(
        date.alias("date"), hour.alias("hour"), minute.alias("minute"), "adid", "clickCount"
    )


def last_minutes(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks of the last ``minutes`` minutes, the newest click's included."""
    newest = F.date_trunc("minute", clicks.agg(F.max("ts")).scalar())
    return clicks.where(F.col("ts") >= newest - F.make_dt_interval(mins=F.lit(minutes - 1)))


def recent(trend: DataFrame, minutes: int = 60) -> DataFrame:
    """Rows of a stored trend in the last ``minutes`` minutes, its newest included. The bound is put on
    the date first, by which the trend is stored."""
    days = -(-minutes // 1440)
    newest_date = F.to_date(trend.agg(F.max("date")).scalar())
    trend = trend.where(F.col("date") >= F.date_format(F.date_sub(newest_date, days), DATE))
    text = F.concat("date", F.lit(" "), "hour", F.lit(":"), "minute", F.lit(":00"))
    timed = trend.withColumn("_at", text.cast("timestamp_ntz"))
    newest = timed.agg(F.max("_at")).scalar()
    return timed.where(F.timestamp_diff("MINUTE", F.col("_at"), newest) < minutes).drop("_at")


def pane_seconds(length: int, slide: int) -> int:
    """Widest pane of which both the window and its slide are multiples."""
    return math.gcd(length, slide)


def pane_counts(clicks: DataFrame, seconds: int) -> DataFrame:
    """Clicks per pane of time and ad: ``(pane, adid, clickCount)``."""
    pane = F.window("ts", f"{seconds} seconds")
    counted = clicks.groupBy(pane.alias("w"), "adid").agg(F.count(F.lit(1)).alias("clickCount"))
    return counted.select(F.col("w.start").alias("pane"), "adid", "clickCount")


def slide_panes(panes: DataFrame, length: int, slide: int) -> DataFrame:
    """Clicks per sliding window and ad, from pane counts.

    Only pane counts, not clicks, are repeated for each window that holds them.
    """
    window = F.window("pane", f"{length} seconds", f"{slide} seconds")
    counted = panes.groupBy(window.alias("w"), "adid").agg(F.sum("clickCount").alias("clickCount"))
    return counted.select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "adid", "clickCount"
    )


def sliding_counts(clicks: DataFrame, length: int, slide: int) -> DataFrame:
    """Clicks per sliding window of ``length`` seconds, every ``slide`` seconds, and ad."""
    return slide_panes(pane_counts(clicks, pane_seconds(length, slide)), length, slide)
