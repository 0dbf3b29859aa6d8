"""Reproducible session sample, stratified by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.times import DATE, format_time
from clickloom.operators.sessions import aggregate_sessions
from clickloom.operators.skew import top_per_group


def with_hour(sessions: DataFrame) -> DataFrame:
    """Add the date and hour the session starts in."""
    return sessions.withColumn("date", F.date_format("start_time", DATE)).withColumn(
        "hour", F.date_format("start_time", "HH")
    )


def hour_quota(sessions: DataFrame, total: int = 100) -> DataFrame:
    """Sessions to draw per date and hour.

    Days share ``total`` equally, hours share their day's part by their number of
    sessions; both divisions round down. One row per hour of the date range.
    """
    counts = with_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count"))
    days = counts.agg(F.count_distinct("date")).scalar()
    day = Window.partitionBy("date")
    quota = F.floor(
        F.col("hour_count") / F.sum("hour_count").over(day).cast("double") * F.col("day_quota")
    )
    return (
        counts.withColumn("day_quota", F.floor(F.lit(total) / days))
        .withColumn("day_count", F.sum("hour_count").over(day))
        .withColumn("quota", F.least(quota, F.col("hour_count")))
    )


def sample_sessions(sessions: DataFrame, total: int = 100, seed: str = "42") -> DataFrame:
    """``(session_id, start_time, date, hour)``: each hour's quota, in the order of ``md5(session_id || seed)``.

    No hour's quota exceeds ``total``, so that many rows per hour and task are all that
    is shuffled, however many sessions an hour has.
    """
    starts = with_hour(sessions.select("session_id", "start_time"))
    drawn = top_per_group(
        starts.withColumn("_draw", F.md5(F.concat(F.col("session_id"), F.lit(seed)))),
        ["date", "hour"],
        [F.col("_draw"), F.col("session_id")],
        total,
        "_rn",
    )
    quota = hour_quota(sessions, total).select("date", "hour", "quota")
    return (
        drawn.join(quota, ["date", "hour"])
        .where(F.col("_rn") <= F.col("quota"))
        .select("session_id", "start_time", "date", "hour")
    )


def sample_actions(actions: DataFrame, sample: DataFrame, total: int = 100) -> DataFrame:
    """Actions of the sampled sessions. The quotas add up to ``total`` at most, so the ids
    are broadcast unless that is large."""
    ids = sample.select("session_id")
    return actions.join(ids, "session_id", "left_semi")


def extract_rows(sampled: DataFrame, task_id: str) -> DataFrame:
    """Result rows of the sessions aggregated from ``sample_actions``: keywords and
    categories are gathered for sampled sessions alone."""
    return aggregate_sessions(sampled).select(
        F.lit(task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        format_time("start_time").alias("startTime"),
        F.col("search_keywords").alias("searchKeywords"),
        F.col("click_category_ids").alias("clickCategoryIds"),
    )
