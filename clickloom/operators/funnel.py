"""Page-to-page conversion along a target flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions.text import round_half_up
from clickloom.functions.times import parse_time
from clickloom.operators.skew import heavy_keys, parts_for
from clickloom.shared import materialize

def _pair(first: Column, second: Column) -> Column:
    return F.concat_ws("_", first.cast("string"), second.cast("string"))


def flow_pairs(flow: str) -> list[str]:
    """``"1,2,3"`` to ``["1_2", "2_3"]``."""
    pages = flow.split(",")
    return [f"{a}_{b}" for a, b in zip(pages, pages[1:])]


def split_flow(flows: DataFrame, column: str) -> DataFrame:
    """Steps ``(step, pair)``, numbered from 1, of each flow (a comma list of pages)."""
    pages = F.split(column, ",")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(pages) - 2),
        lambda i: _pair(F.get(pages, i), F.get(pages, i + 1)),
    )
    steps = flows.where(F.size(pages) > 1).select(F.posexplode(pairs).alias("step", "pair"))
    return steps.withColumn("step", F.col("step") + 1)


def flow_steps(spark: SparkSession, flow: str) -> DataFrame:
    """The steps ``(step, pair)`` of one flow."""
    return split_flow(spark.range(1).select(F.lit(flow).alias("flow")), "flow")


def page_pairs(
    actions: DataFrame,
    tie: str | None = None,
    newest_first: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Consecutive pages of each session in time order: ``(session_id, pair)``.

    Equal times are ordered by ``tie`` and then by page. With ``newest_first`` the pages are read
    in falling time order, ties included.

    A session is paired by one window. Sessions with more than ``1/parts`` of the actions, which are counted
    first, are sorted by ranges of (session, time, tie, page) instead, so that even one second of
    one session is cut; the ranges are stored, paired within, and stitched by the first and last page
    of each. What one task sees of a session in that step are two rows per range.
    """
    time = parse_time("action_time")
    keys = ["_time"] + ([tie] if tie else []) + ["page_id"]
    way = F.desc if newest_first else F.asc
    order = [way(k) for k in keys]
    rows = actions.select("session_id", "page_id", time.alias("_time"), *([tie] if tie else []))
    next_page = F.lead("page_id").over(Window.partitionBy("session_id").orderBy(*order))
    last = F.lead(F.lit(1)).over(Window.partitionBy("session_id").orderBy(*order)).isNull()
    pair = _pair(F.col("page_id"), F.col("_next")).alias("pair")

    heavy = heavy_keys(actions, "session_id", parts=parts).select("session_id")
    heavy = heavy.unionAll(_crowded_null(actions, parts))
    if heavy.isEmpty():
        paired = rows.withColumn("_next", next_page).withColumn("_end", last)
        return paired.where(~F.col("_end")).select("session_id", pair)
    hot = F.broadcast(heavy.select(F.col("session_id").alias("_hot")))
    same = F.col("session_id").eqNullSafe(F.col("_hot"))
    light = rows.join(hot, same, "left_anti").withColumn("_next", next_page).withColumn("_end", last)

    # Stored, because the number of a range means nothing in another evaluation.
    ranges = int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.join(hot, same, "left_semi").repartitionByRange(ranges, "session_id", *order)
    cut = materialize(cut.withColumn("_range", F.spark_partition_id()), "hot-sessions")
    within = Window.partitionBy("session_id", "_range").orderBy(*order)
    seen = (
        cut.withColumn("_next", F.lead("page_id").over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
        .withColumn("_last", F.lead(F.lit(1)).over(within).isNull())
    )
    inside = seen.where(~F.col("_last"))
    across = Window.partitionBy("session_id").orderBy("_range", F.desc("_first"))
    # A range with one row of the session is its first and last at once.
    edges = (
        seen.where(F.col("_first") | F.col("_last"))
        .withColumn("_next", F.lead("page_id").over(across))
        .withColumn("_more", F.lead(F.lit(1)).over(across).isNotNull())
        .where(F.col("_last") & F.col("_more"))
    )
    found = (light.where(~F.col("_end")), inside, edges)
    return reduce(DataFrame.unionAll, [part.select("session_id", pair) for part in found])


def _crowded_null(actions: DataFrame, parts: int | None) -> DataFrame:
    """One row, a null, if the actions without a session are as many as a heavy session's."""
    parts = parts or parts_for(actions.sparkSession)
    counted = actions.agg(F.count("*").alias("n"), F.count_if(F.col("session_id").isNull()).alias("null"))
    kind = actions.schema["session_id"].dataType
    return counted.where(F.col("null") * parts > F.col("n")).select(F.lit(None).cast(kind).alias("session_id"))


def pair_counts(pairs: DataFrame, flow: str) -> DataFrame:
    """How often each pair of the flow occurs: ``(pair, pv)``."""
    wanted = pairs.where(F.col("pair").isin(flow_pairs(flow)))
    return wanted.groupBy("pair").agg(F.count(F.lit(1)).alias("pv"))


def start_page_views(actions: DataFrame, flow: str) -> DataFrame:
    """One row: views of the flow's first page."""
    return actions.where(F.col("page_id") == int(flow.split(",")[0])).agg(
        F.count(F.lit(1)).alias("start_pv")
    )


def conversion(
    counts: DataFrame, start: DataFrame, flow: str, task_id: str, rounded: bool = True
) -> DataFrame:
    """Rate of each step over the step before it; the first over the start page's views.

    A pair that never occurs has rate 0, and a rate over zero is null. The window has no
    key because the relation has one row per step of the flow.
    """
    steps = flow_steps(counts.sparkSession, flow).join(counts, "pair", "left")
    pv = F.coalesce(F.col("pv"), F.lit(0))
    before = F.lag(pv).over(Window.orderBy("step"))
    rate = F.try_divide(pv.cast("double"), F.coalesce(before, start.select("start_pv").scalar()))
    return steps.select(
        F.lit(task_id).alias("taskid"),
        F.col("step"),
        F.col("pair").alias("targetPage2Page"),
        (round_half_up(rate) if rounded else rate).alias("rate"),
    )


def conversion_rows(rates: DataFrame) -> DataFrame:
    """Result rows; the rate is stored as text."""
    return rates.select("taskid", "targetPage2Page", F.col("rate").cast("string").alias("convertRate"))


def conversion_text(rates: DataFrame) -> DataFrame:
    """All steps as one ``pair=rate|pair=rate`` row."""
    item = F.concat_ws("=", "targetPage2Page", F.coalesce(F.col("rate").cast("string"), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("step", item.alias("item"))))
    return rates.groupBy("taskid").agg(F.array_join(ordered["item"], "|").alias("convertRate"))
