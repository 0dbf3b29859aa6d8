"""The ad click stream: blacklist loop, running statistics, click trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.times import DATE, MINUTE_KEY, minute_key_parts
from clickloom.operators import ads
from clickloom.operators.upsert import OVERWRITE, REPLACE_GROUP
from clickloom.streaming.tables import KeyedTable, ListedOnce, Run

THRESHOLD = 100
# Folders of a day's user counts.
BUCKETS = 4


class BlacklistLoop:
    """One micro-batch of the feedback loop.

    Clicks of users listed in earlier batches are dropped; the rest is added to the
    counts; users whose count, this batch included, reaches the threshold are listed from
    the next batch on; statistics and top ads follow the same clicks.

    Clicks are counted by all keys at once before anything is joined, so a user with most
    of a batch's clicks is left with a row per place and ad. A batch that failed between two of its
    tables is run again as it was: the blacklist it sees is that of before, and counts begin from before.
    """

    def __init__(
        self,
        folder: str,
        threshold: int = THRESHOLD,
        top_n: int = 3,
        top_partition: Sequence[str] = tuple(ads.PROVINCE_KEYS),
        buckets: int = BUCKETS,
    ) -> None:
        self.threshold = threshold
        self.top_n = top_n
        self.top_partition = list(top_partition)
        self.blacklist = ListedOnce(f"{folder}/ad_blacklist", schemas.AD_BLACKLIST)
        self.user_counts = KeyedTable(
            f"{folder}/ad_user_click_count", schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS, buckets=buckets, spread=["userid"]
        )
        self.stats = KeyedTable(f"{folder}/ad_stat", schemas.AD_STAT, ads.STAT_KEYS)
        self.top = KeyedTable(
            f"{folder}/ad_province_top3", schemas.AD_PROVINCE_TOP3, [*self.top_partition, "adid"], REPLACE_GROUP, self.top_partition
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = Run.of(spark, batch_id)
        counted = ads.count_by(ads.with_date(batch), ["date", "province", "city", "userid", "adid"])
        kept = ads.drop_listed(counted, self.blacklist.before(spark, run)).persist()
        try:
            places = self.user_counts.write(ads.sum_by(kept, ads.USER_KEYS), run)
            counts = self.user_counts.among(spark, places)
            places = self.stats.write(ads.sum_by(kept, ads.STAT_KEYS), run)
            dated = "date" in self.top_partition
            self._rank(self.stats.among(spark, places) if dated else self.stats.latest(spark), kept, run)
            # Last, because Spark forgets what is kept from a table's files when they change.
            self.blacklist.write(ads.users_over(counts.where(run.made()), self.threshold), run)
        finally:
            kept.unpersist()

    def _rank(self, stats: DataFrame, kept: DataFrame, run: Run) -> None:
        groups = kept.select(*self.top_partition).distinct()
        now = stats.join(groups, self.top_partition, "left_semi")
        best = ads.top_ads(now, self.top_n, self.top_partition).persist()
        try:
            self.top.write(best, run)
        finally:
            best.unpersist()


class ClickTrend:
    """Adds the clicks of each batch to the counts per minute of event time and ad, however late they come; a batch
    replaces the days it has clicks of."""

    def __init__(self, folder: str) -> None:
        self.trend = KeyedTable(f"{folder}/ad_click_trend", schemas.AD_CLICK_TREND, ads.TREND_KEYS)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        counted = ads.minute_counts(batch).persist()
        try:
            self.trend.write(counted, Run.of(batch.sparkSession, batch_id))
        finally:
            counted.unpersist()


class RunningCounts:
    """Clicks counted by ``keys`` in Spark's state store, and the table of these counts.

    ``running`` is a streaming aggregate in update mode: per key and span of arrival (``span``, by the clock that Spark notes for
    each batch and keeps for a batch run again) the count so far. The watermark is on the arrival, which never goes
    back: no click is too late, whatever its own time; and a span's counts leave the state when it is over, so
    the state holds the keys of one span. A late click is counted in the span it comes in, beside earlier
    counts of its key, and ``totals`` adds them up. The table has a folder per date and span, so a batch replaces only
    what arrived in the present span.
    """

    KEYS: Sequence[str] = ()
    SCHEMA: T.StructType

    def __init__(self, folder: str, span: str = "1 hour") -> None:
        self.span = span
        schema = T.StructType([*self.SCHEMA.fields, T.StructField("arrived", T.StringType())])
        self.table = KeyedTable(f"{folder}/counts", schema, [*self.KEYS, "arrived"], OVERWRITE, ["date", "arrived"])

    def grouping(self) -> list[Column]:
        """What is counted by, from the columns of a click."""
        raise NotImplementedError

    def named(self, counts: DataFrame) -> DataFrame:
        """The key columns, from those of ``grouping``."""
        return counts

    def running(self, clicks: DataFrame) -> DataFrame:
        timed = clicks.select(*self.grouping(), F.current_timestamp().alias("_at")).withWatermark("_at", "0 seconds")
        others = [c for c in timed.columns if c != "_at"]
        counts = timed.groupBy(F.window("_at", self.span).alias("_span"), *others).agg(F.count(F.lit(1)).alias("clickCount"))
        arrived = F.date_format(F.col("_span.start"), "yyyyMMdd-HHmmss").alias("arrived")
        return self.named(counts.select(arrived, *others, "clickCount"))

    def __call__(self, updates: DataFrame, batch_id: int) -> None:
        updates = updates.persist()  # else the aggregate would run again for each use
        try:
            self.store(updates, Run.of(updates.sparkSession, batch_id))
        finally:
            updates.unpersist()

    def store(self, updates: DataFrame, run: Run) -> list[Row]:
        """Put the counts that have changed into the table; the places of the folders they are in."""
        return self.table.write(updates, run)

    def totals(self, spark: SparkSession) -> DataFrame:
        """The counts of all spans."""
        return ads.sum_by(self.table.latest(spark), self.KEYS)


class RunningStats(RunningCounts):
    """Clicks per date, province, city and ad, and the top ads of the dates and provinces that clicks came for."""

    KEYS, SCHEMA = ads.STAT_KEYS, schemas.AD_STAT

    def __init__(self, folder: str, span: str = "1 hour", top_n: int = 3) -> None:
        super().__init__(folder, span)
        self.top_n = top_n
        self.top = KeyedTable(
            f"{folder}/ad_province_top3", schemas.AD_PROVINCE_TOP3, [*ads.PROVINCE_KEYS, "adid"], REPLACE_GROUP, ads.PROVINCE_KEYS
        )

    def grouping(self) -> list[Column]:
        return [F.date_format("ts", DATE).alias("date"), F.col("province"), F.col("city"), F.col("adid")]

    def store(self, updates: DataFrame, run: Run) -> list[Row]:
        places = super().store(updates, run)
        if not places:
            return places
        groups = updates.select(*ads.PROVINCE_KEYS).distinct()
        dates = sorted({place["date"] for place in places})
        stats = self.table.latest(updates.sparkSession).where(F.col("date").isin(dates))  # of all spans
        best = ads.top_ads(stats.join(groups, ads.PROVINCE_KEYS, "left_semi"), self.top_n).persist()
        try:
            self.top.write(best, run)
        finally:
            best.unpersist()
        return places


class RunningTrend(RunningCounts):
    """Clicks per minute of event time and ad."""

    KEYS, SCHEMA = ads.TREND_KEYS, schemas.AD_CLICK_TREND

    def grouping(self) -> list[Column]:
        return [F.date_trunc("minute", "ts").alias("_minute"), F.col("adid")]

    def named(self, counts: DataFrame) -> DataFrame:
        parts = minute_key_parts(F.date_format("_minute", MINUTE_KEY))
        return counts.withColumns(dict(zip(("date", "hour", "minute"), parts))).drop("_minute")


class RunningPanes(RunningCounts):
    """Clicks per pane of ``seconds`` and ad, of which sliding windows are made (``ads.slide_panes``): a click is counted once,
    not once for each window it falls in."""

    KEYS, SCHEMA = ["date", "pane", "adid"], schemas.AD_PANES

    def __init__(self, folder: str, seconds: int, span: str = "1 hour") -> None:
        super().__init__(folder, span)
        self.seconds = seconds

    def grouping(self) -> list[Column]:
        at = F.unix_seconds("ts")
        return [F.timestamp_seconds(at - F.pmod(at, F.lit(self.seconds))).alias("pane"), F.col("adid")]

    def named(self, counts: DataFrame) -> DataFrame:
        return counts.withColumn("date", F.date_format("pane", DATE))


def closed_windows(clicks: DataFrame, length: int, slide: int, late: str = "1 minute") -> DataFrame:
    """A stream of the sliding windows that are over, each once, ``(start, end, adid, clickCount)``; for append mode.

    Two aggregates in a chain, panes and then windows over the panes' time. A window is over when a click ``late`` after its end
    has come; clicks that are later than that are in no window here, so keep ``RunningPanes`` where all must count.
    """
    pane = F.window("ts", f"{ads.pane_seconds(length, slide)} seconds").alias("pane")
    panes = clicks.withWatermark("ts", late).groupBy(pane, "adid").agg(F.count(F.lit(1)).alias("clickCount"))
    window = F.window(F.window_time("pane"), f"{length} seconds", f"{slide} seconds").alias("w")
    counted = panes.groupBy(window, "adid").agg(F.sum("clickCount").alias("clickCount"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "adid", "clickCount")
