"""Result tables of a stream: plain Parquet in partition folders, of which a batch replaces those it touches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.upsert import INCREMENT, MODES, OVERWRITE, REPLACE_GROUP
from clickloom.shared import exists, names_in

BUCKET = "bucket"
# A folder is written by several tasks, by a hash of the keys, where there are fewer folders than tasks.
PIECE = "_piece"
# What a row of an incremented table says of its last change: the count before it, and the batch that made it.
MARKS = T.StructType().add("before", "long").add("query", "string").add("batch", "long")


class Run(NamedTuple):
    """A batch: the id of its streaming query, which a new checkpoint changes and a restart does not, and its number."""

    query: str
    batch: int

    @classmethod
    def of(cls, spark: SparkSession, batch_id: int) -> Run:
        """The batch that a ``foreachBatch`` function was called with."""
        return cls(spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none", batch_id)

    def made(self) -> Column:
        """Whether a row was last changed by this batch."""
        return F.col("query").eqNullSafe(F.lit(self.query)) & F.col("batch").eqNullSafe(F.lit(self.batch))


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nulls).where(F.lit(False))


class KeyedTable:
    """A table with one row per ``keys``, in folders by the columns ``by``.

    ``write`` reads the folders that have keys of the batch, merges, and replaces these folders (Spark's
    dynamic partition overwrite); no other file is read or written. A retried batch leaves what it left before:

    * ``increment``: ``clickCount`` is added; a row keeps its count from before its last batch and that
      batch's name, so the same batch begins from there again;
    * ``overwrite``: a row takes the place of the one with equal keys;
    * ``replace_group``: the rows of the groups ``by`` in the batch go and the new ones come; nothing is read.

    The first of ``by`` is ``date`` where rows are merged; with ``buckets`` a hash of ``keys`` (of those in ``spread``, if
    given) makes folders below the others. A group whose first value is an empty text comes back as null, as
    Spark's folder names have it. Spark moves finished folders to their places one by one when the job is committed,
    so a reader may see some of them moved, and a driver lost in that moment leaves the batch to be written again.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        mode: str = INCREMENT,
        by: Sequence[str] = ("date",),
        buckets: int = 0,
        spread: Sequence[str] = (),
    ) -> None:
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.mode = mode
        self.by = [*by, BUCKET] if buckets else list(by)
        self.buckets = buckets
        self.spread = list(spread) or self.keys
        marks = MARKS.fields if mode == INCREMENT else []
        place = [T.StructField(BUCKET, T.IntegerType())] if buckets else []
        self._stored = T.StructType([*schema.fields, *marks, *place])

    def latest(self, spark: SparkSession) -> DataFrame:
        """The whole table, as far as batches are written; empty before the first."""
        if not exists(spark, self.path):
            return _empty(spark, self.schema)
        return spark.read.schema(self._stored).parquet(self.path).select(*self.schema.names)

    def write(self, updates: DataFrame, run: Run) -> list[Row]:
        """Merge the rows of a batch into the table; the places (values of ``by``) of the folders it touched.

        ``updates`` has a row per key and is evaluated several times: persist it.
        """
        spark = updates.sparkSession
        updates = self._placed(updates)
        touched = updates.select(*self.by).distinct().collect()
        if touched:
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            piece = F.pmod(F.xxhash64(*self.keys), F.lit(-(-n // len(touched)))).alias(PIECE)
            spread = lambda df: df.select("*", piece).repartition(n, *self.by, PIECE)
            if self.mode == REPLACE_GROUP:
                rows = spread(updates)
            else:  # merged where it is written from
                rows = self._merged(spread(self._both(self.among(spark, touched), updates)), run)
            writer = rows.drop(PIECE).write.partitionBy(*self.by)
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return touched

    def among(self, spark: SparkSession, places: Sequence[Row]) -> DataFrame:
        """The stored rows in these folders; folders of other dates are not even listed."""
        if self.by[0] == "date":
            there = set(names_in(spark, self.path)) if places else set()
            folders = [f"{self.path}/{name}" for name in sorted({f"date={place[0]}" for place in places} & there)]
        else:
            folders = [self.path] if places and exists(spark, self.path) else []
        if not folders:
            return _empty(spark, self._stored)
        rows = spark.read.schema(self._stored).option("basePath", self.path).parquet(*folders)
        last: dict[tuple, list] = {}
        for place in places:
            last.setdefault(tuple(place[:-1]), []).append(place[-1])

        def inside(first: tuple, values: list) -> Column:
            known = [v for v in values if v is not None]
            own = F.col(self.by[-1]).isin(known) if known else F.lit(False)
            own = own | F.col(self.by[-1]).isNull() if len(known) < len(values) else own
            return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(self.by, first)], own)

        return rows.where(reduce(lambda a, b: a | b, [inside(*item) for item in last.items()]))

    def _placed(self, df: DataFrame) -> DataFrame:
        df = df.select(*[c for c in self.schema.names if c in df.columns])
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.spread), F.lit(self.buckets)).cast("int")) if self.buckets else df

    def _both(self, stored: DataFrame, updates: DataFrame) -> DataFrame:
        """The stored rows, and those of the batch with their count as ``fresh``."""
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._stored.fields if f.name not in updates.columns]
        came = updates.select("*", *nothing).withColumns({"fresh": F.col("clickCount"), "clickCount": F.lit(None).cast("long")})
        return stored.withColumn("fresh", F.lit(None).cast("long")).unionByName(came)

    def _merged(self, rows: DataFrame, run: Run) -> DataFrame:
        groups = [*self.keys, *[c for c in self.by if c not in self.keys], PIECE]
        others = [c for c in rows.columns if c not in groups]
        rows = rows.groupBy(*groups).agg(*[F.max(c).alias(c) for c in others])
        added, value = F.col("fresh").isNotNull(), F.col("clickCount")
        if self.mode == OVERWRITE:
            return rows.withColumn("clickCount", F.coalesce("fresh", "clickCount")).drop("fresh")
        again = F.when(run.made(), F.col("before")).otherwise(F.coalesce("clickCount", F.lit(0)))
        marked = rows.withColumn("before", F.when(added, again).otherwise(F.col("before")))
        marked = marked.withColumn("clickCount", F.when(added, F.col("before") + F.col("fresh")).otherwise(value))
        for name, mark in (("query", run.query), ("batch", run.batch)):
            marked = marked.withColumn(name, F.when(added, F.lit(mark)).otherwise(F.col(name)))
        return marked.drop("fresh")


class ListedOnce:
    """An append-only table: each batch adds its rows in a folder of its own, which the same batch replaces if it is
    run again."""

    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path = path
        self.schema = schema
        self._stored = T.StructType([*schema.fields, *(f for f in MARKS.fields if f.name != "before")])

    def _all(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.path):
            return _empty(spark, self._stored)
        return spark.read.schema(self._stored).parquet(self.path)

    def write(self, rows: DataFrame, run: Run) -> None:
        """Add ``rows``; without any there is no folder."""
        marked = rows.select(*self.schema.names, F.lit(run.query).alias("query"), F.lit(run.batch).cast("long").alias("batch"))
        writer = marked.coalesce(1).write.partitionBy("query", "batch").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def before(self, spark: SparkSession, run: Run) -> DataFrame:
        """What was listed before this batch: all but what a first try of it has added. Read from the files anew for each batch."""
        return self._all(spark).where(~run.made()).select(*self.schema.names).distinct()

    def latest(self, spark: SparkSession) -> DataFrame:
        """The distinct rows of all batches."""
        return self._all(spark).select(*self.schema.names).distinct()
