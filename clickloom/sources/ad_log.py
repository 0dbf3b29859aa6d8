"""The ad click log: ``<epoch ms> <province> <city> <userid> <adid>`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shape of a line; whether its numbers fit is for the casts. Fields after the fifth are ignored.
LINE = r"^-?\d+ [^ ]+ [^ ]+ -?\d+ -?\d+( .*)?$"
# Milliseconds of which a time stamp holds the microseconds.
LAST_MS = (2**63 - 1) // 1000


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    group_prefix: str | None = None,
    start: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Lines of a Kafka topic, ``max_offsets`` in a batch at most.

    Offsets live in the query's checkpoint and are not committed to Kafka. Each query over the
    result reads the whole topic under a group of its own, whose name begins with ``group_prefix``.
    Needs the Kafka connector on the class path.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "groupIdPrefix": group_prefix,
        "maxOffsetsPerTrigger": max_offsets,
    }
    reader = spark.readStream.format("kafka").options(**{k: v for k, v in options.items() if v is not None})
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def _parsed(lines: DataFrame) -> DataFrame:
    """``value``, and ``click``: the line's columns, null for a line that is none."""
    field = F.split("value", " ")
    number = lambda i: F.get(field, F.lit(i)).try_cast("bigint")
    ms, user, ad = number(0), number(3), number(4)
    good = F.col("value").rlike(LINE) & ms.between(-LAST_MS, LAST_MS) & user.isNotNull() & ad.isNotNull()
    click = F.struct(
        F.timestamp_millis(ms).alias("ts"),
        F.get(field, F.lit(1)).alias("province"),
        F.get(field, F.lit(2)).alias("city"),
        user.alias("userid"),
        ad.alias("adid"),
    )
    return lines.select("value", F.when(good, click).alias("click"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines to columns; a line that is not of the form, or has a number that is no ``bigint``
    or no time, is left to ``rejected_lines``."""
    return _parsed(lines).where(F.col("click").isNotNull()).select("click.*")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_lines`` leaves out, as they are."""
    return _parsed(lines).where(F.col("click").isNull()).select("value")


def format_lines(clicks: DataFrame) -> DataFrame:
    """Clicks to lines, the inverse of ``parse_lines``."""
    return clicks.select(
        F.concat_ws(
            " ", F.unix_millis("ts").cast("string"), "province", "city",
            F.col("userid").cast("string"), F.col("adid").cast("string"),
        ).alias("value")
    )
