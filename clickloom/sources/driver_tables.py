"""Views that shape a folder of generic parquet tables into the input schemas.

``events`` becomes user actions and ad clicks, ``customer`` the users, ``part`` the
products, ``nation`` and ``region`` the cities.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.times import DATE
from clickloom.params import TaskParams

# Level of each area in these tables; any other is the lowest.
LEVELS = {"AFRICA": "A Level", "AMERICA": "A Level", "ASIA": "B Level", "EUROPE": "C Level"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _key() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _when(event_type: str, value: Column) -> Column:
    return F.when(F.col("event_type") == event_type, value)


def events_between(spark: SparkSession, folder: str, params: TaskParams) -> DataFrame:
    """Events of the date range. The bounds are put on the stored time stamp, which the
    scan can use, and not on a date made from it."""
    events = table(spark, folder, "events")
    if params.start_date:
        events = events.where(F.col("ts") >= F.lit(params.start_date).cast("timestamp_ntz"))
    if params.end_date:
        after = datetime.date.fromisoformat(params.end_date) + datetime.timedelta(days=1)
        events = events.where(F.col("ts") < F.lit(after.isoformat()).cast("timestamp_ntz"))
    return events


def actions(spark: SparkSession, folder: str, params: TaskParams = TaskParams()) -> DataFrame:
    """User actions; a session is one user's day."""
    k = F.col("k")
    date = F.date_format("ts", DATE)
    second = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return (
        events_between(spark, folder, params)
        .withColumn("k", _key())
        .select(
            date.alias("date"),
            "user_id",
            F.concat_ws("_", F.col("user_id").cast("string"), date).alias("session_id"),
            (k % 10).alias("page_id"),
            second.alias("action_time"),
            "event_id",
            _when("view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
            F.coalesce(_when("click", k % 20), F.lit(-1)).alias("click_category_id"),
            F.coalesce(_when("click", k), F.lit(-1)).alias("click_product_id"),
            _when(
                "signup", F.concat_ws(",", (k % 20).cast("string"), ((k + 7) % 20).cast("string"))
            ).alias("order_category_ids"),
            _when("signup", k.cast("string")).alias("order_product_ids"),
            _when("purchase", (k % 20).cast("string")).alias("pay_category_ids"),
            _when("purchase", k.cast("string")).alias("pay_product_ids"),
            (F.col("user_id") % 25).alias("city_id"),
        )
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (key % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (key % 2).cast("string"), F.lit("}")).alias(
            "extend_info"
        ),
    )


def cities(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def locate_clicks(events: DataFrame, located: DataFrame) -> DataFrame:
    """Ad clicks from events and the cities (``located``). Works on a stream as well."""
    return (
        events.withColumn("city_id", F.col("user_id") % 25)
        .join(located, "city_id")
        .select(
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("area").alias("province"),
            F.col("city_name").alias("city"),
            F.col("user_id").alias("userid"),
            (_key() % 20).alias("adid"),
            "event_id",
        )
    )


def ad_clicks(spark: SparkSession, folder: str, params: TaskParams = TaskParams()) -> DataFrame:
    return locate_clicks(events_between(spark, folder, params), cities(spark, folder))


def ad_click_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The ad clicks as a file stream over ``events``, which may be a file or a folder of files;
    ``max_files`` in a batch at most."""
    reader = spark.readStream.schema(table(spark, folder, "events").schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # As a pattern: a stream takes a single file only so.
    return locate_clicks(reader.parquet(f"{folder}/{{events.parquet}}"), cities(spark, folder))
