"""Scans of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.params import TaskParams

# The city dimension (id, name, sales area).
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ACTION).parquet(path)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.USER).parquet(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT).parquet(path)


def city_info(spark: SparkSession) -> DataFrame:
    """The built-in city dimension; its ten rows are always broadcast."""
    return F.broadcast(spark.createDataFrame(CITIES, schemas.CITY))


def in_date_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions from ``start_date`` to ``end_date``, both included.

    The bare column is compared, so the bounds reach the scan (or its partitions).
    """
    if params.start_date:
        actions = actions.where(F.col("date") >= params.start_date)
    if params.end_date:
        actions = actions.where(F.col("date") <= params.end_date)
    return actions


def click_scan(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """City and product of every product click in the date range."""
    product = F.col("click_product_id")
    clicks = in_date_range(actions, params).where(
        product.isNotNull() & (product != schemas.ABSENT_ID)
    )
    return clicks.select("city_id", "click_product_id")


def preview(table: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return table.orderBy(*order).limit(n)
