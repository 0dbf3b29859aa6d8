"""Most-clicked products of each sales area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import group_concat_distinct, join_id_name, json_field
from clickloom.operators.skew import top_per_group

# Level of each sales area; any other area has OTHER_LEVEL.
AREA_LEVELS = {
    "华北": "A Level",
    "华东": "A Level",
    "华南": "B Level",
    "华中": "B Level",
    "西北": "C Level",
    "西南": "C Level",
}
AREA_LEVELS_ENGLISH = {
    "China North": "A Level",
    "China East": "A Level",
    "China South": "B Level",
    "China Middle": "B Level",
    "West North": "C Level",
    "West South": "C Level",
}
OTHER_LEVEL = "D Level"

# Who sells a product with status 0, and with any other.
STATUS_LABELS = ("Self", "Third Party")
STATUS_LABELS_CHINESE = ("自营", "第三方")


def area_level(area: Column, levels: Mapping[str, str] = AREA_LEVELS) -> Column:
    """Level of an area."""
    level = F.lit(None).cast("string")
    for name in reversed(list(levels)):
        level = F.when(area == name, levels[name]).otherwise(level)
    return F.coalesce(level, F.lit(OTHER_LEVEL))


def product_status(extend_info: Column, labels: tuple[str, str] = STATUS_LABELS) -> Column:
    """Seller of a product, from its JSON ``product_status``."""
    own, other = labels
    return F.when(json_field(extend_info, "product_status") == "0", own).otherwise(other)


def join_cities(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with the name and area of their city; clicks of unknown cities drop.

    No hint: Spark broadcasts the cities when their size is below its threshold.
    """
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id")
    )


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and clicked-from cities per area and product.

    Clicks are counted per city and product first, so the join and the city list work on
    one row per city and product.
    """
    counted = clicks.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("n"))
    located = counted.join(cities.select("city_id", "city_name", "area"), "city_id")
    return located.groupBy("area", F.col("click_product_id").alias("product_id")).agg(
        F.sum("n").alias("click_count"),
        group_concat_distinct(join_id_name("city_id", "city_name")).alias("city_infos"),
    )


def add_products(
    clicks: DataFrame, products: DataFrame, labels: tuple[str, str] = STATUS_LABELS
) -> DataFrame:
    """Add product name and seller; unknown products drop."""
    return clicks.join(products, "product_id").select(
        "area",
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        product_status(F.col("extend_info"), labels).alias("product_status"),
    )


def top_products(
    full: DataFrame, n: int = 3, levels: Mapping[str, str] = AREA_LEVELS
) -> DataFrame:
    """The ``n`` products with most clicks in each area, and the area's level."""
    ranked = top_per_group(full, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
    return ranked.withColumn("area_level", area_level(F.col("area"), levels))


def lay_out(top: DataFrame, keys: list[str], count: str = "click_count") -> DataFrame:
    """One partition per key, each sorted by falling count."""
    return top.repartition(*keys).sortWithinPartitions(F.desc(count))


def product_rows(top: DataFrame, task_id: str) -> DataFrame:
    """Result rows."""
    return top.select(
        F.lit(task_id).alias("taskid"),
        "area",
        F.col("area_level").alias("areaLevel"),
        F.col("product_id").alias("productid"),
        F.col("city_infos").alias("cityInfos"),
        F.col("click_count").alias("clickCount"),
        F.col("product_name").alias("productName"),
        F.col("product_status").alias("productStatus"),
    )
