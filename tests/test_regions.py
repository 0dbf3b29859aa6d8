from pyspark.sql import functions as F

from clickloom.operators import regions
from clickloom.params import TaskParams
from clickloom.plans.region_job import area_top_products
from clickloom.schemas import PRODUCT
from clickloom.sources.tables import CITIES, city_info, click_scan, preview
from tests.conftest import rows


def test_area_top_products(spark, make_actions):
    clicks = {
        # product: clicked from cities
        10: [1, 1, 2],  # 华东
        11: [1, 1],
        12: [2, 2],
        13: [1],
        14: [9, 9],  # 东北
        15: [3],  # 华南
        99: [1] * 9,  # unknown product
    }
    actions = make_actions(
        *[{"click_product_id": p, "city_id": c} for p, cs in clicks.items() for c in cs],
        {"click_product_id": -1, "city_id": 1},
        {"click_product_id": None, "city_id": 1},
        {"click_product_id": 10, "city_id": 77},
        {"click_product_id": 13, "city_id": 1, "date": "2023-12-31"},
    )
    info = {10: '{"product_status": 0}', 11: '{"product_status": 1}', 12: "{}", 13: "{bad", 14: None, 15: '{"product_status": "0"}'}
    products = spark.createDataFrame([(p, f"product{p}", i) for p, i in info.items()], PRODUCT)
    got = area_top_products(
        actions, products, city_info(spark), TaskParams(start_date="2024-01-01"), "t"
    )
    assert rows(got) == sorted(
        [
            ("t", "华东", "A Level", 10, "1:上海,2:南京", 3, "product10", "Self"),
            ("t", "华东", "A Level", 11, "1:上海", 2, "product11", "Third Party"),
            ("t", "华东", "A Level", 12, "2:南京", 2, "product12", "Third Party"),
            ("t", "东北", "D Level", 14, "9:哈尔滨", 2, "product14", "Third Party"),
            ("t", "华南", "B Level", 15, "3:广州", 1, "product15", "Self"),
        ],
        key=repr,
    )


def test_join_cities_row_by_row(spark, make_actions):
    actions = make_actions(
        {"click_product_id": 5, "city_id": 0}, {"click_product_id": 5, "city_id": 0}, {"city_id": 1}
    )
    got = rows(regions.join_cities(click_scan(actions), city_info(spark)))
    assert got == [(0, "北京", "华北", 5)] * 2


def test_english_levels(spark):
    level = regions.area_level(F.col("a"), regions.AREA_LEVELS_ENGLISH)
    df = spark.createDataFrame([("China Middle",), ("West South",), ("Elsewhere",)], "a string")
    assert rows(df.select("a", level)) == [
        ("China Middle", "B Level"), ("Elsewhere", "D Level"), ("West South", "C Level"),
    ]


def test_layout_keeps_an_area_together(spark):
    top = spark.createDataFrame([(a, n) for a in "xyz" for n in (1, 3, 2)], "area string, click_count int")
    laid = regions.lay_out(top, ["area"]).withColumn("p", F.spark_partition_id()).collect()
    for area in "xyz":
        mine = [r for r in laid if r.area == area]
        assert len({r.p for r in mine}) == 1
        assert [r.click_count for r in mine] == [3, 2, 1]


def test_preview(spark):
    assert [r.city_id for r in preview(city_info(spark), ["city_id"], 3).collect()] == [0, 1, 2]
    assert len(CITIES) == 10
