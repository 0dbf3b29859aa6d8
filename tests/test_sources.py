from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickloom.params import TaskParams
from clickloom.shared import shared_folder
from clickloom.sources import tables
from clickloom.sources.sinks import replace_table, write_jdbc
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_includes_both_bounds(make_actions):
    days = ["2023-12-31", "2024-01-01", "2024-01-15", "2024-01-31", "2024-02-01"]
    actions = make_actions(*[{"date": d} for d in days])
    params = TaskParams(start_date="2024-01-01", end_date="2024-01-31")
    assert [d for (d,) in rows(tables.in_date_range(actions, params).select("date"))] == days[1:4]
    assert tables.in_date_range(actions, TaskParams()).count() == 5


def test_scan_gets_filter_and_columns(spark, make_actions):
    path = shared_folder(spark, "actions")
    make_actions({"click_product_id": 3}, {"date": "2024-02-02", "click_product_id": 4}).write.parquet(path)
    clicks = tables.click_scan(tables.read_actions(spark, path), TaskParams(end_date="2024-01-31"))
    assert rows(clicks) == [(0, 3)]
    text = plan(clicks)
    assert "LessThanOrEqual(date,2024-01-31)" in text
    assert "Not(EqualTo(click_product_id,-1))" in text
    assert "ReadSchema: struct<date:string,click_product_id:bigint,city_id:bigint>" in text


def test_date_partitions_are_pruned(spark, make_actions):
    path = shared_folder(spark, "actions")
    make_actions({}, {"date": "2024-02-02"}).write.partitionBy("date").parquet(path)
    found = tables.in_date_range(tables.read_actions(spark, path), TaskParams(end_date="2024-01-31"))
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(date" in plan(found)


def test_readers(spark, make_actions, make_users):
    folder = shared_folder(spark, "tables")
    make_actions({}).write.parquet(f"{folder}/a")
    make_users({"user_id": 1}).write.parquet(f"{folder}/u")
    product = spark.createDataFrame([(1, "p", "{}")], "product_id bigint, product_name string, extend_info string")
    product.write.parquet(f"{folder}/p")
    assert tables.read_actions(spark, f"{folder}/a").count() == 1
    assert tables.read_users(spark, f"{folder}/u").count() == 1
    assert rows(tables.read_products(spark, f"{folder}/p")) == [(1, "p", "{}")]


def test_replace_table(spark):
    path = shared_folder(spark, "table")
    for n in (3, 2):
        df = spark.range(n).withColumn("date", F.lit("2024-01-01"))
        replace_table(df, "replaced", path, ["date"])
    assert rows(spark.table("replaced")) == [(0, "2024-01-01"), (1, "2024-01-01")]
    spark.sql("DROP TABLE replaced")


def test_jdbc_goes_to_the_driver_of_the_url(spark):
    """No database is started for the tests; the write ends where one would be looked up."""
    with pytest.raises(Exception, match="No suitable driver"):
        write_jdbc(spark.range(1), "jdbc:none:x", "t", properties={"user": "u"})


@pytest.mark.parametrize("master, named, fits", [
    ("local[8]", None, True), ("local", None, True), ("local[*,4]", None, True), ("yarn", None, False),
    ("spark://h:7077", None, False), ("local-cluster[2,1,1000]", None, False), ("yarn", "hdfs:///shared/", True),
])
def test_shared_folder_of_a_cluster_must_be_named(master, named, fits):
    conf = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "file:/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *_: conf[key]), sparkContext=SimpleNamespace(master=master))
    if fits:
        assert shared_folder(session, "x").startswith(f"{(named or 'file:/warehouse').rstrip('/')}/clickloom/x-")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session, "x")
