import pytest
from pyspark.sql import functions as F

from clickloom.operators import skew
from tests.conftest import rows


@pytest.fixture(scope="module")
def many(spark):
    """3,000 rows of one key, 3,000 keys with one row, and rows without a key."""
    hot = spark.range(3000).select(F.lit(-1).cast("bigint").alias("key"), "id")
    cold = spark.range(3000).select(F.col("id").alias("key"), (F.col("id") + 10_000).alias("id"))
    none = spark.range(5).select(F.lit(None).cast("bigint").alias("key"), "id")
    return hot.unionByName(cold).unionByName(none)


def test_heavy_keys(many):
    assert rows(skew.heavy_keys(many, "key", parts=512)) == [(-1, 256)]
    weighted = many.groupBy("key").agg(F.count("*").alias("n"))
    assert rows(skew.heavy_keys(weighted, "key", F.col("n"), parts=512)) == [(-1, 256)]


def test_parts_follow_the_shuffle_partitions(spark, many):
    assert skew.parts_for(spark) == 64
    assert rows(skew.heavy_keys(many, "key")) == [(-1, 32)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, many, how):
    one = spark.range(-1, 2000, 2).select(F.col("id").alias("key"), (F.col("id") * 2).alias("x"))
    heavy = skew.heavy_keys(many, "key")
    salted = skew.salted_join(many, one, "key", how, heavy, ["id"])
    plain = many.join(one, "key", how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_heavy_key_is_spread(spark, many, monkeypatch):
    one = spark.range(-1, 10).select(F.col("id").alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        joined = skew.salted_join(many, one, "key", "inner", skew.heavy_keys(many, "key"), ["id"])
        tasks = joined.where("key = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(tasks) == 8
    assert max(r["count"] for r in tasks) < 600


def test_rows_without_a_key_are_spread(spark):
    many = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("key"), "id")
    one = spark.range(0, 4000, 20).select(F.col("id").alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        joined = skew.salted_join(many, one, "key", "left_anti", skew.heavy_keys(many, "key"), ["id"])
        tasks = joined.where("key IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 3800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert max(r["count"] for r in tasks) < 800


def test_top_per_group_in_two_steps_equals_one(many):
    one_step = skew.top_per_group(many, ["key"], [F.desc("id")], 1000).where("key = -1")
    two_steps = skew.top_per_group(many, ["key"], [F.desc("id")], 1001).where("key = -1")
    assert rows(two_steps.where("rank <= 1000")) == rows(one_step)
    assert two_steps.count() == 1001


def test_small_top_is_cut_before_the_shuffle(many):
    top = skew.top_per_group(many, ["key"], [F.desc("id")], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
