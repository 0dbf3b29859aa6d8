import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment["PYTHONPATH"] = ROOT
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_actions(spark):
    """Actions from dicts; missing columns get their "absent" value."""
    from clickloom.schemas import ACTION

    blank = {
        "date": "2024-01-01",
        "user_id": 1,
        "session_id": "s",
        "page_id": 1,
        "action_time": "2024-01-01 10:00:00",
        "click_category_id": -1,
        "click_product_id": -1,
        "city_id": 0,
    }

    def make(*rows):
        filled = [{**{n: None for n in ACTION.names}, **blank, **row} for row in rows]
        return spark.createDataFrame([tuple(r[n] for n in ACTION.names) for r in filled], ACTION)

    return make


@pytest.fixture(scope="session")
def make_users(spark):
    from clickloom.schemas import USER

    def make(*rows):
        full = [
            (r["user_id"], "u", "n", r.get("age"), r.get("professional"), r.get("city"), r.get("sex"))
            for r in rows
        ]
        return spark.createDataFrame(full, USER)

    return make


def rows(df):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
