"""Every query against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks import queries as Q
from checks.compare import difference, duck
from checks.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(Q.QUERIES) == set(ORACLES)
    assert set(Q.QUERIES) <= set(contract.queries())


# Three tables of one replayed stream.
LOOP = {"ad_loop_blacklist": "blacklist", "ad_loop_stat": "stats", "ad_loop_top3": "top"}


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in LOOP])
def test_query(spark, con, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(contract.oracle_sql()[name]).df()
    assert difference(got, want) is None


def test_tables_of_the_replayed_stream(spark, con):
    loop = Q._run_loop(spark, FOLDER)
    for name, table in LOOP.items():
        got = getattr(loop, table).latest(spark).toPandas()
        want = con.execute(contract.oracle_sql()[name]).df()
        assert difference(got, want) is None, name


def test_entry(spark):
    assert contract.entry(spark).count() > 0
