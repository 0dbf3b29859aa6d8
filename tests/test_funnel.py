import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import funnel
from clickloom.params import TaskParams
from clickloom.plans.funnel_job import page_conversion
from tests.conftest import rows

START = datetime.datetime(2024, 1, 1)


def brute_force(visits, newest_first=False):
    """Pairs of ``(session, second, page)`` visits, ties by page."""
    pairs = []
    for session in {v[0] for v in visits}:
        pages = [p for _, _, p in sorted(v for v in visits if v[0] == session)]
        if newest_first:
            pages.reverse()
        pairs += [(session, f"{a}_{b}") for a, b in zip(pages, pages[1:])]
    return sorted(pairs, key=repr)


def as_actions(make_actions, visits):
    return make_actions(
        *[
            {
                "session_id": s,
                "page_id": p,
                "action_time": str(START + datetime.timedelta(seconds=t)),
            }
            for s, t, p in visits
        ]
    )


@pytest.mark.parametrize("parts", [1, 2, 30, 10**6])
@pytest.mark.parametrize("newest_first", [False, True])
def test_pairs_do_not_depend_on_what_is_heavy(make_actions, parts, newest_first):
    dice = random.Random(parts)
    visits = [
        (dice.choice(["hot"] * 4 + ["a", "b", "c"]), dice.randrange(200), dice.randrange(5))
        for _ in range(150)
    ] + [("gap", 0, 1), ("gap", 90_000, 2), ("gap", 90_000, 3), ("single", 5, 1)]
    pairs = funnel.page_pairs(
        as_actions(make_actions, visits), newest_first=newest_first, parts=parts
    )
    assert rows(pairs) == brute_force(visits, newest_first)


def test_one_second_of_one_session_is_cut(spark):
    """400,000 actions at one time: the pairs come from all tasks and are those of the ties' order."""
    n = 400_000
    actions = spark.range(n, numPartitions=8).selectExpr(
        "'bot' AS session_id", "(id * 7) % 11 AS page_id", "'2024-01-01 10:00:00' AS action_time", "id AS tie"
    )
    pairs = funnel.page_pairs(actions, "tie")
    got = {r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect()}
    want = collections.Counter(f"{i * 7 % 11}_{(i + 1) * 7 % 11}" for i in range(n - 1))
    assert got == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = funnel.page_pairs(actions, "tie").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in tasks) < 0.8 * n and sum(r["count"] for r in tasks) == n - 1


def test_actions_without_a_session_are_one_session(make_actions):
    visits = [(None, t, t % 3) for t in range(30)] + [("a", 0, 1), ("a", 1, 2)]
    for parts in (2, 10**6):
        assert rows(funnel.page_pairs(as_actions(make_actions, visits), parts=parts)) == brute_force(visits)


def test_equal_times_follow_the_tie_column(make_actions):
    actions = make_actions({"page_id": 1, "city_id": 2}, {"page_id": 2, "city_id": 1})
    assert rows(funnel.page_pairs(actions, "city_id")) == [("s", "2_1")]


def test_conversion_chain(make_actions):
    visits = [("a", 0, 1), ("a", 1, 2), ("a", 2, 3), ("b", 0, 1), ("b", 1, 2), ("c", 0, 1)]
    got = page_conversion(
        as_actions(make_actions, visits), TaskParams(target_page_flow="1,2,3,4,5,6"), "t"
    )
    # Three views of page 1; 1_2 twice; 2_3 once; 3_4 never; what follows is over zero.
    assert rows(got) == [
        ("t", "1_2", "0.67"), ("t", "2_3", "0.5"), ("t", "3_4", "0.0"), ("t", "4_5", None),
        ("t", "5_6", None),
    ]


def test_unrounded_and_as_text(make_actions):
    visits = [("a", 0, 1), ("a", 1, 2), ("b", 0, 1), ("c", 0, 1)]
    actions = as_actions(make_actions, visits)
    counts = funnel.pair_counts(funnel.page_pairs(actions), "1,2,3")
    start = funnel.start_page_views(actions, "1,2,3")
    exact = funnel.conversion(counts, start, "1,2,3", "t", rounded=False)
    assert [r.rate for r in exact.orderBy("step").collect()] == [1 / 3, 0.0]
    rounded = funnel.conversion(counts, start, "1,2,3", "t")
    assert rows(funnel.conversion_text(rounded)) == [("t", "1_2=0.33|2_3=0.0")]


def test_flow_with_a_repeated_pair_counts_it_once(make_actions):
    actions = as_actions(make_actions, [("a", 0, 1), ("a", 1, 2)])
    counts = funnel.pair_counts(funnel.page_pairs(actions), "1,2,1,2")
    assert rows(counts) == [("1_2", 1)]


def test_flow_steps(spark):
    assert rows(funnel.flow_steps(spark, "3,5,2")) == [(1, "3_5"), (2, "5_2")]
    assert rows(funnel.flow_steps(spark, "3")) == []
