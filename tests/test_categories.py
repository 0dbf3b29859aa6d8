from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickloom.operators import categories as C
from tests.conftest import rows

CASES = [
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "a", "click_category_id": 1},
    {"session_id": "b", "click_category_id": 2},
    {"session_id": "b", "click_category_id": None},
    {"session_id": "b", "order_category_ids": "5,5"},
    {"session_id": "b", "order_category_ids": ""},
    {"session_id": "b", "order_category_ids": "1,x"},
    {"session_id": "b", "pay_category_ids": "2,9"},
    {"session_id": "c", "click_category_id": 3, "order_category_ids": "7", "pay_category_ids": "8"},
    {"session_id": "c"},
]


def test_counts(make_actions):
    actions = make_actions(*CASES)
    assert rows(C.click_counts(actions)) == [(1, 2), (2, 1), (3, 1)]
    assert rows(C.order_counts(actions)) == [(1, 1), (5, 2), (7, 1)]
    assert rows(C.pay_counts(actions)) == [(2, 1), (8, 1), (9, 1)]
    expected = [
        (1, 2, 1, 0), (2, 1, 0, 1), (3, 1, 0, 0), (5, 0, 2, 0), (7, 0, 1, 0), (8, 0, 0, 1),
        (9, 0, 0, 1),
    ]
    columns = ["categoryid", "clickCount", "orderCount", "payCount"]
    assert rows(C.category_counts_by_join(actions).select(columns)) == expected
    assert rows(C.category_counts(actions).select(columns)) == expected
    per_session = C.session_category_counts(actions)
    assert rows(C.sum_categories(per_session).select(columns)) == expected


def test_one_kind_per_action(make_actions):
    actions = make_actions(*CASES)
    everything = [(1,), (2,), (3,), (5,), (7,), (8,), (9,)]
    assert rows(C.distinct_categories(actions)) == everything
    assert rows(C.distinct_categories(actions, one_kind=True)) == [(1,), (2,), (3,), (5,), (9,)]


ids = st.one_of(st.none(), st.lists(st.integers(0, 4), max_size=3).map(lambda x: ",".join(map(str, x))))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-1, 4), ids, ids), max_size=25))
def test_one_scan_equals_three_joins(make_actions, cases):
    actions = make_actions(
        {}, *[{"click_category_id": c, "order_category_ids": o, "pay_category_ids": p} for c, o, p in cases]
    )
    columns = ["categoryid", "clickCount", "orderCount", "payCount"]
    assert rows(C.category_counts(actions).select(columns)) == rows(
        C.category_counts_by_join(actions).select(columns)
    )


def test_top_categories_break_ties_by_next_count_then_id(spark):
    counts = spark.createDataFrame(
        [(4, 9, 0, 0), (3, 9, 0, 0), (2, 9, 0, 1), (1, 9, 1, 0), (5, 10, 0, 0)],
        "categoryid bigint, clickCount bigint, orderCount bigint, payCount bigint",
    )
    assert [r.categoryid for r in C.top_categories(counts, 4).collect()] == [5, 1, 2, 3]


def test_top_sessions_order_counts_as_numbers(spark):
    clicks = spark.createDataFrame(
        [(1, "a", 9), (1, "b", 10), (1, "c", 9), (2, "a", 1), (3, "z", 50), (2, "y", 0)],
        "categoryid bigint, session_id string, clickCount bigint",
    )
    wanted = spark.createDataFrame([(1,), (2,)], "categoryid bigint")
    assert rows(C.top_sessions(clicks, wanted, 2)) == [(1, "a", 9), (1, "b", 10), (2, "a", 1)]


def test_details_repeat_per_category(make_actions, spark):
    actions = make_actions({"session_id": "a"}, {"session_id": "a"}, {"session_id": "b"})
    top = spark.createDataFrame([(1, "a"), (2, "a")], "categoryid bigint, session_id string")
    assert C.top_session_actions(actions, top).count() == 4
    assert C.top_session_actions(actions, top, distinct=True).count() == 2


def test_in_categories_and_session_clicks(make_actions, spark):
    actions = make_actions(*CASES)
    wanted = spark.createDataFrame([(1,), (7,)], "categoryid bigint")
    assert C.in_categories(actions, wanted).count() == 2
    clicks = Counter({("a", 1): 2, ("b", 2): 1, ("c", 3): 1})
    got = {(r.session_id, r.categoryid): r.clickCount for r in C.category_session_clicks(actions).collect()}
    assert got == dict(clicks)
