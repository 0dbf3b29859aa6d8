import datetime

import pytest
from hypothesis import HealthCheck, given, settings
import pytest
from hypothesis import strategies as st

from clickloom.operators import sampling, sessions
from clickloom.params import TaskParams
from clickloom.plans.session_jobs import SessionRun, ratio_statistics
from clickloom.shared import names_in
from tests.conftest import rows

START = datetime.datetime(2024, 1, 1, 9, 5, 3)


def at(seconds):
    return (START + datetime.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def test_aggregate(make_actions):
    actions = make_actions(
        {"action_time": "2024-01-01 9:05:03", "search_keyword": "新辣道鱼火锅"},
        {"action_time": "2024-01-01 09:05:13", "search_keyword": "火锅"},
        {"action_time": "2024-01-01 09:05:07", "click_category_id": 15},
        {"action_time": "2024-01-01 09:05:08", "click_category_id": 2},
        {"action_time": "2024-01-01 09:05:09", "click_category_id": 15},
        {"session_id": "t", "search_keyword": "", "click_category_id": None},
    )
    got = rows(
        sessions.format_sessions(sessions.aggregate_sessions(actions)).select(
            "session_id", "user_id", "search_keywords", "click_category_ids", "start_time",
            "visit_length", "step_length",
        )
    )
    assert got == [
        ("s", 1, "新辣道鱼火锅,火锅", "2,15", "2024-01-01 09:05:03", 10, 5),
        ("t", 1, None, None, "2024-01-01 10:00:00", 0, 1),
    ]


def test_buckets_at_their_bounds(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 1, 1, 1, 1, 1, 1, 1]
    df = spark.createDataFrame(list(zip(lengths, steps)), "visit_length bigint, step_length bigint")
    got = sessions.session_histogram(df).first().asDict()
    assert got.pop("session_count") == 18
    assert [got[n] for n, *_ in sessions.VISIT_LENGTHS] == [2, 2, 2, 2, 2, 2, 2, 2, 1]
    assert [got[n] for n, *_ in sessions.STEP_LENGTHS] == [9, 2, 2, 2, 2, 1]


def test_ratios_of_no_sessions_are_zero(make_actions, make_users):
    params = TaskParams(start_age=40, end_age=50)
    users = make_users({"user_id": 1, "age": 30})
    got = ratio_statistics(make_actions({}), users, params, "t").first().asDict()
    assert got.pop("taskid") == "t"
    assert set(got.values()) == {0}


def test_filter(make_actions, make_users):
    actions = make_actions(
        {"session_id": "keeps", "user_id": 1, "search_keyword": "b"},
        {"session_id": "keeps", "user_id": 1, "click_category_id": 7},
        {"session_id": "no keyword", "user_id": 1, "click_category_id": 7},
        {"session_id": "no category", "user_id": 1, "search_keyword": "b"},
        {"session_id": "no age", "user_id": 2, "search_keyword": "b", "click_category_id": 7},
        {"session_id": "unknown user", "user_id": 3, "search_keyword": "b", "click_category_id": 7},
    )
    users = make_users(
        {"user_id": 1, "age": 20, "professional": "p", "city": "c", "sex": "male"},
        {"user_id": 2, "professional": "p", "city": "c", "sex": "male"},
    )
    params = TaskParams(
        start_age=20, end_age=20, professionals="q,p", cities="c", sex="male", keywords="a,b",
        category_ids="7",
    )
    kept = sessions.filter_sessions(sessions.aggregate_sessions(actions, params), users, params)
    assert [r.session_id for r in kept.collect()] == ["keeps"]
    nobody = TaskParams()
    everyone = sessions.filter_sessions(
        sessions.aggregate_sessions(actions, nobody), users, nobody
    )
    assert everyone.count() == 4
    # Sessions made without parameters are filtered by their lists; without lists there is no telling.
    plain = sessions.aggregate_sessions(actions)
    assert rows(sessions.filter_sessions(plain, users, params).select("session_id")) == [("keeps",)]
    with pytest.raises(ValueError):
        sessions.filter_sessions(plain.drop("search_keywords"), users, params)
    assert rows(sessions.session_actions(actions, kept).select("search_keyword")) == [("b",), (None,)]


def test_histogram_per_user_equals_histogram_of_filtered(make_actions, make_users):
    actions = make_actions(
        *[
            {"session_id": f"s{i % 40}", "user_id": i % 40 % 7, "action_time": at(i * i % 4000)}
            for i in range(300)
        ]
    )
    users = make_users(*[{"user_id": i, "age": 10 * i} for i in range(6)])
    params = TaskParams(start_age=10, end_age=40)
    all_sessions = sessions.aggregate_sessions(actions, params)
    filtered = sessions.filter_sessions(all_sessions, users, params)
    assert rows(sessions.filtered_histogram(all_sessions, users, params)) == rows(
        sessions.session_histogram(filtered)
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=60))
def test_every_session_of_a_second_or_more_is_in_one_bucket(spark, lengths):
    df = spark.createDataFrame([(n, n) for n in lengths], "visit_length bigint, step_length bigint")
    got = sessions.session_histogram(df).first()
    positive = sum(n >= 1 for n in lengths)
    assert sum(got[n] for n, *_ in sessions.VISIT_LENGTHS) == positive
    assert sum(got[n] for n, *_ in sessions.STEP_LENGTHS) == positive


def starts(spark, counts):
    """Sessions per (day, hour)."""
    made = [
        (f"{day}-{hour}-{i}", datetime.datetime(2024, 1, day, hour, i % 60))
        for (day, hour), n in counts.items()
        for i in range(n)
    ]
    return spark.createDataFrame(made, "session_id string, start_time timestamp_ntz")


def test_quota_floors_twice(spark):
    counts = {(1, 0): 50, (1, 5): 150, (2, 3): 10, (3, 3): 1}
    got = rows(
        sampling.hour_quota(starts(spark, counts), 100).select(
            "date", "hour", "hour_count", "day_quota", "quota"
        )
    )
    assert got == [
        ("2024-01-01", "00", 50, 33, 8),
        ("2024-01-01", "05", 150, 33, 24),
        ("2024-01-02", "03", 10, 33, 10),
        ("2024-01-03", "03", 1, 33, 1),
    ]


def test_sample_is_reproducible_and_fills_the_quota(spark):
    sessions_ = starts(spark, {(1, 0): 50, (1, 5): 150, (2, 3): 10})
    first = rows(sampling.sample_sessions(sessions_, 100).select("date", "hour", "session_id"))
    again = rows(
        sampling.sample_sessions(sessions_.repartition(7), 100).select("date", "hour", "session_id")
    )
    assert first == again
    assert len(first) == len(set(first)) == 12 + 37 + 10
    other = rows(sampling.sample_sessions(sessions_, 100, "x").select("date", "hour", "session_id"))
    assert other != first


def test_two_step_sample_equals_one_step(spark):
    sessions_ = starts(spark, {(1, 0): 30, (1, 5): 70})
    quota = {("00"): 30, ("05"): 70}
    got = sampling.sample_sessions(sessions_, 5000)
    assert {r.hour: r["count"] for r in got.groupBy("hour").count().collect()} == quota


def test_run_writes_all_results(spark, make_actions, make_users):
    actions = make_actions(
        *[
            {
                "session_id": f"s{i % 20}",
                "user_id": i % 5,
                "action_time": at(i),
                "click_category_id": i % 3,
                "order_category_ids": "1,2" if i % 4 == 0 else None,
            }
            for i in range(200)
        ],
        {"date": "2024-02-01", "session_id": "late"},
    )
    users = make_users(*[{"user_id": i, "age": 30} for i in range(5)])
    written = {}
    params = TaskParams(end_date="2024-01-31")
    run = SessionRun(actions, users, params)
    run.run("t", lambda table, df: written.update({table: rows(df)}))
    assert written["session_aggr_stat"] == rows(ratio_statistics(actions, users, params, "t"))
    assert run.filtered_actions().count() == 200
    assert written["session_aggr_stat"][0][:2] == ("t", 20)
    assert len(written["session_random_extract"]) == 20
    assert len(written["session_detail"]) == 200
    assert [r[1:] for r in written["top10_category"]] == [(0, 67, 0, 0), (1, 67, 50, 0), (2, 66, 50, 0)]
    assert len(written["top10_session"]) == 30
    # Each session clicks all three categories; it counts once per category that lists it.
    assert len(written["top10_session_detail"]) == 30 * 10


def test_run_removes_what_it_stored(spark, make_actions, make_users):
    users = make_users({"user_id": 1, "sex": "male"})
    with SessionRun(make_actions({"click_category_id": 1}), users) as run:
        run.run("t", lambda table, df: df.collect())
        assert names_in(spark, run.scratch.folder)
    assert names_in(spark, run.scratch.folder) == []


def test_users_are_joined_to_sessions_made_once(make_actions, make_users):
    joined = sessions.join_users(sessions.aggregate_sessions(make_actions({})), make_users({"user_id": 1}))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_run_in_which_nothing_matches(make_actions, make_users):
    written = {}
    params = TaskParams(sex="female")
    users = make_users({"user_id": 1, "sex": "male"})
    run = SessionRun(make_actions({"click_category_id": 1}), users, params)
    run.run("t", lambda table, df: written.update({table: rows(df)}))
    assert len(written.pop("session_aggr_stat")) == 1
    assert set(map(len, written.values())) == {0}
