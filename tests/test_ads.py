import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import ads
from clickloom.operators.upsert import INCREMENT, OVERWRITE, REPLACE_GROUP, new_rows, upsert
from clickloom.sources.ad_log import format_lines, kafka_lines, parse_lines, rejected_lines
from tests.conftest import rows

UTC = datetime.timezone.utc


def clicks_of(spark, data):
    """Clicks from ``(time, user, ad[, province[, city]])``."""
    full = [
        (datetime.datetime.fromisoformat(t).replace(tzinfo=UTC), *(place or ["p", "c"]), u, a)
        for t, u, a, *place in data
    ]
    return spark.createDataFrame(
        full, "ts timestamp, province string, city string, userid bigint, adid bigint"
    )


def test_lines(spark):
    good = "1538928000123 p1 c2 3 4"
    long = f"1538928000123 p1 c2 {2**63 - 1} -{2**63}"
    bad = ["x p c 3 4", f"{2**63 - 1} p c 3 4", f"1 p c {2**63} 4", "1538928000123 p c 3", "", "1 p c u 4", "1  c 3 4"]
    lines = spark.createDataFrame([(x,) for x in [good, f"{good} more", long, *bad]], "value string")
    parsed = parse_lines(lines)
    assert rows(parsed.select(F.unix_millis("ts"), "province", "city", "userid", "adid")) == [
        (1538928000123, "p1", "c2", 3, 4),
        (1538928000123, "p1", "c2", 3, 4),
        (1538928000123, "p1", "c2", 2**63 - 1, -(2**63)),
    ]
    assert rows(format_lines(parsed)) == sorted([(good,), (good,), (long,)])
    assert rows(rejected_lines(lines)) == sorted((x,) for x in bad)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "host:9092", "clicks", "group", max_offsets=1000)


def test_counts_and_threshold(spark):
    clicks = clicks_of(
        spark,
        [
            ("2024-01-01T10:00:00", 1, 5), ("2024-01-01T23:59:59", 1, 5),
            ("2024-01-02T00:00:00", 1, 5), ("2024-01-01T10:00:00", 2, 5),
            ("2024-01-01T10:00:00", 2, 6),
        ],
    )
    counts = ads.user_counts(clicks)
    assert rows(counts) == [
        ("2024-01-01", 1, 5, 2), ("2024-01-01", 2, 5, 1), ("2024-01-01", 2, 6, 1),
        ("2024-01-02", 1, 5, 1),
    ]
    assert rows(ads.users_over(counts, 2)) == [(1,)]
    asked = spark.createDataFrame(
        [("2024-01-01", 1, 5), ("2024-01-09", 1, 5)], "date string, userid bigint, adid bigint"
    )
    assert [r[-1] for r in rows(ads.current_counts(asked, counts))] == [2, 0]
    assert rows(ads.drop_listed(counts, ads.users_over(counts, 2)).select("userid")) == [(2,), (2,)]


def test_top_ads(spark):
    stats = spark.createDataFrame(
        [("d1", "p", "c1", a, n) for a, n in [(1, 5), (2, 5), (3, 1), (4, 2)]]
        + [("d1", "p", "c2", 3, 3), ("d2", "p", "c1", 9, 100), ("d1", "q", "c", 7, 1)],
        "date string, province string, city string, adid bigint, clickCount bigint",
    )
    assert rows(ads.top_ads(stats)) == [
        ("d1", "p", 1, 5), ("d1", "p", 2, 5), ("d1", "p", 3, 4), ("d1", "q", 7, 1),
        ("d2", "p", 9, 100),
    ]
    assert rows(ads.top_ads(stats, 2, ["province"])) == [
        ("d1", "p", 1, 5), ("d1", "q", 7, 1), ("d2", "p", 9, 100),
    ]


def test_trend_and_its_newest_part(spark):
    clicks = clicks_of(
        spark,
        [
            ("2024-01-01T09:05:59", 1, 5), ("2024-01-01T09:05:00", 2, 5),
            ("2024-01-01T09:06:00", 1, 5), ("2024-01-01T10:04:59", 1, 5),
        ],
    )
    trend = ads.minute_counts(clicks)
    first, second, third = [
        ("2024-01-01", "09", "05", 5, 2), ("2024-01-01", "09", "06", 5, 1),
        ("2024-01-01", "10", "04", 5, 1),
    ]
    assert rows(trend) == [first, second, third]
    assert rows(ads.recent(trend, 60)) == [first, second, third]
    assert rows(ads.recent(trend, 59)) == [second, third]
    assert rows(ads.minute_counts(ads.last_minutes(clicks, 59))) == [second, third]
    assert rows(ads.minute_counts(ads.last_minutes(clicks, 1))) == [third]


@pytest.mark.parametrize("length, slide", [(60, 10), (120, 120), (25, 10)])
def test_sliding_windows(spark, length, slide):
    seconds = [0, 1, 9, 10, 24, 25, 59, 60, 61, 150]
    base = datetime.datetime(2024, 1, 1)
    clicks = clicks_of(
        spark, [((base + datetime.timedelta(seconds=s)).isoformat(), 1, 5) for s in seconds]
    )
    epoch = int(base.replace(tzinfo=UTC).timestamp())
    expected = {}
    for s in seconds:
        t = epoch + s
        start = t // slide * slide
        while start > t - length:
            expected[start] = expected.get(start, 0) + 1
            start -= slide
    got = ads.sliding_counts(clicks, length, slide)
    assert {r[0]: r[1] for r in rows(got.select(F.unix_seconds("start"), "clickCount"))} == expected


def loop(batches, threshold):
    """The feedback loop, click by click: kept clicks and the batch that lists each user."""
    counts, listed, kept = {}, {}, []
    for number, batch in batches:
        passing = [c for c in batch if c[1] not in listed]
        kept += [(number, *c) for c in passing]
        for t, user, ad in passing:
            key = (t[:10], user, ad)
            counts[key] = counts.get(key, 0) + 1
        for (_, user, _), n in counts.items():
            if n >= threshold:
                listed.setdefault(user, number)
    return kept, listed


click = st.tuples(
    st.sampled_from(["2024-01-01T10:00:00", "2024-01-02T10:00:00"]), st.integers(1, 3), st.integers(1, 2)
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(click, min_size=1, max_size=8), min_size=1, max_size=4))
def test_replay_equals_the_loop(spark, batches):
    kept, listed = loop(list(enumerate(batches)), 3)
    data = [(b, i, *c) for b, batch in enumerate(batches) for i, c in enumerate(batch)]
    clicks = spark.createDataFrame(
        data, "batch int, id int, time string, userid bigint, adid bigint"
    ).withColumn("ts", F.col("time").cast("timestamp"))
    assert dict(rows(ads.listing_batches(clicks, 3))) == listed
    got = ads.replay_blacklist(clicks, 3, ["id"]).select(
        "batch", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "userid", "adid"
    )
    assert rows(got) == sorted(kept, key=repr)


TABLE = "g string, k bigint, clickCount bigint"


def test_upsert_modes(spark):
    old = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], TABLE)
    new = spark.createDataFrame([("a", 1, 5), ("c", 1, 7)], TABLE)
    keys = ["g", "k"]
    assert rows(upsert(old, new, keys, INCREMENT)) == [
        ("a", 1, 15), ("a", 2, 20), ("b", 1, 30), ("c", 1, 7),
    ]
    assert rows(upsert(old, new, keys, OVERWRITE)) == [
        ("a", 1, 5), ("a", 2, 20), ("b", 1, 30), ("c", 1, 7),
    ]
    assert rows(upsert(old, new, ["g"], REPLACE_GROUP)) == [("a", 1, 5), ("b", 1, 30), ("c", 1, 7)]
    with pytest.raises(ValueError):
        upsert(old, new, keys, "delete")


def test_new_rows(spark):
    old = spark.createDataFrame([(1,)], "userid bigint")
    new = spark.createDataFrame([(1,), (2,), (2,)], "userid bigint")
    assert rows(new_rows(old, new, ["userid"])) == [(2,)]
