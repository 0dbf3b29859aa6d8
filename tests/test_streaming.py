import random

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ads
from clickloom.operators.upsert import INCREMENT, OVERWRITE, REPLACE_GROUP, upsert
from clickloom.plans.ad_job import AdJob, start_ad_job
from clickloom.shared import materialize, names_in, shared_folder
from clickloom.sources import driver_tables
from clickloom.sources.ad_log import file_lines, format_lines, parse_lines
from clickloom.streaming.ads import BlacklistLoop, ClickTrend, RunningPanes, RunningStats, RunningTrend, closed_windows
from clickloom.streaming.run import run_available, start
from clickloom.streaming.tables import KeyedTable, ListedOnce, Run
from tests.conftest import rows
from tests.test_ads import clicks_of, loop

STAT = "date string, province string, city string, adid bigint, clickCount bigint"


@pytest.fixture
def folder(spark):
    return shared_folder(spark, "test")


def files_of(spark, path):
    """The data files below a folder."""
    return {r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()}


@pytest.mark.parametrize("mode", [INCREMENT, OVERWRITE, REPLACE_GROUP])
def test_table_equals_upserts_in_turn(spark, folder, mode):
    """Every batch written twice, as after a failure; a new query goes on where the last one was."""
    dice = random.Random(mode)
    by = ads.PROVINCE_KEYS if mode == REPLACE_GROUP else ["date"]
    keys = by if mode == REPLACE_GROUP else ads.STAT_KEYS
    stored = KeyedTable(folder, schemas.AD_STAT, ads.STAT_KEYS, mode, by, buckets=0 if mode == REPLACE_GROUP else 2)
    table = spark.createDataFrame([], STAT)
    assert rows(stored.latest(spark)) == []
    for batch in range(5):
        drawn = {
            (f"2024-01-0{dice.randint(1, 2)}", dice.choice("pq"), dice.choice(["c", None]), dice.randint(1, 3)): dice.randint(1, 9)
            for _ in range(4)
        }
        update = spark.createDataFrame([(*k, n) for k, n in drawn.items()], STAT)
        run = Run("first" if batch < 3 else "second", batch % 3)
        stored.write(update, run)
        stored.write(update, run)
        if mode == REPLACE_GROUP:
            table = spark.createDataFrame(rows(upsert(table, update, keys, mode)), STAT)
        else:  # a null city equals a null city in the table
            named = lambda df: df.fillna("null", "city")
            table = spark.createDataFrame(rows(upsert(named(table), named(update), keys, mode).select(*schemas.AD_STAT.names)), STAT)
        assert rows(stored.latest(spark).fillna("null", "city")) == rows(table.fillna("null", "city"))


def test_a_batch_replaces_only_the_folders_it_touches(spark, folder):
    stored = KeyedTable(folder, schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS, buckets=8, spread=["userid"])
    day = lambda d, users: spark.createDataFrame([(d, u, 1, 1) for u in users], schemas.AD_USER_CLICK_COUNT)
    stored.write(day("2024-01-01", range(50)).union(day("2024-01-02", range(50))), Run("q", 0))
    before = files_of(spark, folder)
    places = stored.write(day("2024-01-02", [7]), Run("q", 1))
    written = stored.among(spark, places)
    gone, new = before - files_of(spark, folder), files_of(spark, folder) - before
    folders = {f.rsplit("/", 1)[0] for f in gone | new}
    assert gone and new and len(folders) == 1 and "date=2024-01-02/bucket=" in folders.pop()
    assert rows(written.where(Run("q", 1).made()).select("date", "userid", "clickCount")) == [("2024-01-02", 7, 2)]
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date=2024-01-01" not in plan  # only the folder of the batch's date is listed


def test_groups_are_replaced_as_folders(spark, folder):
    stored = KeyedTable(folder, schemas.AD_PROVINCE_TOP3, ads.PROVINCE_KEYS, REPLACE_GROUP, ads.PROVINCE_KEYS)
    made = lambda *tops: spark.createDataFrame(list(tops), schemas.AD_PROVINCE_TOP3)
    stored.write(made(("d", "p", 1, 5), ("d", "p", 2, 4), ("d", "q/r s", 1, 9)), Run("q", 0))
    before = files_of(spark, folder)
    stored.write(made(("d", "p", 3, 7)), Run("q", 1))
    assert rows(stored.latest(spark)) == [("d", "p", 3, 7), ("d", "q/r s", 1, 9)]
    assert [f for f in before & files_of(spark, folder)] == [f for f in before if "province=q" in f]


def test_listed_in_earlier_batches(spark, folder):
    listed = ListedOnce(folder, schemas.AD_BLACKLIST)
    users = lambda *ids: spark.createDataFrame([(i,) for i in ids], schemas.AD_BLACKLIST)
    assert rows(listed.latest(spark)) == [] and rows(listed.before(spark, Run("q", 0))) == []
    listed.write(users(), Run("q", 0))
    listed.write(users(1, 2), Run("q", 1))
    listed.write(users(2, 3), Run("q", 1))  # run again
    listed.write(users(5), Run("r", 1))
    assert rows(listed.before(spark, Run("q", 1))) == [(5,)]
    assert rows(listed.before(spark, Run("q", 2))) == rows(listed.latest(spark)) == [(2,), (3,), (5,)]


def test_tables_outlive_their_checkpoint(spark, folder):
    """The counts go on under a new checkpoint."""
    batches = random_batches(8)
    for number, batch in enumerate(batches):
        arrive(spark, f"{folder}/in{number}", batch)
        clicks = parse_lines(file_lines(spark, f"{folder}/in{number}"))
        sinks = [ClickTrend(f"{folder}/trend"), BlacklistLoop(f"{folder}/loop", 1000)]
        for i, sink in enumerate(sinks):
            run_available(clicks, sink, f"{folder}/checkpoint{i}-{number}")
    everything = clicks_of(spark, sum(batches, []))
    assert rows(sinks[0].trend.latest(spark)) == rows(ads.minute_counts(everything))
    assert rows(sinks[1].stats.latest(spark)) == rows(ads.stat_counts(everything))
    assert rows(sinks[1].user_counts.latest(spark)) == rows(ads.user_counts(everything))


def random_batches(seed, days=2):
    dice = random.Random(seed)
    return [
        [
            (f"2024-01-0{dice.randint(1, days)}T10:0{dice.randint(0, 9)}:00", dice.randint(1, 6), dice.randint(1, 2))
            for _ in range(25)
        ]
        for _ in range(3)
    ]


def arrive(spark, incoming, batch):
    format_lines(clicks_of(spark, batch)).coalesce(1).write.mode("append").text(incoming)


def test_blacklist_loop_over_restarts(spark, folder):
    """Three batches, the query stopped and started again after each."""
    threshold = 4
    batches = random_batches(1)
    state = BlacklistLoop(f"{folder}/tables", threshold)
    for batch in batches:
        arrive(spark, f"{folder}/in", batch)
        clicks = parse_lines(file_lines(spark, f"{folder}/in"))
        run_available(clicks, state, f"{folder}/checkpoint")
    kept, listed = loop(list(enumerate(batches)), threshold)
    assert 0 < len(listed) and len(kept) < 75
    assert rows(state.blacklist.latest(spark)) == sorted((u,) for u in listed)
    kept_clicks = clicks_of(spark, [c[1:] for c in kept])
    assert rows(state.user_counts.latest(spark)) == rows(ads.user_counts(kept_clicks))
    assert rows(state.stats.latest(spark)) == rows(ads.stat_counts(kept_clicks))
    assert rows(state.top.latest(spark)) == rows(ads.top_ads(ads.stat_counts(kept_clicks)))


def test_blacklist_loop_survives_a_retried_batch(spark, folder):
    batches = random_batches(2)
    once = BlacklistLoop(f"{folder}/once", 4)
    twice = BlacklistLoop(f"{folder}/twice", 4)
    for number, batch in enumerate(batches[:2]):
        clicks = clicks_of(spark, batch)
        once(clicks, number)
        twice(clicks, number)
        twice(clicks, number)
    for name in ("blacklist", "user_counts", "stats", "top"):
        assert rows(getattr(once, name).latest(spark)) == rows(getattr(twice, name).latest(spark))


def test_blacklist_loop_takes_an_empty_batch(spark, folder):
    state = BlacklistLoop(folder, 4)
    state(clicks_of(spark, random_batches(3)[0]).where("false"), 0)
    state(clicks_of(spark, random_batches(3)[0]), 1)
    assert state.stats.latest(spark).count() > 0


def test_top_by_province_over_all_dates(spark, folder):
    state = BlacklistLoop(folder, 100, top_n=1, top_partition=["province"])
    state(clicks_of(spark, [("2024-01-01T10:00:00", u, 1) for u in range(3)]), 0)
    state(clicks_of(spark, [("2024-01-02T10:00:00", 1, 2)]), 1)
    assert rows(state.top.latest(spark)) == [("2024-01-01", "p", 1, 3)]


def test_running_statistics_equal_batch(spark, folder):
    """Three batches, the query stopped and started again after each; its counts are in the state store."""
    batches = random_batches(4)
    sink = RunningStats(f"{folder}/tables")
    for batch in batches:
        arrive(spark, f"{folder}/in", batch)
        clicks = parse_lines(file_lines(spark, f"{folder}/in"))
        run_available(sink.running(clicks), sink, f"{folder}/checkpoint", mode="update")
    expected = ads.stat_counts(clicks_of(spark, sum(batches, [])))
    assert rows(sink.totals(spark)) == rows(expected)
    assert rows(sink.top.latest(spark)) == rows(ads.top_ads(expected))


def newest_first(seed):
    return [[(f"2024-01-0{day}{t[10:]}", u, a) for t, u, a in b] for day, b in zip((3, 2, 1), random_batches(seed))]


def test_trend_and_sliding_panes_equal_batch(spark, folder):
    """Days arrive newest first, one file per micro-batch; nothing is too late."""
    batches = newest_first(5)
    for batch in batches:
        arrive(spark, f"{folder}/in", batch)
    clicks = parse_lines(file_lines(spark, f"{folder}/in", max_files=1))
    trend, panes, added = RunningTrend(f"{folder}/trend"), RunningPanes(f"{folder}/panes", 10), ClickTrend(f"{folder}/added")
    run_available(trend.running(clicks), trend, f"{folder}/c1", mode="update")
    run_available(panes.running(clicks), panes, f"{folder}/c2", mode="update")
    run_available(clicks, added, f"{folder}/c3")
    everything = clicks_of(spark, sum(batches, []))
    assert rows(trend.totals(spark)) == rows(added.trend.latest(spark)) == rows(ads.minute_counts(everything))
    assert rows(ads.slide_panes(panes.totals(spark), 120, 10)) == rows(ads.sliding_counts(everything, 120, 10))


def test_state_goes_when_its_span_of_arrival_is_over(spark, folder):
    """Old clicks that come late are counted, and the state does not keep what came in earlier spans."""
    batches = newest_first(9)
    trend = RunningTrend(f"{folder}/tables", span="1 second")
    kept = []
    for batch in batches:
        arrive(spark, f"{folder}/in", batch)
        clicks = parse_lines(file_lines(spark, f"{folder}/in"))
        query = start(trend.running(clicks), trend, f"{folder}/c", every=None, mode="update")
        query.awaitTermination()
        progress = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        kept.append(max(p["numRowsTotal"] for p in progress))
        assert sum(p["numRowsDroppedByWatermark"] for p in progress) == 0
    assert rows(trend.totals(spark)) == rows(ads.minute_counts(clicks_of(spark, sum(batches, []))))
    assert kept[-1] <= 2 * 25  # of 75 clicks: no more than those of this batch and of the last


def test_closed_windows_of_a_stream(spark, folder):
    """Each window that ends by the watermark comes once, equal to the batch result."""
    first = [(f"2024-01-01T10:0{m}:0{s}", u, u % 2) for u, (m, s) in enumerate([(0, 1), (0, 9), (1, 0), (2, 5), (4, 0)])]
    for batch in (first, [("2024-01-01T10:09:00", 9, 1)]):
        arrive(spark, f"{folder}/in", batch)
    clicks = parse_lines(file_lines(spark, f"{folder}/in", max_files=1))
    seen = []
    run_available(closed_windows(clicks, 120, 10, late="10 seconds"), lambda df, _: seen.extend(df.collect()), f"{folder}/c")
    over = F.col("end") <= F.lit("2024-01-01 10:08:50").cast("timestamp")
    everything = clicks_of(spark, [*first, ("2024-01-01T10:09:00", 9, 1)])
    assert sorted(map(tuple, seen), key=repr) == rows(ads.sliding_counts(everything, 120, 10).where(over))


def test_stream_over_a_table_of_several_files(spark, folder):
    """A folder of part files, several batches: the same as the batch result."""
    source = "/root/testdata/sf0.001"
    for name in ("nation", "region"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    events = spark.read.parquet(f"{source}/events.parquet").repartition(4)
    events.write.parquet(f"{folder}/events.parquet")
    sink = RunningTrend(f"{folder}/tables")
    stream = sink.running(driver_tables.ad_click_stream(spark, folder, max_files=1))
    query = start(stream, sink, f"{folder}/c", every=None, mode="update")
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 4
    assert rows(sink.totals(spark)) == rows(ads.minute_counts(driver_tables.ad_clicks(spark, folder)))


def job_tables(spark, folder):
    job = AdJob(folder, 2)
    tables = [job.loop.blacklist, job.loop.user_counts, job.loop.stats, job.loop.top, job.trend.trend]
    return [rows(t.latest(spark)) for t in tables]


def test_ad_job(spark, folder):
    """One query, which reads its lines once per batch."""
    batch = random_batches(6, days=1)[0]
    arrive(spark, f"{folder}/in", batch)
    query = start_ad_job(file_lines(spark, f"{folder}/in"), f"{folder}/job", threshold=2, every=None)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 25
    _, _, stats, _, trend = job_tables(spark, f"{folder}/job/tables")
    assert trend == rows(ads.minute_counts(clicks_of(spark, batch)))
    assert stats == rows(ads.stat_counts(clicks_of(spark, batch)))


# The write of each table that fails once, and whether it fails before or after the table is there.
FAILURES = [("user_counts", True), ("stats", True), ("blacklist", True), ("trend", False)]


@pytest.mark.parametrize("table, after", FAILURES)
def test_job_that_fails_between_two_tables(spark, folder, monkeypatch, table, after):
    """The second batch fails in the middle; the query is started again and runs it anew."""
    batches = random_batches(7, days=1)
    failing, failed = AdJob(f"{folder}/failing", 2), []
    whole = AdJob(f"{folder}/whole", 2)
    owner = failing.trend if table == "trend" else failing.loop
    write = getattr(owner, table).write

    def broken(updates, run):
        if run.batch == 1 and not failed:
            failed.append(table)
            if after:
                write(updates, run)
            raise RuntimeError("lost")
        return write(updates, run)

    monkeypatch.setattr(getattr(owner, table), "write", broken)
    for number, batch in enumerate(batches):
        arrive(spark, f"{folder}/in", batch)
        clicks = parse_lines(file_lines(spark, f"{folder}/in"))
        run_available(clicks, whole, f"{folder}/c1")
        if number == 1:
            with pytest.raises(Exception, match="lost"):
                run_available(clicks, failing, f"{folder}/c2")
        run_available(clicks, failing, f"{folder}/c2")
    assert failed and names_in(spark, f"{folder}/failing")
    assert job_tables(spark, f"{folder}/failing") == job_tables(spark, f"{folder}/whole")


def test_shuffle_partitions_hold_in_the_stream(spark, folder):
    arrive(spark, f"{folder}/in", random_batches(7)[0])
    seen = []
    spark.conf.set("spark.sql.shuffle.partitions", 300)
    try:
        clicks = parse_lines(file_lines(spark, f"{folder}/in"))
        run_available(clicks, lambda df, _: seen.append(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), f"{folder}/c")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen == ["300"]


def test_materialize(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    stored = materialize(df, "t")
    assert rows(stored) == rows(df)
    assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
