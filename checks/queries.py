"""One query per operator or job, each over the whole tables of a folder.

The jobs' constants (dates, filters, thresholds) are here, so that queries and their SQL
counterparts share them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import predicates as P
from clickloom.functions import text, times
from clickloom.functions.sql import register_sql_functions
from clickloom.operators import ads, categories, funnel, regions, sampling, sessions, upsert
from clickloom.params import TaskParams
from clickloom.plans.ad_job import start_ad_job
from clickloom.plans.funnel_job import page_conversion as page_conversion_job
from clickloom.plans.region_job import area_top_products
from clickloom.plans.session_jobs import SessionRun, ratio_statistics
from clickloom.shared import shared_folder
from clickloom.sources import ad_log, tables
from clickloom.sources import driver_tables as D
from clickloom.sources.sinks import replace_table
from clickloom.streaming.ads import BlacklistLoop, ClickTrend, RunningCounts, RunningPanes, RunningStats, RunningTrend
from clickloom.streaming.run import run_available

TASK = "task-1"
RANGE = TaskParams(start_date="2024-01-05", end_date="2024-01-25")
FILTER = TaskParams(
    start_age=5,
    end_age=54,
    professionals="BUILDING,MACHINERY,AUTOMOBILE,HOUSEHOLD",
    keywords="kw1,kw3,kw5,kw7,kw9",
)
ALL_SIX = TaskParams(
    start_age=5,
    end_age=54,
    professionals="BUILDING,MACHINERY,AUTOMOBILE,HOUSEHOLD",
    cities=",".join(f"city{i}" for i in range(20)),
    sex="male",
    keywords="kw0,kw2,kw4,kw6,kw8",
    category_ids=",".join(str(i) for i in range(15)),
)
FLOW = "1,2,3,4,5,6,7"
SAMPLE = 1500
SEED = "42"
THRESHOLD = 2
SPLIT = "2024-01-16"
# First day after each batch of the replayed stream; the last batch is open.
BATCH_ENDS = ("2024-01-11", "2024-01-21")
WINDOW = (3600, 600)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _sessions(spark: SparkSession, sf: str, params: TaskParams = TaskParams()) -> DataFrame:
    return sessions.aggregate_sessions(D.actions(spark, sf, params), params)


def _run(spark: SparkSession, sf: str, params: TaskParams = FILTER) -> SessionRun:
    return SessionRun(D.actions(spark, sf, params), D.users(spark, sf), params, SAMPLE, SEED)


# --- scans ---------------------------------------------------------------------------


@query
def action_date_range(spark, sf):
    found = tables.in_date_range(D.actions(spark, sf, RANGE), RANGE)
    return found.withColumn("action_time", times.format_time("action_time"))


@query
def click_scan(spark, sf):
    return tables.click_scan(D.actions(spark, sf))


@query
def user_scan(spark, sf):
    return D.users(spark, sf)


@query
def product_scan(spark, sf):
    return D.products(spark, sf)


@query
def city_scan(spark, sf):
    return D.cities(spark, sf)


@query
def table_preview(spark, sf):
    return tables.preview(D.users(spark, sf), ["user_id"], 20)


# --- sessions ------------------------------------------------------------------------


@query
def session_aggregate(spark, sf):
    return sessions.format_sessions(_sessions(spark, sf))


@query
def session_user_join(spark, sf):
    joined = sessions.join_users(_sessions(spark, sf), D.users(spark, sf))
    return sessions.format_sessions(joined)


@query
def session_filter(spark, sf):
    found = _sessions(spark, sf, ALL_SIX)
    return sessions.format_sessions(sessions.filter_sessions(found, D.users(spark, sf), ALL_SIX))


@query
def predicate_matrix(spark, sf):
    joined = sessions.join_users(_sessions(spark, sf), D.users(spark, sf))
    p = ALL_SIX
    tests = {
        "age": P.in_range("age", p.start_age, p.end_age),
        "age_one_bound": P.in_range("age", p.start_age, None),
        "professional": P.one_of("professional", p.professionals),
        "city": P.one_of("city", p.cities),
        "sex": P.equals("sex", p.sex),
        "sex_unset": P.equals("sex", ""),
        "keywords": P.any_of("search_keywords", p.keywords),
        "categories": P.any_of("click_category_ids", p.category_ids),
    }
    return joined.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


@query
def session_histogram(spark, sf):
    return sessions.session_histogram(_sessions(spark, sf))


@query
def session_ratio_stat(spark, sf):
    return ratio_statistics(D.actions(spark, sf), D.users(spark, sf), FILTER, TASK)


@query
def filtered_actions(spark, sf):
    return sessions.session_detail(_run(spark, sf).filtered_actions(), TASK)


# --- sample --------------------------------------------------------------------------


@query
def hour_quota(spark, sf):
    return sampling.hour_quota(_sessions(spark, sf), SAMPLE)


@query
def session_sample(spark, sf):
    return _run(spark, sf, TaskParams()).random_extract(TASK)


@query
def session_sample_detail(spark, sf):
    return _run(spark, sf, TaskParams()).random_detail(TASK)


# --- categories ----------------------------------------------------------------------


@query
def category_click_count(spark, sf):
    return categories.click_counts(D.actions(spark, sf))


@query
def category_order_count(spark, sf):
    return categories.order_counts(D.actions(spark, sf))


@query
def category_pay_count(spark, sf):
    return categories.pay_counts(D.actions(spark, sf))


@query
def category_distinct(spark, sf):
    return categories.distinct_categories(D.actions(spark, sf))


@query
def category_distinct_one_kind(spark, sf):
    return categories.distinct_categories(D.actions(spark, sf), one_kind=True)


@query
def category_counts_joined(spark, sf):
    return categories.category_counts_by_join(D.actions(spark, sf))


@query
def category_counts(spark, sf):
    return categories.category_counts(D.actions(spark, sf))


@query
def categories_in_order(spark, sf):
    return categories.order_categories(categories.category_counts(D.actions(spark, sf)))


@query
def top10_category(spark, sf):
    return _run(spark, sf).category_rows(TASK)


@query
def category_session_clicks(spark, sf):
    return categories.category_session_clicks(D.actions(spark, sf))


@query
def clicks_in_top_categories(spark, sf):
    actions = D.actions(spark, sf)
    top = categories.top_categories(categories.category_counts(actions))
    clicks = categories.in_categories(actions, top)
    return clicks.select("event_id", "session_id", "click_category_id")


@query
def top10_session(spark, sf):
    return _run(spark, sf).top_session_rows(TASK)


@query
def top10_session_detail(spark, sf):
    return _run(spark, sf).top_session_detail(TASK)


# --- funnel --------------------------------------------------------------------------


@query
def flow_steps(spark, sf):
    flow = F.concat_ws(",", F.col("page_id").cast("string"), "order_category_ids", F.col("city_id").cast("string"))
    return funnel.split_flow(D.actions(spark, sf).select(flow.alias("flow")), "flow")


@query
def page_pairs(spark, sf):
    return funnel.page_pairs(D.actions(spark, sf), "event_id")


@query
def page_pairs_newest_first(spark, sf):
    return funnel.page_pairs(D.actions(spark, sf), "event_id", newest_first=True)


@query
def page_pair_counts(spark, sf):
    return funnel.pair_counts(funnel.page_pairs(D.actions(spark, sf), "event_id"), FLOW)


@query
def start_page_pv(spark, sf):
    return funnel.start_page_views(D.actions(spark, sf), FLOW)


@query
def page_conversion(spark, sf):
    return page_conversion_job(
        D.actions(spark, sf), TaskParams(target_page_flow=FLOW), TASK, "event_id"
    )


@query
def page_conversion_text(spark, sf):
    actions = D.actions(spark, sf)
    counts = funnel.pair_counts(funnel.page_pairs(actions, "event_id"), FLOW)
    rates = funnel.conversion(counts, funnel.start_page_views(actions, FLOW), FLOW, TASK)
    return funnel.conversion_text(rates)


# --- regions -------------------------------------------------------------------------


@query
def click_city_join(spark, sf):
    return regions.join_cities(tables.click_scan(D.actions(spark, sf)), D.cities(spark, sf))


@query
def area_product_clicks(spark, sf):
    return regions.area_product_clicks(
        tables.click_scan(D.actions(spark, sf)), D.cities(spark, sf)
    )


@query
def area_product_full(spark, sf):
    return regions.add_products(
        area_product_clicks(spark, sf), D.products(spark, sf), regions.STATUS_LABELS_CHINESE
    )


@query
def area_top3(spark, sf):
    return area_top_products(
        D.actions(spark, sf),
        D.products(spark, sf),
        D.cities(spark, sf),
        TaskParams(),
        TASK,
        D.LEVELS,
    )


# --- functions -----------------------------------------------------------------------


def _records(spark, sf):
    """One ``k=v|k=v`` record per user."""
    return D.users(spark, sf).select(
        "user_id",
        F.concat(
            F.lit("name="), "name", F.lit("|empty=|age="), F.col("age").cast("string"),
            F.lit("|professional="), "professional", F.lit("|sex="), "sex",
        ).alias("record"),
    )


@query
def kv_get(spark, sf):
    fields = ("name", "empty", "age", "sex", "fessional")
    return _records(spark, sf).select(
        "user_id", *[text.kv_get("record", f).alias(f"get_{f}") for f in fields]
    )


@query
def kv_set(spark, sf):
    return _records(spark, sf).select(
        "user_id",
        text.kv_set("record", "age", "99").alias("set_age"),
        text.kv_set("record", "sex", F.lit("x")).alias("set_sex"),
        text.kv_set("record", "absent", "1").alias("set_absent"),
    )


@query
def date_functions(spark, sf):
    actions = D.actions(spark, sf)
    time = F.col("action_time")
    unpadded = F.date_format(time, "yyyy-MM-dd H:mm:ss")
    noon = F.concat(F.col("date"), F.lit(" 12:00:00"))
    key_date, hour, minute = times.minute_key_parts(times.format_minute(time))
    return actions.select(
        "event_id",
        times.before(unpadded, noon).alias("is_before"),
        times.after(unpadded, noon).alias("is_after"),
        times.minus(unpadded, noon).alias("seconds"),
        times.date_hour(unpadded).alias("hour_key"),
        times.format_date(time).alias("day"),
        times.format_time(unpadded).alias("full_time"),
        times.format_date_key(time).alias("day_key"),
        times.format_minute(time).alias("minute_key"),
        F.date_format(times.parse_date_key(times.format_date_key(time)), "yyyy-MM-dd").alias(
            "parsed_day"
        ),
        key_date.alias("key_date"),
        hour.alias("key_hour"),
        minute.alias("key_minute"),
    )


@query
def string_functions(spark, sf):
    users = D.users(spark, sf)
    age = F.col("age").cast("string")
    edged = F.concat(F.lit(","), F.col("sex"), F.lit(","))
    return users.select(
        "user_id",
        text.is_empty(F.nullif("sex", F.lit("male"))).alias("is_empty"),
        text.is_not_empty("professional").alias("is_not_empty"),
        text.trim_comma(edged).alias("trimmed"),
        text.trim_comma("city").alias("untouched"),
        text.pad_two(age).alias("padded"),
        F.array_join(text.id_list(F.concat_ws(",", age, F.lit("x"), "user_id")), "+").alias("ids"),
        text.join_id_name("user_id", "city").alias("id_name"),
    )


@query
def json_field(spark, sf):
    return D.products(spark, sf).select(
        "product_id",
        text.json_field("extend_info", "product_status").alias("status"),
        text.json_field("extend_info", "absent").alias("absent"),
    )


@query
def number_round(spark, sf):
    value = F.col("value") / 8
    return D.table(spark, sf, "events").select(
        "event_id",
        text.round_half_up(value).alias("two"),
        text.round_half_up(value, 1).alias("one"),
        text.round_half_up(value, 0).alias("none"),
    )


@query
def sql_functions(spark, sf):
    register_sql_functions(spark)
    return spark.sql(
        """SELECT area, product_id, count(*) AS click_count,
                  listagg(DISTINCT city, ',') WITHIN GROUP (ORDER BY city) AS city_infos,
                  concat_distinct(collect_list(city)) AS city_infos_again,
                  max(if(get_json_field(extend_info, 'product_status') = '0',
                         'Self', 'Third Party')) AS product_status
           FROM (SELECT *, concat_long_string(city_id, city_name, ':') AS city
                 FROM {clicks} JOIN {cities} USING (city_id))
           JOIN {products} ON click_product_id = product_id
           GROUP BY area, product_id""",
        clicks=tables.click_scan(D.actions(spark, sf)),
        cities=D.cities(spark, sf),
        products=D.products(spark, sf),
    )


# --- ads, as batch -------------------------------------------------------------------


def _no_spaces(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("province", F.translate("province", " ", "_"))


@query
def ad_parse(spark, sf):
    lines = ad_log.format_lines(_no_spaces(D.ad_clicks(spark, sf)))
    return ad_log.parse_lines(lines).withColumn("ts", F.unix_millis("ts"))


@query
def ad_user_click_count(spark, sf):
    return ads.user_counts(D.ad_clicks(spark, sf))


@query
def ad_current_count(spark, sf):
    clicks = ads.with_date(D.ad_clicks(spark, sf))
    stored = ads.count_by(clicks.where(F.col("date") < SPLIT), ads.USER_KEYS)
    return ads.current_counts(clicks.select(*ads.USER_KEYS).distinct(), stored)


@query
def ad_users_over(spark, sf):
    return ads.users_over(ads.user_counts(D.ad_clicks(spark, sf)), THRESHOLD)


def _daily_batches(spark, sf):
    return ads.with_date(D.ad_clicks(spark, sf)).withColumn("batch", F.col("date"))


@query
def ad_blacklist(spark, sf):
    return ads.listing_batches(_daily_batches(spark, sf), THRESHOLD)


@query
def ad_filtered_clicks(spark, sf):
    kept = ads.replay_blacklist(_daily_batches(spark, sf), THRESHOLD, ["event_id"])
    return kept.select("event_id", "date", "province", "city", "userid", "adid")


@query
def ad_drop_listed(spark, sf):
    clicks = ads.with_date(D.ad_clicks(spark, sf))
    listed = ads.users_over(ads.user_counts(clicks.where(F.col("date") < SPLIT)), THRESHOLD)
    left = ads.drop_listed(ads.count_by(clicks, ["userid", *ads.STAT_KEYS]), listed)
    return ads.sum_by(left, ads.STAT_KEYS)


@query
def ad_province_counts(spark, sf):
    stats = ads.stat_counts(D.ad_clicks(spark, sf))
    return ads.sum_by(stats, ["date", "province", "adid"])


@query
def ad_top3_by_province_only(spark, sf):
    return ads.top_ads(ads.stat_counts(D.ad_clicks(spark, sf)), 3, ["province"])


@query
def ad_trend_recent(spark, sf):
    return ads.minute_counts(ads.last_minutes(D.ad_clicks(spark, sf), 60))


@query
def ad_stored_trend_recent(spark, sf):
    return ads.recent(ads.minute_counts(D.ad_clicks(spark, sf)), 1440)


@query
def ad_sliding_window(spark, sf):
    counts = ads.sliding_counts(D.ad_clicks(spark, sf), *WINDOW)
    return counts.select(
        F.unix_seconds("start").alias("start_s"), F.unix_seconds("end").alias("end_s"),
        "adid", "clickCount",
    )


# --- ads, as streams -----------------------------------------------------------------


def _run_counts(spark, sf, counts: RunningCounts, folder: str) -> RunningCounts:
    stream = counts.running(D.ad_click_stream(spark, sf))
    run_available(stream, counts, f"{folder}/checkpoint", mode="update")
    return counts


@query
def ad_stat(spark, sf):
    folder = shared_folder(spark, "ad-stat")
    return _run_counts(spark, sf, RunningStats(folder), folder).totals(spark)


@query
def ad_province_top3(spark, sf):
    folder = shared_folder(spark, "ad-stat")
    return _run_counts(spark, sf, RunningStats(folder), folder).top.latest(spark)


@query
def ad_click_trend(spark, sf):
    folder = shared_folder(spark, "ad-trend")
    return _run_counts(spark, sf, RunningTrend(folder), folder).totals(spark)


@query
def ad_sliding_stream(spark, sf):
    folder = shared_folder(spark, "ad-panes")
    panes = _run_counts(spark, sf, RunningPanes(folder, ads.pane_seconds(*WINDOW)), folder).totals(spark)
    counts = ads.slide_panes(panes, *WINDOW)
    return counts.select(
        F.unix_seconds("start").alias("start_s"), F.unix_seconds("end").alias("end_s"),
        "adid", "clickCount",
    )


def _run_loop(spark, sf) -> BlacklistLoop:
    """Feed the click log to the blacklist loop in three pieces, stopping and restarting the
    query in between."""
    folder = shared_folder(spark, "ad-loop")
    loop = BlacklistLoop(f"{folder}/tables", THRESHOLD)
    clicks = ads.with_date(_no_spaces(D.ad_clicks(spark, sf)))
    bounds = [None, *BATCH_ENDS, None]
    for start, end in zip(bounds, bounds[1:]):
        piece = clicks
        if start:
            piece = piece.where(F.col("date") >= start)
        if end:
            piece = piece.where(F.col("date") < end)
        ad_log.format_lines(piece).write.mode("append").text(f"{folder}/incoming")
        lines = ad_log.file_lines(spark, f"{folder}/incoming")
        run_available(ad_log.parse_lines(lines), loop, f"{folder}/checkpoint")
    return loop


@query
def ad_loop_blacklist(spark, sf):
    return _run_loop(spark, sf).blacklist.latest(spark)


@query
def ad_loop_stat(spark, sf):
    return _run_loop(spark, sf).stats.latest(spark)


@query
def ad_loop_top3(spark, sf):
    return _run_loop(spark, sf).top.latest(spark)


def _run_job(spark, sf) -> str:
    """The whole ad job over the click log; its folder of tables."""
    folder = shared_folder(spark, "ad-job")
    ad_log.format_lines(_no_spaces(D.ad_clicks(spark, sf))).write.text(f"{folder}/incoming")
    lines = ad_log.file_lines(spark, f"{folder}/incoming")
    start_ad_job(lines, folder, THRESHOLD, every=None).awaitTermination()
    return f"{folder}/tables"


@query
def ad_job_user_counts(spark, sf):
    return BlacklistLoop(_run_job(spark, sf)).user_counts.latest(spark)


@query
def ad_job_trend(spark, sf):
    return ClickTrend(_run_job(spark, sf)).trend.latest(spark)


# --- keyed updates and tables --------------------------------------------------------


def _halves(spark, sf):
    clicks = ads.with_date(D.ad_clicks(spark, sf))
    return clicks.where(F.col("date") < SPLIT), clicks.where(F.col("date") >= SPLIT)


@query
def upsert_increment(spark, sf):
    keys = ["userid", "adid"]
    first, second = (ads.count_by(half, keys) for half in _halves(spark, sf))
    return upsert.upsert(first, second, keys, upsert.INCREMENT)


@query
def upsert_overwrite(spark, sf):
    keys = ["userid", "adid"]
    first, second = (ads.count_by(half, keys) for half in _halves(spark, sf))
    return upsert.upsert(first, second, keys, upsert.OVERWRITE)


@query
def upsert_replace_group(spark, sf):
    first, second = (
        ads.count_by(half, ["userid", "adid"]) for half in _halves(spark, sf)
    )
    return upsert.upsert(first, second, ["userid"], upsert.REPLACE_GROUP)


@query
def insert_new_only(spark, sf):
    first, second = (
        half.select("userid", "adid").distinct() for half in _halves(spark, sf)
    )
    return first.unionByName(upsert.new_rows(first, second, ["userid", "adid"]))


@query
def table_replace(spark, sf):
    path = shared_folder(spark, "user-info")
    name = f"user_info_{path.rsplit('-', 1)[-1]}"
    replace_table(D.cities(spark, sf), name, path)
    replace_table(D.users(spark, sf), name, path)
    return spark.table(name)
