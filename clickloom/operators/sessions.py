"""Session aggregate, session filter, and the length distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import predicates as P
from clickloom.functions.text import group_concat_distinct, round_half_up
from clickloom.functions.times import format_time, parse_time
from clickloom.operators.skew import heavy_keys, salted_join
from clickloom.params import TaskParams

_WANTED = "wanted"  # metadata of a match column

# Result column, lower bound, upper bound (none: open), both inclusive.
# A session of zero seconds is in no visit-length bucket.
VISIT_LENGTHS = (
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
)
STEP_LENGTHS = (
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
)
BUCKETS = tuple(
    (name, column, low, high)
    for column, bounds in (("visit_length", VISIT_LENGTHS), ("step_length", STEP_LENGTHS))
    for name, low, high in bounds
)


def aggregate_sessions(actions: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """One row per session.

    Whether a session matches the keyword and category filters is decided by an aggregate
    of its own, so plans that need only the match never gather the lists. The match columns
    say in their metadata which values they were made for. The lists of a session are one value: a
    session with very many different keywords has one very long row.
    """
    time = parse_time("action_time")
    keyword = F.nullif("search_keyword", F.lit(""))
    category = F.when(P.clicked(), F.col("click_category_id"))
    categories = F.array_join(F.array_sort(F.collect_set(category)), ",")
    return actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        group_concat_distinct(keyword).alias("search_keywords"),
        F.nullif(categories, F.lit("")).alias("click_category_ids"),
        F.min(time).alias("start_time"),
        F.timestamp_diff("SECOND", F.min(time), F.max(time)).alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
        _match(keyword, params.keywords, "keyword_match"),
        _match(category, params.category_ids, "category_match"),
    )


def _match(value: Column, wanted: str | None, name: str) -> Column:
    return F.bool_or(P.one_of(value, wanted)).alias(name, metadata={_WANTED: wanted or ""})


def user_filter(params: TaskParams) -> Column:
    """The conditions on the user."""
    return (
        P.in_range("age", params.start_age, params.end_age)
        & P.one_of("professional", params.professionals)
        & P.one_of("city", params.cities)
        & P.equals("sex", params.sex)
    )


def session_filter(sessions: DataFrame, params: TaskParams) -> Column:
    """The conditions on what happened in the session.

    A match column is used if it was made for the same values; else the session's list is looked
    through, and without a list there is no telling.
    """
    return _matches(sessions, "keyword_match", "search_keywords", params.keywords) & _matches(
        sessions, "category_match", "click_category_ids", params.category_ids
    )


def _matches(sessions: DataFrame, match: str, values: str, wanted: str | None) -> Column:
    if match in sessions.columns and sessions.schema[match].metadata.get(_WANTED) == (wanted or ""):
        return F.col(match)
    if values in sessions.columns or not wanted:
        return P.any_of(values, wanted)
    raise ValueError(f"sessions have neither {values} nor {match} for {wanted!r}")


def join_users(sessions: DataFrame, users: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Add age, professional, city and sex; sessions of unknown users drop.

    ``heavy`` are the users with very many sessions, where these are stored and so cheaply counted.
    Without them the sessions are made once, and adaptive execution splits a hot user's partition.
    """
    users = users.select("user_id", "age", "professional", "city", "sex")
    if heavy is None:
        return sessions.join(users, "user_id")
    return salted_join(sessions, users, "user_id", "inner", heavy, ["session_id"])


def filter_sessions(
    sessions: DataFrame, users: DataFrame, params: TaskParams, heavy: DataFrame | None = None
) -> DataFrame:
    """Sessions, with their user's columns, that satisfy all six conditions."""
    kept = sessions.where(session_filter(sessions, params))
    return join_users(kept, users.where(user_filter(params)), heavy)


def format_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with the start time as text."""
    return sessions.withColumn("start_time", format_time("start_time")).drop(
        "keyword_match", "category_match"
    )


def _bucket(column: str, low: int, high: int | None) -> Column:
    value = F.col(column)
    return value >= low if high is None else value.between(low, high)


def _bucket_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("session_count")] + [
        F.count_if(_bucket(column, low, high)).alias(name) for name, column, low, high in BUCKETS
    ]


def session_histogram(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions, and of those in each length bucket."""
    return sessions.agg(*_bucket_counts())


def filtered_histogram(sessions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """``session_histogram(filter_sessions(...))``, counted per user before the join.

    A user's sessions meet in one row on the map side, so a user with a third of all
    sessions joins as cheaply as any other. The join is an inner one because Catalyst moves a
    semi-join below the aggregate, back onto the single sessions.
    """
    names = ["session_count"] + [name for name, *_ in BUCKETS]
    per_user = sessions.where(session_filter(sessions, params)).groupBy("user_id").agg(*_bucket_counts())
    kept = per_user.join(users.where(user_filter(params)).select("user_id"), "user_id")
    return kept.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def session_ratios(histogram: DataFrame, task_id: str) -> DataFrame:
    """Shares of the buckets, to two decimals; zero when there are no sessions."""
    total = F.col("session_count")
    shares = [
        F.coalesce(round_half_up(F.try_divide(F.col(name).cast("double"), total)), F.lit(0.0)).alias(
            f"{name}_ratio"
        )
        for name, *_ in BUCKETS
    ]
    return histogram.select(F.lit(task_id).alias("taskid"), total, *shares)


def session_actions(
    actions: DataFrame, sessions: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """The actions of the given sessions.

    ``heavy`` are the heavy sessions among the actions, given or not: where all sessions
    have been aggregated already, ``heavy_keys`` of their step lengths saves a pass.
    """
    if heavy is None:
        heavy = heavy_keys(actions, "session_id")
    spread = [c for c in actions.columns if c != "session_id"]
    return salted_join(
        actions, sessions.select("session_id"), "session_id", "left_semi", heavy, spread
    )


def session_detail(actions: DataFrame, task_id: str) -> DataFrame:
    """The action columns a result table keeps."""
    return actions.select(
        F.lit(task_id).alias("taskid"),
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        format_time("action_time").alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"),
    )
