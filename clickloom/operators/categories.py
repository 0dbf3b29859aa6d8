"""Category popularity, and the sessions that click a category most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import predicates as P
from clickloom.functions.text import id_list
from clickloom.operators.skew import top_per_group

KINDS = ("click", "order", "pay")


def _clicks(actions: DataFrame, *keep: str) -> DataFrame:
    return actions.where(P.clicked()).select(*keep, F.col("click_category_id").alias("categoryid"))


def _listed(actions: DataFrame, column: str, *keep: str) -> DataFrame:
    parts = actions.where(F.col(column).isNotNull()).select(
        *keep, F.explode(F.split(column, ",")).alias("part")
    )
    ids = parts.select(*keep, F.trim("part").try_cast("bigint").alias("categoryid"))
    return ids.where(F.col("categoryid").isNotNull())


def click_counts(actions: DataFrame) -> DataFrame:
    """Clicks per category."""
    return _clicks(actions).groupBy("categoryid").agg(F.count(F.lit(1)).alias("clickCount"))


def order_counts(actions: DataFrame) -> DataFrame:
    """Orders per category; an id listed twice counts twice."""
    return (
        _listed(actions, "order_category_ids")
        .groupBy("categoryid")
        .agg(F.count(F.lit(1)).alias("orderCount"))
    )


def pay_counts(actions: DataFrame) -> DataFrame:
    """Payments per category; an id listed twice counts twice."""
    return (
        _listed(actions, "pay_category_ids")
        .groupBy("categoryid")
        .agg(F.count(F.lit(1)).alias("payCount"))
    )


def distinct_categories(actions: DataFrame, one_kind: bool = False) -> DataFrame:
    """Every category clicked, ordered or paid.

    With ``one_kind`` an action counts as one kind only: a click before an order before a
    payment.
    """
    orders, pays = actions, actions
    if one_kind:
        orders = actions.where(~P.clicked())
        pays = orders.where(~P.ordered())
    return (
        _clicks(actions)
        .unionByName(_listed(orders, "order_category_ids"))
        .unionByName(_listed(pays, "pay_category_ids"))
        .distinct()
    )


def category_counts_by_join(actions: DataFrame) -> DataFrame:
    """Three counts per category, as left joins onto the distinct categories."""
    joined = distinct_categories(actions)
    for counts in (click_counts(actions), order_counts(actions), pay_counts(actions)):
        joined = joined.join(counts, "categoryid", "left")
    return joined.na.fill(0, ["clickCount", "orderCount", "payCount"])


def _tagged(kind: str, ids: Column) -> Column:
    return F.transform(ids, lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("categoryid")))


def _kind_rows(actions: DataFrame, *keep: str) -> DataFrame:
    """One row per (action, kind, category), from one scan. The lists are short, one per action."""
    clicked = F.when(P.clicked(), F.array("click_category_id")).otherwise(F.array().cast("array<bigint>"))
    listed = [F.coalesce(id_list(f"{k}_category_ids"), F.array().cast("array<bigint>")) for k in ("order", "pay")]
    tagged = [_tagged(kind, ids) for kind, ids in zip(KINDS, (clicked, *listed))]
    # The outer form: the other one adds a filter that makes the arrays a second time.
    made = actions.select(*keep, F.explode_outer(F.concat(*tagged)).alias("of"))
    return made.where(F.col("of").isNotNull()).select(*keep, "of.kind", "of.categoryid")


def _kind_counts() -> list:
    return [F.count_if(F.col("kind") == kind).alias(f"{kind}Count") for kind in KINDS]


def category_counts(actions: DataFrame) -> DataFrame:
    """The same rows as ``category_counts_by_join`` from one scan and without joins.

    Actions with equal lists are counted first, so a list is taken apart once, not once per action.
    """
    clicked = F.when(P.clicked(), F.col("click_category_id")).alias("click_category_id")
    alike = actions.groupBy(clicked, "order_category_ids", "pay_category_ids").agg(F.count(F.lit(1)).alias("n"))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(f"{kind}Count")
    return _kind_rows(alike, "n").groupBy("categoryid").agg(*[of(kind) for kind in KINDS])


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Three counts per session and category.

    This is what session-filtered results are made from: it leaves a hot session no more
    rows than it has categories before anything is joined on the session.
    """
    return _kind_rows(actions, "session_id").groupBy("session_id", "categoryid").agg(*_kind_counts())


def keep_sessions(counts: DataFrame, sessions: DataFrame) -> DataFrame:
    """Session-category counts of the given sessions (one row each).

    An inner join stays above the counting; Catalyst would move a semi-join below it, onto
    the single actions of a hot session.
    """
    return counts.join(sessions.select("session_id"), "session_id")


def sum_categories(counts: DataFrame) -> DataFrame:
    """Session-category counts summed per category."""
    return counts.groupBy("categoryid").agg(
        *[F.sum(f"{kind}Count").alias(f"{kind}Count") for kind in KINDS]
    )


def order_categories(counts: DataFrame) -> DataFrame:
    """By falling clicks, then orders, then payments; equal ones by id."""
    return counts.orderBy(
        F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), F.asc("categoryid")
    )


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` categories in that order."""
    return order_categories(counts).limit(n)


def category_rows(top: DataFrame, task_id: str) -> DataFrame:
    return top.select(
        F.lit(task_id).alias("taskid"), "categoryid", "clickCount", "orderCount", "payCount"
    )


def in_categories(actions: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """Clicks on the given ``n`` categories."""
    ids = categories.select(F.col("categoryid").alias("click_category_id"))
    return actions.join(ids, "click_category_id", "left_semi")


def category_session_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per category and session."""
    return (
        _clicks(actions, "session_id")
        .groupBy("categoryid", "session_id")
        .agg(F.count(F.lit(1)).alias("clickCount"))
    )


def top_sessions(clicks: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """For each of the ``n`` given categories the ``n`` sessions that click it most."""
    ids = categories.select("categoryid")
    wanted = clicks.where(F.col("clickCount") > 0).join(ids, "categoryid")
    return top_per_group(
        wanted, ["categoryid"], [F.desc("clickCount"), F.asc("session_id")], n
    ).select("categoryid", "session_id", "clickCount")


def top_session_rows(top: DataFrame, task_id: str) -> DataFrame:
    return top.select(
        F.lit(task_id).alias("taskid"),
        "categoryid",
        F.col("session_id").alias("sessionid"),
        "clickCount",
    )


def top_session_actions(
    actions: DataFrame, top: DataFrame, n: int = 10, distinct: bool = False
) -> DataFrame:
    """Actions of the top sessions: once per category that lists the session, or once
    with ``distinct``. ``top`` has ``n`` sessions for each of ``n`` categories."""
    ids = top.select("session_id")
    if distinct:
        return actions.join(ids, "session_id", "left_semi")
    return actions.join(ids, "session_id").select(*actions.columns)
