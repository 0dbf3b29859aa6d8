"""The session analysis of one run: ratios, sample, top categories, top sessions."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import categories, sampling, sessions
from clickloom.operators.skew import heavy_keys
from clickloom.params import TaskParams
from clickloom.shared import Scratch
from clickloom.sources.tables import in_date_range

Sink = Callable[[str, DataFrame], None]

LISTS = ("search_keywords", "click_category_ids")


def ratio_statistics(
    actions: DataFrame, users: DataFrame, params: TaskParams, task_id: str
) -> DataFrame:
    """Shares of visit and step lengths among the filtered sessions, when nothing else is
    asked: one plan that stores nothing."""
    found = sessions.aggregate_sessions(in_date_range(actions, params), params)
    return sessions.session_ratios(sessions.filtered_histogram(found, users, params), task_id)


class SessionRun:
    """The results of one run, and the relations several of them start from.

    Each shared relation is worked out and written to shared storage when first asked for;
    the actions are then scanned once for it however many results (or parts of one result)
    use it. As a context manager the run removes what it stored at its end; results
    that are read later need a run without one, or ``close`` by hand.
    """

    def __init__(
        self,
        actions: DataFrame,
        users: DataFrame,
        params: TaskParams = TaskParams(),
        total: int = 100,
        seed: str = "42",
    ) -> None:
        self.actions = in_date_range(actions, params)
        self.users = users
        self.params = params
        self.total = total
        self.seed = seed
        self.scratch = Scratch(actions.sparkSession, "session-run")

    def __enter__(self) -> SessionRun:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        """Remove the stored relations; results that read them can be read no more."""
        self.scratch.close()

    @cached_property
    def sessions(self) -> DataFrame:
        """All sessions, without the lists that only sampled ones need."""
        found = sessions.aggregate_sessions(self.actions, self.params).drop(*LISTS)
        return self.scratch.keep(found, "sessions")

    @cached_property
    def filtered(self) -> DataFrame:
        """The sessions the filters keep."""
        heavy = heavy_keys(self.sessions, "user_id")
        kept = sessions.filter_sessions(self.sessions, self.users, self.params, heavy)
        return self.scratch.keep(kept, "filtered")

    @cached_property
    def counts(self) -> DataFrame:
        """Clicks, orders and payments per filtered session and category."""
        found = categories.session_category_counts(self.actions)
        return self.scratch.keep(categories.keep_sessions(found, self.filtered), "counts")

    @cached_property
    def top_categories(self) -> DataFrame:
        found = categories.top_categories(categories.sum_categories(self.counts))
        return self.scratch.keep(found, "categories")

    @cached_property
    def top_sessions(self) -> DataFrame:
        found = categories.top_sessions(self.counts, self.top_categories)
        return self.scratch.keep(found, "top-sessions")

    @cached_property
    def sample(self) -> DataFrame:
        found = sampling.sample_sessions(self.filtered, self.total, self.seed)
        return self.scratch.keep(found, "sample")

    def filtered_actions(self) -> DataFrame:
        """All actions of the filtered sessions."""
        heavy = heavy_keys(self.sessions, "session_id", F.col("step_length"))
        return sessions.session_actions(self.actions, self.filtered, heavy)

    def sampled_actions(self) -> DataFrame:
        return sampling.sample_actions(self.actions, self.sample, self.total)

    def ratios(self, task_id: str) -> DataFrame:
        return sessions.session_ratios(sessions.session_histogram(self.filtered), task_id)

    def random_extract(self, task_id: str) -> DataFrame:
        return sampling.extract_rows(self.sampled_actions(), task_id)

    def random_detail(self, task_id: str) -> DataFrame:
        return sessions.session_detail(self.sampled_actions(), task_id)

    def category_rows(self, task_id: str) -> DataFrame:
        return categories.category_rows(self.top_categories, task_id)

    def top_session_rows(self, task_id: str) -> DataFrame:
        return categories.top_session_rows(self.top_sessions, task_id)

    def top_session_detail(self, task_id: str) -> DataFrame:
        found = categories.top_session_actions(self.actions, self.top_sessions)
        return sessions.session_detail(found, task_id)

    def tables(self, task_id: str) -> dict[str, DataFrame]:
        """All results, by result table."""
        return {
            "session_aggr_stat": self.ratios(task_id),
            "session_random_extract": self.random_extract(task_id),
            "session_detail": self.random_detail(task_id),
            "top10_category": self.category_rows(task_id),
            "top10_session": self.top_session_rows(task_id),
            "top10_session_detail": self.top_session_detail(task_id),
        }

    def run(self, task_id: str, sink: Sink) -> None:
        """Give every result to ``sink(table, rows)``."""
        for table, rows in self.tables(task_id).items():
            sink(table, rows)
