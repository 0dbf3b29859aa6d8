"""Page conversion along a target flow."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.operators import funnel
from clickloom.params import TaskParams
from clickloom.sources.tables import in_date_range


def page_conversion(
    actions: DataFrame, params: TaskParams, task_id: str, tie: str | None = None
) -> DataFrame:
    """Conversion rate of each step of ``params.target_page_flow``."""
    scan = in_date_range(actions, params)
    flow = params.target_page_flow
    counts = funnel.pair_counts(funnel.page_pairs(scan, tie), flow)
    rates = funnel.conversion(counts, funnel.start_page_views(scan, flow), flow, task_id)
    return funnel.conversion_rows(rates)
