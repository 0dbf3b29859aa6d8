"""Top products of each sales area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from clickloom.operators import regions
from clickloom.params import TaskParams
from clickloom.sources.tables import click_scan


def area_top_products(
    actions: DataFrame,
    products: DataFrame,
    cities: DataFrame,
    params: TaskParams,
    task_id: str,
    levels: Mapping[str, str] = regions.AREA_LEVELS,
    labels: tuple[str, str] = regions.STATUS_LABELS,
    n: int = 3,
) -> DataFrame:
    """The ``n`` most-clicked products of each area, laid out by area."""
    clicks = regions.area_product_clicks(click_scan(actions, params), cities)
    full = regions.add_products(clicks, products, labels)
    top = regions.lay_out(regions.top_products(full, n, levels), ["area"])
    return regions.product_rows(top, task_id)
