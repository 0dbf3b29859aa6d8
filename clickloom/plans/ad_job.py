"""The ad click stream job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.ads import PROVINCE_KEYS
from clickloom.sources.ad_log import parse_lines
from clickloom.streaming.ads import THRESHOLD, BlacklistLoop, ClickTrend
from clickloom.streaming.run import start


class AdJob:
    """One micro-batch of the job: the parsed clicks are kept, and feed the blacklist loop with the statistics and top
    ads, and the click trend, which takes all clicks."""

    def __init__(self, folder: str, threshold: int = THRESHOLD, top_partition: Sequence[str] = tuple(PROVINCE_KEYS)) -> None:
        self.loop = BlacklistLoop(folder, threshold, top_partition=top_partition)
        self.trend = ClickTrend(folder)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self.loop(batch, batch_id)
            self.trend(batch, batch_id)
        finally:
            batch.unpersist()


def start_ad_job(
    lines: DataFrame,
    folder: str,
    threshold: int = THRESHOLD,
    top_partition: Sequence[str] = tuple(PROVINCE_KEYS),
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Start the job on a stream of log lines, as one query that reads and parses each line once.

    Result tables and the checkpoint are kept below ``folder``, on shared storage. The tables outlive
    the checkpoint: under a new one their counts go on.
    """
    job = AdJob(f"{folder}/tables", threshold, top_partition)
    return start(parse_lines(lines), job, f"{folder}/checkpoint", every=every)
