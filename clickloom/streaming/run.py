"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "5 seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Run ``process`` on each micro-batch; with ``every=None`` take what is there now
    and stop. A streaming aggregate is started in ``update`` mode, and hands on what has changed.
    Shuffles inside go by the session's own settings."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def run_available(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process everything that has arrived, then return."""
    start(stream, process, checkpoint, every=None, mode=mode).awaitTermination()
