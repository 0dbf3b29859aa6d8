"""Where results go."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    batch_size: int = 1000,
    connections: int = 10,
) -> None:
    """Append to (or, with ``mode="overwrite"``, replace) a database table, over at most
    ``connections`` connections at a time."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .options(**(properties or {}))
        .mode(mode)
        .save()
    )


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Replace a catalog table, stored at ``path`` or in the warehouse."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
