"""Places on shared storage, and cutting long lineages there."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


# Masters whose driver and executors are one process.
LOCAL = re.compile(r"local(\[[^\]]*\])?")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, a place that driver and executors share. Where that is unset
    and all run in one process the warehouse is taken; on a cluster it must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not LOCAL.fullmatch(spark.sparkContext.master):
            raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/clickloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet on shared storage and read it back.

    Used for a relation several results of one run start from: later scans stay
    columnar and prunable, and a lost executor costs no recomputation.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one run below one folder on shared storage, which goes with ``close``."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, label)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = f"{self.folder}/{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove(self.spark, self.folder)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none if it does not exist."""
    files, place = _place(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)
