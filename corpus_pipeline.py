"""A corpus pipeline: each stage works on what its predecessor kept.

Every stage takes and returns a table with the columns of ``documents`` (the last adds its own), and
is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontaminate, mixing, near_dup, secret_scan, toxicity
from clickloom.llm.common import table
from clickloom.llm.oracles import SEED, TARGETS
from clickloom.shared import materialize

# No stage before the last can be said in SQL; the run is tested against brute force.
ORACLE_SQL = None


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity bound; learned from all ``labels``."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return near_dup.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that ask no benchmark item, with the same values or others."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets covered."""
    return secret_scan.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks, in random order."""
    return mixing.mix_sources(docs, TARGETS, SEED)


STAGES = [
    ("toxicity", toxicity_filter),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
