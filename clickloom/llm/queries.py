"""One query per operator, each over its whole table, with the production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    byte_bpe, chunk_prints, decontaminate, hmm, hyperplane_tree, mixing, near_dup, prefix_trie, quality, secret_scan, token_counts, toxicity, warc,
)
from clickloom.llm.common import remainder, table
from clickloom.llm.oracles import ORACLES, SEED, TARGETS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Pieces of a public tokenizer; never copied here.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

# Labels of rows with this remainder are never learned from.
TOXIC_HELD_OUT = (3, 1)

__all__ = ["ORACLES", "QUERIES"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(table(spark, sf_dir, "pages"))
    return read.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_key").alias("refers_to"),
    )


def _taught(labels: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    """Labels that may be learned from: those whose remainder by the first number is not the second."""
    return labels.where(remainder("doc_id", held_out[0]) != held_out[1])


def _judged(scored: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    mark = (remainder("doc_id", held_out[0]) == held_out[1]).alias("held_out")
    return scored.select("doc_id", mark, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _taught(table(spark, sf_dir, "labels"), (4, 2))
    return _judged(quality.score_documents(table(spark, sf_dir, "documents"), labels), (4, 2))


@query
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _taught(table(spark, sf_dir, "labels"), TOXIC_HELD_OUT)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _judged(toxicity.score_documents(docs, labels), TOXIC_HELD_OUT)


@query
def op5_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), TARGETS, SEED)
    return mixed.select("doc_id", "copy", "shuffle_key", "source", "text")


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    spelled = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, spelled))
    count = lambda kind: F.size(of(kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(joined(of("assign", "access", "hex")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op7_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_prints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("rep").alias("copy_of"), "class_id")


@query
def op9_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (remainder("doc_id", 7) == 2).alias("held_out")
    return hmm.score_texts(table(spark, sf_dir, "documents"), held_out)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, later = token_counts.piece_vocabulary(VOCABULARY)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), first, later)


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(RANKS)
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, PATTERN)
    spelled = F.concat_ws(",", F.col("ids").cast("array<string>"))
    summed = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"))
    decoded = byte_bpe.decode(summed, ranks)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("data", 256).alias("decoded_sha256"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    rebuilt = prefix_trie.shared_heads(*turns, group=5, heads=remainder("conv", 9))
    return prefix_trie.prefix_trie(*rebuilt)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    index = hyperplane_tree.build_index(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", moved)
    return hyperplane_tree.hard_negatives(index, spark, F.col("id") % 100 == 0)
