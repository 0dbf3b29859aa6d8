"""What several operators share: Arrow batches in and out, word ids, hashes, free names."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Texts handled at once in a task, in characters (a longer text is handled alone).
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(column: str, n: int) -> Column:
    """``crc32`` of the value as text, modulo ``n``; a null counts as the empty text."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(as_text.cast("binary")), F.lit(n))


def slices(chars: list[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts, by their lengths, with at most ``limit`` characters, or of one longer text."""
    start = size = 0
    for i, own in enumerate(chars):
        if i > start and size + own > limit:
            yield start, i
            start, size = i, 0
        size += own
    if start < len(chars):
        yield start, len(chars)


def text_slices(texts: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """The runs with their texts (a null is empty), of which one run is in memory at a time."""
    chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    for start, stop in slices(chars, limit):
        yield start, stop, [t or "" for t in texts.slice(start, stop - start).to_pylist()]


def per_slice(
    df: DataFrame, text: str, schema: StructType, work: Callable[[list[str]], dict[str, Any]], keep: list[str]
) -> DataFrame:
    """The ``keep`` columns of ``df`` and the columns that ``work`` makes of a list of texts
    (a null text counts as empty); ``schema`` has the new ones, which get underscores before their names where
    ``keep`` has such columns. No row is added or lost."""
    made = to_arrow_schema(schema)
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    names = [fresh(kept, name) for name in schema.fieldNames()]
    inner = [f"c{i}" for i in range(len(keep))]
    source = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner)], F.col(f"`{text}`").cast("string").alias("text"))
    result = StructType(source.schema.fields[: len(keep)] + schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_slices(batch.column(len(inner))):
                out = work(texts)
                new = [pa.array(out[f.name], type=f.type) for f in made]
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(inner))]
                yield pa.RecordBatch.from_arrays(kept + new, names=inner + made.names)

    return source.mapInArrow(run, result).toDF(*keep, *names)


class WordIds(dict):
    """Numbers words in order of their first lookup; ``words`` lists them."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list = []

    def __missing__(self, word):
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def hash64(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def hashes64(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((hash64(w) for w in words), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finisher of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
