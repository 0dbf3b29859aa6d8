"""Document quality by random indexing and a small neural network.

Each token has a sparse random index vector that its hash gives. Adding up the index vectors of a
word's neighbours over the whole corpus gives the word's vector; a document is pooled from the
vectors of its tokens, and a two-layer network tells its quality, with a temperature that
calibrates the probabilities on rows the network has not learned from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructType

from clickloom.llm.common import WordIds, mix, per_slice, text_slices
from clickloom.shared import materialize

# Words share this many vectors by their hash, so the model is 1 MB however large the vocabulary.
BUCKETS = 8192
WIDTH = 32
NONZERO = 2
REACH = 2  # neighbours on each side
HIDDEN = 16
# Labelled rows that the network learns from, on average at most (a hash draws them).
SAMPLE_ROWS = 20_000
# One drawn row in this many calibrates; the network sees the others.
CALIBRATION = 5

# Letters, digits and runs of one mark are tokens; case stays.
TOKEN = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")

# Pooled: mean and spread of the vectors, length of the mean, share of repeated tokens, log of the count.
POOLED = 2 * WIDTH + 3


def tokenise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of all texts in a row, hashes of the numbered tokens, tokens of each text."""
    ids = WordIds()
    numbers = [list(map(ids.__getitem__, (m[0] for m in TOKEN.finditer(t)))) for t in texts]
    flat = np.fromiter((i for n in numbers for i in n), dtype=np.int64, count=sum(map(len, numbers)))
    codes = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in ids.words), np.uint64, count=len(ids.words))
    return flat, mix(codes + np.uint64(1)), np.array([len(n) for n in numbers], dtype=np.int64)


def buckets(codes: np.ndarray) -> np.ndarray:
    return (codes % np.uint64(BUCKETS)).astype(np.int64)


def add_contexts(table: np.ndarray, texts: list[str]) -> None:
    """Add the neighbours' index vectors to the rows of ``table`` (``BUCKETS`` x ``WIDTH``)."""
    flat, codes, sizes = tokenise(texts)
    if not len(flat):
        return
    bucket, owner = buckets(codes)[flat], np.repeat(np.arange(len(sizes)), sizes)
    total = np.zeros(BUCKETS * WIDTH)
    for k in range(NONZERO):
        draw = mix(codes + np.uint64(1000 + k))
        at = (draw % np.uint64(WIDTH)).astype(np.int64)[flat]
        sign = np.where(draw >> np.uint64(63), 1.0, -1.0)[flat]
        for step in range(1, REACH + 1):
            same = owner[step:] == owner[:-step]
            for word, near in ((slice(None, -step), slice(step, None)), (slice(step, None), slice(None, -step))):
                cell = bucket[word][same] * WIDTH + at[near][same]
                total += np.bincount(cell, weights=sign[near][same], minlength=len(total))
    table += total.reshape(BUCKETS, WIDTH)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets over all texts of ``docs``, less their common direction.

    A task adds up its own texts and sends one row per bucket; ``BUCKETS`` rows reach the driver.
    """
    schema = StructType().add("bucket", IntegerType())
    for i in range(WIDTH):
        schema = schema.add(f"v{i}", DoubleType())
    names = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, WIDTH))
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                add_contexts(table, texts)
        used = np.flatnonzero(np.abs(table).sum(axis=1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(table[used, i]) for i in range(WIDTH))], schema=names)

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    sums = parts.groupBy("bucket").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(WIDTH)])
    table = np.zeros((BUCKETS, WIDTH))
    for row in sums.collect():
        table[row[0]] = row[1:]
    return unit(unit(table) - unit(table).mean(axis=0)).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-9)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """One row of ``POOLED`` numbers per text; an empty text has zeros."""
    flat, codes, sizes = tokenise(texts)
    of_token = vectors[buckets(codes)]
    out = np.zeros((len(texts), POOLED), dtype=np.float32)
    at = 0
    for i, n in enumerate(sizes):
        if n:
            number, times = np.unique(flat[at : at + n], return_counts=True)
            share = (times / n).astype(np.float32)
            own = of_token[number]
            mean = share @ own
            spread = np.sqrt(np.maximum(share @ (own * own) - mean * mean, 0))
            out[i] = np.concatenate([mean, spread, [np.linalg.norm(mean), 1 - len(number) / n, np.log1p(n)]])
        at += n
    return out


class Network:
    """Two layers, ``HIDDEN`` tanh units, one probability; trained by Adam on standardised input."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 0.005) -> None:
        draw = np.random.default_rng(1)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.temperature = 1.0
        n = x.shape[1]
        inner, outer = draw.normal(0, n**-0.5, (n, HIDDEN)), draw.normal(0, HIDDEN**-0.5, HIDDEN)
        self.weights = [inner, np.zeros(HIDDEN), outer, np.zeros(())]
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        x, step = (x - self.centre) / self.scale, 0
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for at in range(0, len(x), batch):
                own, step = order[at : at + batch], step + 1
                hidden = np.tanh(x[own] @ self.weights[0] + self.weights[1])
                off = (_sigmoid(hidden @ self.weights[2] + self.weights[3]) - y[own]) / len(own)
                back = np.outer(off, self.weights[2]) * (1 - hidden**2)
                slopes = [x[own].T @ back + 1e-4 * self.weights[0], back.sum(axis=0), hidden.T @ off, off.sum()]
                for k, g in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    gain = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * gain

    def margin(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.weights[0] + self.weights[1])
        return hidden @ self.weights[2] + self.weights[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Set the temperature with the least log loss."""
        margin, tries = self.margin(x), np.exp(np.linspace(-2, 3, 101))
        loss = [np.mean(np.logaddexp(0, margin / t) - y * margin / t) for t in tries]
        self.temperature = float(tries[int(np.argmin(loss))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(labelled: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> Network | float:
    """A calibrated network from ``labelled(key, pooled, label)``; a constant score where the
    labels are of one kind, 0 where there are none. About ``rows`` rows reach the driver at most."""
    labelled = labelled.where(F.col("label").isNotNull())
    n = labelled.count()
    share = min(1.0, rows / max(n, 1))
    drawn = F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1_000_000)) < F.lit(int(1_000_000 * share))
    part = F.pmod(F.xxhash64(F.lit("part"), key), F.lit(CALIBRATION))
    label = F.col("label").cast("double")
    taken = labelled.where(drawn).select(F.col(key).alias("key"), "pooled", label, part.alias("part")).toPandas()
    taken = taken.sort_values("key", kind="stable")  # a rerun learns the same
    y = taken["label"].to_numpy(dtype=float)
    if not 0 < y.sum() < len(y):
        return float(bool(y.sum()))
    x = np.array(taken["pooled"].tolist(), dtype=float)
    hold = (taken["part"] == 0).to_numpy()
    if not 0 < y[~hold].sum() < (~hold).sum() or not hold.any():
        hold = np.zeros(len(y), dtype=bool)
    network = Network(x[~hold], y[~hold])
    if hold.any():
        network.calibrate(x[hold], y[hold])
    return network


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """``(key, score)`` of every row of ``docs``; the word vectors come from all texts, the network
    from ``labels(key, label)``, matched by key.

    Null and empty texts are scored by zero vectors; repeated rows and null keys each get their own
    row, and null keys teach nothing. Without labels all scores are 0; with labels of one kind, that kind.
    The texts are read twice and never shuffled; the pooled rows are stored in the shared folder.
    """
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text))
    schema = StructType().add("pooled", ArrayType(FloatType()))
    pooled = per_slice(docs, text, schema, lambda texts: {"pooled": list(pool(texts, vectors.value))}, [key])
    pooled = materialize(pooled, "quality-pooled")
    model = fit(pooled.join(labels.select(F.col(key), F.col(label).alias("label")), key), key)
    if isinstance(model, float):
        return pooled.select(key, F.lit(model).alias("score"))

    @F.pandas_udf("double")
    def scored(rows):
        import pandas as pd

        return pd.Series(model.score(np.array(rows.tolist(), dtype=float)) if len(rows) else [], dtype=float)

    return pooled.select(key, scored("pooled").alias("score"))
