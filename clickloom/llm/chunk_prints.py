"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes of UTF-8 sets the chunk bounds, so they move with the text:
an edit changes the chunks around it and no others. Bounds are normalised: up to the usual size
a rarer pattern ends a chunk, beyond it a more frequent one. A fingerprint is the set of
the chunks' digests, each with its length; containment is the share of a document's length whose
chunks the other document has too.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from clickloom.llm.common import mix, partitions, per_slice

LEAST, USUAL, MOST = 32, 128, 512
STRICT, LOOSE = 9, 5  # leading zero bits that end a chunk before and after the usual size
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

# Characters fingerprinted at once in a task.
GROUP_CHARS = 1_000_000

Fingerprint = dict[str, int]  # digest of a chunk: its length in bytes


def gear_hashes(data: bytes) -> np.ndarray:
    """For each byte, the sum of the gear values of the last 32, each shifted by its distance."""
    h = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def chunks(texts: Sequence[bytes]) -> list[list[bytes]]:
    """The chunks of each text. A chunk has at least ``LEAST`` bytes (the last may have fewer), as
    many as the hash looks back, so what lies before the chunk is never in the hash."""
    data = b"".join(texts)
    h = gear_hashes(data)
    strict = (np.flatnonzero(h < np.uint32(1 << (32 - STRICT))) + 1).tolist()
    loose = (np.flatnonzero(h < np.uint32(1 << (32 - LOOSE))) + 1).tolist()
    found, at = [], 0
    for text in texts:
        end, own = at + len(text), []
        while at < end:
            cut = min(at + MOST, end)
            i = bisect_left(strict, at + LEAST)
            if i < len(strict) and strict[i] < min(at + USUAL, cut):
                cut = strict[i]
            else:
                i = bisect_left(loose, at + USUAL)
                if i < len(loose) and loose[i] < cut:
                    cut = loose[i]
            own.append(data[at:cut])
            at = cut
        found.append(own)
    return found


def fingerprints(texts: Sequence[str]) -> list[Fingerprint]:
    return [
        {hashlib.blake2b(c, digest_size=8).hexdigest(): len(c) for c in own}
        for own in chunks([t.encode("utf-8", "surrogatepass") for t in texts])
    ]


def containment(own: Fingerprint, other: Fingerprint) -> float:
    """Share of ``own`` length in chunks of ``other``; 1 if both are empty, 0 if one is."""
    if not own:
        return float(not other)
    return sum(n for digest, n in own.items() if digest in other) / sum(own.values())


def written(print_: Fingerprint) -> str:
    """Ascending digests, each with its length, joined by commas."""
    return ",".join(f"{digest}:{n}" for digest, n in sorted(print_.items()))


def fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: ``doc_id``) and the ``fingerprint`` of each whole text, as written text.
    Equal texts have equal ones; a null or empty text has the empty one."""
    schema = StructType().add("fingerprint", StringType())
    return per_slice(docs, text, schema, lambda t: {"fingerprint": list(map(written, fingerprints(t)))}, keep or ["doc_id"])


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NEIGHBOURS = (
    StructType()
    .add("doc_id", LongType())
    .add("n_chars", LongType())
    .add("edited_sha256", StringType())
    .add("fingerprint", StringType())
    .add("edited_fingerprint", StringType())
    .add("near_edited", DoubleType())
    .add("near_next", DoubleType())
)


def _run_of(bounds: list[int]) -> Column:
    """How many ``bounds`` (ascending) are at or below ``doc_id``; 0 for a null.

    Looks through every ``step``-th bound first, then through the ``step`` bounds after the last hit.
    """
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    edges, coarse = (F.array(*[F.lit(b).cast("long") for b in x]) for x in (bounds, bounds[::step]))
    below = lambda b: b <= F.col("doc_id")
    hits = F.size(F.filter(coarse, below))
    fine = F.size(F.filter(F.slice(edges, (hits - 1) * step + 1, step), below))
    return F.when(F.col("doc_id").isNull() | (hits == 0), 0).otherwise((hits - 1) * step + fine)


def in_runs(docs: DataFrame, runs: int) -> DataFrame:
    """``docs(doc_id, text)`` dealt over ``runs`` tasks by ranges of ``doc_id`` and sorted, each run
    followed by the first row of the next one (the last by that of the first), marked ``tail``.

    A null id comes first; equal ids go by text. The driver gets the bounds and the first id of each
    run, at most ``runs`` numbers each. The texts are shuffled once.
    """
    points = [i / runs for i in range(1, runs)]
    found = docs.select(F.percentile_approx("doc_id", points, F.lit(100 * runs))).first()[0] if points else []
    run = _run_of(sorted(set(found or []))).cast("int")
    placed = docs.select("doc_id", "text", run.alias("run"))
    # A null is below every number: the first row of its run.
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("first")))
    heads = sorted((r["run"], r["least"]["first"]) for r in placed.groupBy("run").agg(least.alias("least")).collect())
    before = [heads[i - 1][0] for i in range(len(heads))]  # the run that each run's first row ends
    schema = "run int, first long, ends int"
    ends = docs.sparkSession.createDataFrame([(r, f, b) for (r, f), b in zip(heads, before)], schema)
    is_first = F.col("doc_id").eqNullSafe(F.col("first"))
    own = F.struct(F.col("run"), F.lit(False).alias("tail"))
    also = F.struct(F.col("ends").alias("run"), F.lit(True).alias("tail"))
    both = F.when(is_first, F.array(own, also)).otherwise(F.array(own))
    spread = placed.join(F.broadcast(ends), "run").select("doc_id", "text", F.explode(both).alias("at"))
    spread = spread.select("doc_id", "text", "at.run", "at.tail").repartitionById(runs, F.col("run"))
    order = [F.col("tail"), F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return spread.sortWithinPartitions(*order)


def _compare(rows: list[tuple[int | None, str]]) -> dict[str, list]:
    """All but the last of ``rows`` compared with their edited texts and with the row after."""
    texts = [t for _, t in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    prints = fingerprints(texts + changed)
    own, after = prints[: len(texts)], prints[len(texts) :]
    return {
        "doc_id": [d for d, _ in rows[:-1]],
        "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": [written(p) for p in own[:-1]],
        "edited_fingerprint": [written(p) for p in after],
        "near_edited": [containment(a, b) for a, b in zip(own, after)],
        "near_next": [containment(a, b) for a, b in zip(own, own[1:])],
    }


def compare_with_next(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Each document of ``docs(doc_id, text)`` with its fingerprint, that of its edited text, and
    how much of its own length is contained in the edited text and in the next document.

    The next document is the one after in ascending ``doc_id`` (after the last: the first); a null id
    comes first and equal ids go by text, each row on its own. A null text is empty. Two empty texts
    contain each other in full; an empty and another text not at all. An empty table gives no row.
    """
    names = to_arrow_schema(NEIGHBOURS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, done = 0, False
        for batch in batches:
            for doc_id, text, tail in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if done:
                    continue
                held.append((doc_id, text or ""))
                size, done = size + len(text or ""), tail
                if size >= GROUP_CHARS and len(held) > 1:
                    yield pa.RecordBatch.from_pydict(_compare(held), schema=names)
                    held, size = held[-1:], 0
        if len(held) > 1:
            yield pa.RecordBatch.from_pydict(_compare(held), schema=names)

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    laid = in_runs(docs, runs or partitions(docs.sparkSession))
    return laid.select("doc_id", "text", "tail").mapInArrow(run, NEIGHBOURS)
