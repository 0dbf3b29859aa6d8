"""Byte-level BPE by a rank queue on a bitmap of two levels.

A text is split by a pattern, and each match is merged by itself. The matches that a task has not met yet are laid one
after the other, as one linked list of pieces. Each pair of neighbours that the vocabulary can merge waits in the
bucket of its rank, by the place of its first byte; a bitmap tells which buckets have entries, and another
one which words of the first have bits. The lowest rank is then found by two find-first-sets, however many pairs
wait. Entries whose pair has changed meanwhile are skipped when they come up.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from clickloom.llm.common import fresh, slices, text_slices

# Bits of a bitmap's word, as a power of two.
WORD_BITS = 8
BITS = [1 << i for i in range(1 << WORD_BITS)]
# Matches remembered by a task between slices of its texts, and the longest that are, in characters.
MEMORY, REMEMBERED = 500_000, 64
# Characters encoded and ids decoded at once in a task (a longer text or list is handled alone).
GROUP_CHARS, GROUP_IDS = 2_000_000, 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a ``tiktoken`` file with their ranks, which are their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Vocabulary:
    """Pieces and ranks, the rank of each pair of pieces that is one, and that of two bytes by their values."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)])
        nothing: dict[int, int] = {}
        self.follow = [nothing] * self.size  # for each piece, those that make a piece with it, with its rank
        self.two = np.full(1 << 16, -1)
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    if self.follow[left] is nothing:
                        self.follow[left] = {}
                    self.follow[left][right] = rank
            if len(piece) == 2:
                self.two[int.from_bytes(piece, "big")] = rank


def merge(vocabulary: Vocabulary, matches: Sequence[bytes]) -> list[tuple[int, ...]]:
    """The ids of each match, which has a byte at least: of all its pairs the one of lowest rank is merged first, of equal ones
    the leftmost. Matches do not touch each other, so it is no matter which of two goes first."""
    if not matches:
        return []
    data = np.frombuffer(b"".join(matches), dtype=np.uint8).astype(np.int64)
    size = len(data)
    begins = np.cumsum([0, *map(len, matches)])
    ids = vocabulary.single[data]
    if (ids < 0).any():
        raise ValueError(f"the vocabulary has no piece for the byte {data[ids.argmin()]}")
    ranks = np.full(size, -1)
    ranks[:-1] = vocabulary.two[data[:-1] << 8 | data[1:]]
    ranks[begins[1:] - 1] = -1
    first = bytearray(size + 1)  # 1 where a match begins, and behind the last
    np.frombuffer(first, dtype=np.uint8)[begins] = 1
    alive = bytearray(b"\1") * size  # 1 where a piece begins
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    buckets: list[list[int]] = [[] for _ in range(vocabulary.size)]
    words, top = [0] * ((vocabulary.size >> WORD_BITS) + 1), 0
    places = np.flatnonzero(ranks >= 0)
    places = places[np.argsort(ranks[places], kind="stable")]
    for some in np.split(places, np.flatnonzero(np.diff(ranks[places])) + 1) if len(places) else ():
        rank = int(ranks[some[0]])
        buckets[rank] = some.tolist()
        words[rank >> WORD_BITS] |= BITS[rank & (len(BITS) - 1)]
        top |= 1 << (rank >> WORD_BITS)
    ids, waiting, follow = ids.tolist(), ranks.tolist(), vocabulary.follow  # waiting: the rank of the pair that begins there
    sorted_: dict[int, int] = {}  # entries left in a bucket that was in order when a lower rank came between
    while top:
        word = (top & -top).bit_length() - 1
        row = words[word]
        rank = (word << WORD_BITS) + (row & -row).bit_length() - 1
        bucket = buckets[rank]
        if sorted_.pop(rank, None) != len(bucket):
            bucket.sort(reverse=True)
        lower = False
        while bucket and not lower:
            i = bucket.pop()
            if waiting[i] != rank:
                continue  # the pair has changed, or its place is inside another piece
            gone = after[i]
            end = after[gone]
            after[i], ids[i], waiting[gone], alive[gone] = end, rank, -1, 0
            if first[end]:
                waiting[i] = -1
            else:
                before[end] = i
                waiting[i] = found = follow[rank].get(ids[end], -1)
                if found >= 0:
                    if not (other := buckets[found]):
                        words[found >> WORD_BITS] |= BITS[found & (len(BITS) - 1)]
                        top |= 1 << (found >> WORD_BITS)
                    other.append(i)
                    lower = found < rank
            if not first[i]:
                left = before[i]
                waiting[left] = found = follow[ids[left]].get(rank, -1)
                if found >= 0:
                    if not (other := buckets[found]):
                        words[found >> WORD_BITS] |= BITS[found & (len(BITS) - 1)]
                        top |= 1 << (found >> WORD_BITS)
                    other.append(left)
                    lower |= found < rank
        if bucket:
            sorted_[rank] = len(bucket)
            continue
        words[word] ^= BITS[rank & (len(BITS) - 1)]
        if not words[word]:
            top ^= 1 << word
    kept = np.frombuffer(alive, dtype=np.uint8)
    ends = np.cumsum(np.add.reduceat(kept, begins[:-1], dtype=np.int64)).tolist()
    left = np.array(ids)[kept > 0].tolist()
    return [tuple(left[a:b]) for a, b in zip([0, *ends], ends)]


class Memory(dict):
    """The ids of the matches met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.long: list[str] = []

    def learn(self, matches: Iterable[Sequence[str]]) -> None:
        """Merge those that are new."""
        new = set().union(*matches).difference(self)
        self.long = [match for match in new if len(match) > REMEMBERED]
        spelled = {match: match.encode() for match in new}
        whole = {match: rank for match, data in spelled.items() if (rank := self.vocabulary.ranks.get(data)) is not None}
        parted = [match for match in new if match not in whole]
        self.update((match, (rank,)) for match, rank in whole.items())
        self.update(zip(parted, merge(self.vocabulary, [spelled[match] for match in parted])))

    def trim(self) -> None:
        """Forget the long matches that were learned last, and all when there are too many."""
        for match in self.long:
            del self[match]
        if len(self) > MEMORY:
            self.clear()


@contextmanager
def uncollected() -> Iterator[None]:
    """Without Python's search for cycles, of which many lists and tuples make much work: there are none in them."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids"
) -> DataFrame:
    """``keep`` (default: ``doc_id``) with the token ids of each whole text, ``ids array<int>``.

    Each match of ``pattern`` is encoded by itself, a match that is a piece as that piece; texts of special
    tokens are ordinary text. A null or empty text has no ids; repeated rows are encoded each on their own; a text of
    any length is encoded whole, in memory in proportion to it, and the time for a match of n bytes grows with n.
    ``ids`` gets underscores before it where ``keep`` has a column of that name. A byte that is no piece
    ends the job. No row moves: it is one pass over the texts.
    """
    keep = keep or ["doc_id"]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    ids = fresh(kept, ids)
    inner = [f"c{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, inner)], F.col(f"`{text}`").cast("string").alias("text"))
    result = StructType(source.schema.fields[:-1]).add("ids", ArrayType(IntegerType()))
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, matcher = Memory(vocabulary.value), regex.compile(pattern)
        for batch in batches:
            for start, stop, texts in text_slices(batch.column(len(inner)), GROUP_CHARS):
                with uncollected():
                    matches = list(map(matcher.findall, texts))
                    memory.learn(matches)
                    found = [list(chain.from_iterable(map(memory.__getitem__, own))) for own in matches]
                    memory.trim()
                offsets = np.cumsum([0, *map(len, found)])
                flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=offsets[-1])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(inner))]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=[*inner, "ids"])

    return source.mapInArrow(run, result).toDF(*keep, ids)


def _joined(pieces: pa.Array, lists: pa.Array) -> Sequence[bytes]:
    """The pieces of each list of ids, joined: one look-up for all lists, cut at their bounds."""
    spelled = pieces.take(pc.list_flatten(lists))
    if spelled.null_count:
        raise ValueError("an id that the vocabulary lacks")
    if not len(spelled):
        return [b""] * len(lists)
    ends = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[spelled.offset :]
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    bounds = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    data = spelled.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def decode(coded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", data: str = "data") -> DataFrame:
    """``coded`` with the bytes of each list of ids as ``data binary``, in place of the column ``ids``.

    No ids, or a null list, give no bytes; an id that the vocabulary lacks ends the job. ``data`` gets underscores before
    it where another column has that name. One pass; no row moves.
    """
    others = [c for c in coded.columns if c != ids]
    data = fresh(coded.drop(ids), data)
    inner = [f"c{i}" for i in range(len(others))]
    source = coded.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, inner)], F.col(f"`{ids}`").alias("ids"))
    result = StructType(source.schema.fields[:-1]).add("data", BinaryType())
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    vocabulary = coded.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(vocabulary.value, pa.large_binary())
        for batch in batches:
            lists = batch.column(len(inner))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            for start, stop in slices(sizes, GROUP_IDS):
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(inner))]
                joined = pa.array(_joined(pieces, lists.slice(start, stop - start)), pa.binary())
                yield pa.RecordBatch.from_arrays([*kept, joined], names=[*inner, "data"])

    return source.mapInArrow(run, result).toDF(*others, data)
