"""A hidden Markov language model.

A latent state emits the class of a word, and the class emits the word. Baum-Welch counts of states,
moves and emitted classes are added up over all tasks in each round, so the model learns from all
training texts while only numbers of its own size reach the driver. The scaled forward recursion gives the exact
likelihood of a text. Word counts are exact and never leave the cluster: words are counted by a shuffle,
and each block of texts gets the counts of its own words back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructType,
)

from clickloom.llm.common import WordIds, text_slices
from clickloom.shared import materialize

STATES = 6
CLASSES = 8192
ROUNDS = 5
# Characters of the texts that are stored as one block, and tokens (with padding) worked on at once.
BLOCK_CHARS = 4_000_000
CELLS = 400_000
# Tokens of a long text that are worked on at once; the parts are joined exactly.
SEGMENT = 512
# Tokens between two scalings of the odds: a step leaves 1e-27 of them at least (an unseen move times an unseen class
# in ``Model.from_counts`` over 1e12 tokens), so these many steps stay far above the smallest double.
RESCALE = 8
END = b""  # the token after the last word

BLOCKS = (
    StructType()
    .add("block", LongType())
    .add("doc_ids", ArrayType(LongType()))
    .add("held_out", ArrayType(BooleanType()))
    .add("sizes", ArrayType(IntegerType()))
    .add("tokens", BinaryType())  # compressed 32-bit places in ``words``
    .add("words", ArrayType(BinaryType()))
    .add("classes", ArrayType(IntegerType()))
    .add("counts", ArrayType(LongType()))  # of the words in training texts
)


def word_class(word: bytes) -> int:
    """A short word by itself, a longer one by its last four bytes."""
    return zlib.crc32(word if len(word) <= 4 else b"*" + word[-4:]) % CLASSES


def words_of(text: str) -> list[bytes]:
    """Runs without white space (20, 09-0D), with A-Z in lower case, and the end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def store_blocks(docs: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """The texts as tokens, in blocks that tasks make of what they read. No row moves."""
    names = to_arrow_schema(BLOCKS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop, texts in text_slices(batch.column(1), BLOCK_CHARS):
                ids, held = (batch.column(i).slice(start, stop - start).to_pylist() for i in (0, 2))
                places = WordIds()
                places[END]  # always the first
                words = (words_of(t) for t in texts)
                tokens = [np.fromiter(map(places.__getitem__, w), np.int32, count=len(w)) for w in words]
                learned = [t for t, h in zip(tokens, held) if not h] or [np.zeros(0, np.int32)]
                row = {
                    "block": [block],
                    "doc_ids": [ids],
                    "held_out": [held],
                    "sizes": [[len(t) for t in tokens]],
                    "tokens": [zlib.compress(np.concatenate(tokens).tobytes(), 1)],
                    "words": [places.words],
                    "classes": [list(map(word_class, places.words))],
                    "counts": [np.bincount(np.concatenate(learned), minlength=len(places))],
                }
                yield pa.RecordBatch.from_pydict(row, schema=names)
                block += 1

    source = docs.select(F.col(key).cast("long"), F.col(text).cast("string"), held_out)
    return materialize(source.mapInArrow(run, BLOCKS), "hmm-blocks")


def count_words(blocks: DataFrame) -> DataFrame:
    """``(block, place, class, total, first)``: the training count of every word of every block over all
    blocks; ``first`` marks one row of each word.

    A word has one row per block at most, so a frequent one has no more rows than there are blocks.
    """
    zipped = F.arrays_zip("words", "classes", "counts")
    rows = blocks.select("block", F.posexplode(zipped).alias("place", "w")).select("block", "place", "w.*")
    same = Window.partitionBy("words")
    rows = rows.withColumn("total", F.sum("counts").over(same)).withColumn("first", F.min("block").over(same) == F.col("block"))
    rows = rows.select("block", "place", F.col("classes").alias("class"), "total", "first")
    return materialize(rows, "hmm-counts")


@dataclass
class Model:
    """``start``: of a text; ``move``: state x state; ``emit``: class x state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def initial(cls, class_totals: np.ndarray) -> Model:
        draw = np.random.default_rng(1)
        emit = (class_totals[:, None] + 0.1) * draw.uniform(0.5, 1.5, (CLASSES, STATES))
        move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Model:
        """From added-up Baum-Welch counts, laid out as ``cells`` does, with a little for the unseen."""
        start, move, emit = np.split(counts, [STATES, STATES + STATES * STATES])
        start, move, emit = start + 0.1, move.reshape(STATES, -1) + 0.1, emit.reshape(CLASSES, -1) + 0.01
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


N_CELLS = STATES + STATES * STATES + CLASSES * STATES


def _groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of sequences, longest first, in groups of at most ``CELLS`` cells with padding."""
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, CELLS // max(int(sizes[order[at]]), 1))
        yield order[at : at + n]
        at += n


def _padded(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time by sequence, and the number of sequences that reach each time (longest first)."""
    out = np.zeros((len(sizes), int(sizes[0])), dtype=np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate([flat[s : s + n] for s, n in zip(starts, sizes)])
    return np.ascontiguousarray(out.T), np.searchsorted(-sizes, -np.arange(out.shape[1]), side="left")


def _parts(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of the parts of the sequences, of ``SEGMENT`` tokens but for the last; which part each is (from
    0), and of which sequence."""
    parts = -(-sizes // SEGMENT)
    of = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(of)) - (np.cumsum(parts) - parts)[of]
    return starts[of] + nth * SEGMENT, np.minimum(sizes[of] - nth * SEGMENT, SEGMENT), nth, of


def _ends(
    model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, odds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Natural logarithm of the probability of each sequence of classes, and the odds of the states at its last token,
    by the scaled forward recursion; ``odds`` are those at its first token, before that is seen."""
    logs, last = np.zeros(len(sizes)), np.zeros((len(sizes), STATES))
    emit, move = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    for own in _groups(sizes):
        seen, live = _padded(classes, starts[own], sizes[own])
        total = np.zeros(len(own))
        for t, n in enumerate(live):
            state = emit.take(seen[t, :n], axis=1) * (move @ state[:, :n] if t else odds[own].T)
            done = live[t + 1] if t + 1 < len(live) else 0
            at = done if t % RESCALE else 0
            if at < n:
                scale = state[:, at:].sum(axis=0)
                state[:, at:] /= scale
                total[at:n] += np.log(scale)
            if done < n:
                last[own[done:n]] = state[:, done:].T
        logs[own] = total
    return logs, last


def _transfers(model: Model, classes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sequence, all of one ``size``, the matrix that takes the odds of the states at its first token, before
    that is seen, to those at its last token; scaled by one number a sequence, whose natural logarithm comes second."""
    out, logs = np.zeros((len(starts), STATES, STATES)), np.zeros(len(starts))
    emit, move = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    for own in _groups(np.full(len(starts), size * STATES)):
        # State at the token, state at the first token, sequence.
        state = np.repeat(np.eye(STATES)[:, :, None], len(own), axis=2)
        for t in range(size):
            if t:
                state = (move @ state.reshape(STATES, -1)).reshape(state.shape)
            state *= emit.take(classes[starts[own] + t], axis=1)[:, None, :]
            if t % RESCALE == 0:
                scale = state.sum(axis=(0, 1))
                state /= scale
                logs[own] += np.log(scale)
        out[own] = state.transpose(2, 1, 0)
    return out, logs


def _followed(model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each sequence the odds of all of it, given the state at the token before."""
    out = np.zeros((len(sizes), STATES))
    emit = np.ascontiguousarray(model.emit.T)
    for own in _groups(sizes):
        seen, live = _padded(classes, starts[own], sizes[own])
        state = np.ones((STATES, len(own)))
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            pull = model.move @ (emit.take(seen[t, :n], axis=1) * state[:, :n])
            state[:, :n] = pull if t % RESCALE else pull / pull.sum(axis=0)
        out[own] = state.T
    return out


def _before(
    model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the parts of texts of several, in order: the odds of the states at the last token of the part before (of a
    text's ``first`` part: zero), the natural logarithm of the probability of the part after what is before it (of a
    text's last part: zero), the numbers of the parts that are neither first nor last, and their transfer matrices.

    What a first part leads to is a vector; only the parts between need matrices.
    """
    before, logs, last = np.zeros((len(sizes), STATES)), np.zeros(len(sizes)), np.append(first[1:], True)
    between = np.flatnonzero(~first & ~last)
    steps, scales = _transfers(model, classes, starts[between], SEGMENT)
    start = np.broadcast_to(model.start, (first.sum(), STATES))
    logs[first], before[1:][first[:-1]] = _ends(model, classes, starts[first], sizes[first], start)
    for i, step, scale in zip(between, steps, scales):
        odds = before[i] @ model.move @ step
        logs[i] = np.log(odds.sum()) + scale
        before[i + 1] = odds / odds.sum()
    return before, logs, between, steps


def _later(
    model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray,
    between: np.ndarray, steps: np.ndarray,
) -> np.ndarray:
    """For the same parts the odds of what follows, given the state at the last token (of a text's last part: one)."""
    later, last = np.ones((len(sizes), STATES)), np.append(first[1:], True)
    later[:-1][last[1:]] = _followed(model, classes, starts[last], sizes[last])
    for i, step in zip(between[::-1], steps[::-1]):
        odds = model.move @ (step @ later[i])
        later[i - 1] = odds / odds.sum()
    return later


def log_likelihoods(model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each sequence of classes; long ones are worked on in parts, as in
    ``add_counts``."""
    starts, sizes, nth, of = _parts(starts, sizes)
    last = np.append(nth[1:] == 0, True)[: len(nth)]
    before, logs, long = np.zeros((len(sizes), STATES)), np.zeros(len(sizes)), (nth > 0) | ~last
    if long.any():
        before[long], logs[long], *_ = _before(model, classes, starts[long], sizes[long], nth[long] == 0)
    odds = np.where(nth[last, None] > 0, before[last] @ model.move, model.start)
    logs[last] = _ends(model, classes, starts[last], sizes[last], odds)[0]
    return np.bincount(of, weights=logs)


def add_counts(counts: np.ndarray, model: Model, classes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Add the expected counts of the sequences to ``counts``.

    A sequence of more than ``SEGMENT`` tokens is worked on in parts side by side. ``_before`` and ``_later`` give the exact
    forward and backward odds where parts meet, so the counts are those of the whole sequence and memory is
    bounded by the parts.
    """
    begin, moved, emitted = np.split(counts, [STATES, STATES + STATES * STATES])
    moved = moved.reshape(STATES, -1)  # a view: added in place
    emit, move = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    long = sizes > SEGMENT
    starts, sizes, nth, of = _parts(starts, sizes)
    before, later, long = np.zeros((len(sizes), STATES)), np.ones((len(sizes), STATES)), long[of]
    if long.any():
        part = (model, classes, starts[long], sizes[long], nth[long] == 0)
        before[long], _, between, steps = _before(*part)
        later[long] = _later(*part, between, steps)
    for own in _groups(sizes):
        seen, live = _padded(classes, starts[own], sizes[own])
        goes_on, ends = nth[own] > 0, np.ascontiguousarray(later[own].T)
        odds, forward = [], []  # state by sequence; the odds of the tokens are divided by the scale of the forward odds
        for t, n in enumerate(live):
            own_odds = emit.take(seen[t, :n], axis=1)
            state = move @ forward[-1][:, :n] if t else np.where(goes_on, move @ before[own].T, model.start[:, None])
            state *= own_odds
            if t % RESCALE == 0:
                scale = 1 / state.sum(axis=0)
                state *= scale
                own_odds *= scale
            forward.append(state)
            odds.append(own_odds)
        after, pairs = np.ones((STATES, 0)), np.zeros((STATES, STATES))
        for t in range(len(live) - 1, -1, -1):
            n, more = live[t], after.shape[1]
            state, back = forward[t], np.empty((STATES, n))
            if more:
                pull = after * odds[t + 1]
                pairs += state[:, :more] @ pull.T
                np.matmul(model.move, pull, out=back[:, :more])
            if more < n:
                back[:, more:] = ends[:, more:n] / (state[:, more:] * ends[:, more:n]).sum(axis=0)
            state *= back  # the shares of the states from here on
            after = back
        begin += forward[0][:, ~goes_on].sum(axis=1)
        pairs += before[own][goes_on].T @ (after * odds[0])[:, goes_on].T
        moved += model.move * pairs
        token, weight = np.concatenate([seen[t, :n] for t, n in enumerate(live)]), np.concatenate(forward, axis=1)
        for s in range(STATES):
            emitted[s::STATES] += np.bincount(token, weights=weight[s], minlength=CLASSES)


def _read(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the tokens, starts and sizes of the texts of a block."""
    flat = np.frombuffer(zlib.decompress(batch.column("tokens")[i].as_py()), dtype=np.int32)
    sizes = batch.column("sizes")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
    return flat, np.cumsum(sizes) - sizes, sizes


def train(blocks: DataFrame, class_totals: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts; each round brings ``N_CELLS`` numbers to the driver."""
    model = Model.initial(class_totals)
    schema = StructType().add("cell", IntegerType()).add("value", DoubleType())
    names = to_arrow_schema(schema)
    source = blocks.select("held_out", "sizes", "tokens", "classes")
    for _ in range(rounds):
        shared = blocks.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(N_CELLS)
            for batch in batches:
                for i in range(batch.num_rows):
                    flat, starts, sizes = _read(batch, i)
                    classes = batch.column("classes")[i].values.to_numpy()[flat]
                    learn = ~batch.column("held_out")[i].values.to_numpy(zero_copy_only=False).astype(bool)
                    add_counts(counts, shared.value, classes, starts[learn], sizes[learn])
            cells = np.flatnonzero(counts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], schema=names)

        sums = source.mapInArrow(run, schema).groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        counts = np.zeros(N_CELLS)
        counts[sums.column("cell").to_numpy()] = sums.column("value").to_numpy()
        shared.unpersist()
        model = Model.from_counts(counts)
    return model


SCORES = (
    StructType()
    .add("doc_id", LongType())
    .add("held_out", BooleanType())
    .add("n_tokens", LongType())
    .add("n_known", LongType())
    .add("train_tokens", LongType())
    .add("base_score", DoubleType())
    .add("score", DoubleType())
)


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``SCORES`` of each whole text, learned from the rows that are not ``held_out`` (a boolean column).

    ``base_score`` is that of smoothed word counts; ``score`` is the model's log10 probability: of the
    classes by the forward recursion, and of each word within its class, (count + 1) / (count of the class
    + its distinct words + 1), where an unseen word of a class counts as one more.

    A null or empty text is its end token alone. Repeated rows and null ids count and are scored each on
    their own. Without any training text every class is as likely. An empty table gives no row.
    """
    blocks = store_blocks(docs, key, text, held_out)
    counts = count_words(blocks)
    once = counts.where("first and total > 0").groupBy("class").agg(F.sum("total").alias("total"), F.count("*").alias("words"))
    totals, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in once.collect():  # ``CLASSES`` rows at most
        totals[row["class"]], distinct[row["class"]] = row["total"], row["words"]
    n, v = int(totals.sum()), int(distinct.sum())
    shared = docs.sparkSession.sparkContext.broadcast((train(blocks, totals, rounds), totals + distinct + 1))
    names = to_arrow_schema(SCORES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, room = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                flat, starts, sizes = _read(batch, i)
                classes = batch.column("classes")[i].values.to_numpy()
                found = batch.column("found")[i].values
                c = np.zeros(len(classes))
                c[found.field("place").to_numpy()] = found.field("total").to_numpy()
                own = np.log10(c + 1) - np.log10(room[classes])
                add = lambda per_word: np.add.reduceat(per_word[flat], starts)
                likely = log_likelihoods(model, classes[flat], starts, sizes) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        batch.column("held_out")[i].values,
                        pa.array(sizes),
                        pa.array(add((c > 0).astype(np.int64))),
                        pa.array(np.full(len(sizes), n)),
                        pa.array(add(np.log10((c + 1) / (n + v + 1)))),
                        pa.array(likely + add(own)),
                    ],
                    schema=names,
                )

    found = counts.groupBy("block").agg(F.collect_list(F.struct("place", "total")).alias("found"))
    source = blocks.select("block", "doc_ids", "held_out", "sizes", "tokens", "classes").join(found, "block")
    return source.mapInArrow(run, SCORES)
