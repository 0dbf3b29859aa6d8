"""Hard negatives from a multiway hyperplane tree over vectors.

The tree is fitted on a bounded sample: each node has some split points, and a row goes to the
nearest of them. All rows are indexed: every row walks to its leaf, and each leaf's least and greatest distance to every
split point on its way are measured over its rows, and combined upwards. A query that wants scores in a window
wants distances in a window, an annulus around it; a subtree goes when its range of distances to a sibling's
split point cannot meet it (triangle inequality). Leaves that are left are scored in full, as integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import partitions
from clickloom.operators.skew import top_per_group
from clickloom.shared import materialize

# Rows the tree is fitted on (on average), split points of a node, and sampled rows that are split no further.
SAMPLE_ROWS = 8192
WAYS = 8
LEAF_ROWS = 128
# Rows of a leaf that are scored together: a quarter of an average shuffle partition within these bounds.
BLOCK_ROWS = (512, 32_768)
# Scores held at once in a task.
SCORES = 4_000_000
# Part of the vectors' lengths by which windows of distances are widened: the error of a square root of a rounded difference.
SLACK = 1e-6

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # per cent of the positive's score
LOWEST, HIGHEST = -(2**63), 2**63 - 1


# --- the tree ------------------------------------------------------------------------


@dataclass
class Node:
    """A leaf, or split points with a child for each; ``near`` and ``far`` give the distances from each split point
    (row) to the rows below each child (column)."""

    leaf: int = -1
    points: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    least_norm: float = np.inf
    most_norm: float = -np.inf


class Tree:
    """Split points fitted on ``sample`` (a row per vector); ``leaves`` of them, ``width`` distances for a leaf."""

    def __init__(self, sample: np.ndarray, ways: int = WAYS, leaf_rows: int = LEAF_ROWS) -> None:
        self.leaves = self.width = 0
        self.root = self._fit(np.unique(sample, axis=0), ways, leaf_rows, 0)

    def _fit(self, rows: np.ndarray, ways: int, leaf_rows: int, above: int) -> Node:
        if len(rows) <= max(leaf_rows, ways):
            self.leaves += 1
            self.width = max(self.width, above)
            return Node(leaf=self.leaves - 1)
        points = rows[spread_out(rows, ways)]
        nearest = distances(rows, points).argmin(axis=1)
        node = Node(points=points, near=np.full((ways, ways), np.inf), far=np.full((ways, ways), -np.inf))
        node.children = [self._fit(rows[nearest == i], ways, leaf_rows, above + ways) for i in range(ways)]
        return node

    def walk(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each row, and its distances to the split points on the way, padded with NaN."""
        leaf = np.zeros(len(rows), dtype=np.int64)
        passed = np.full((len(rows), self.width), np.nan)

        def down(node: Node, at: np.ndarray, depth: int) -> None:
            if node.points is None:
                leaf[at] = node.leaf
                return
            found = distances(rows[at], node.points)
            passed[at, depth : depth + found.shape[1]] = found
            nearest = found.argmin(axis=1)
            for i, child in enumerate(node.children):
                if (own := at[nearest == i]).size:
                    down(child, own, depth + found.shape[1])

        down(self.root, np.arange(len(rows)), 0)
        return leaf, passed

    def measure(self, of_leaf: dict[int, tuple[np.ndarray, np.ndarray, float, float]]) -> None:
        """Take ``leaf: (least, greatest distances on the way, least, greatest norm)`` of all rows."""

        def up(node: Node, depth: int) -> tuple[np.ndarray, np.ndarray]:
            if node.points is None:
                near, far, *norms = of_leaf.get(node.leaf, (np.full(self.width, np.inf), np.full(self.width, -np.inf), np.inf, -np.inf))
                node.least_norm, node.most_norm = norms
                return near, far
            ways = len(node.points)
            both = [up(child, depth + ways) for child in node.children]
            node.near = np.stack([near[depth : depth + ways] for near, _ in both], axis=1)
            node.far = np.stack([far[depth : depth + ways] for _, far in both], axis=1)
            node.least_norm = min(child.least_norm for child in node.children)
            node.most_norm = max(child.most_norm for child in node.children)
            # A child's row may pass no point below it, so those entries are NaN: never needed above.
            return np.fmin.reduce([near for near, _ in both]), np.fmax.reduce([far for _, far in both])

        up(self.root, 0)

    def search(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves that may hold rows with scores from ``least`` to ``most``, each with the queries that want it."""
        norms = np.einsum("ij,ij->i", queries, queries)

        def down(node: Node, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            if node.least_norm > node.most_norm:
                return  # no rows
            room = SLACK * (1 + np.sqrt(norms[at]) + np.sqrt(node.most_norm))
            # Squared distances to rows of these norms with scores in the window.
            inner = np.sqrt(np.maximum(norms[at] + node.least_norm - 2 * most[at], 0))
            outer = norms[at] + node.most_norm - 2 * least[at]
            some = outer >= -(room**2)
            at, inner, outer, room = at[some], inner[some, None], np.sqrt(np.maximum(outer[some, None], 0)), room[some, None]
            if not at.size:
                return
            if node.points is None:
                yield node.leaf, at
                return
            own = distances(queries[at], node.points)
            low, high = np.maximum(own - outer, inner - own) - room, own + outer + room
            meets = (node.near[None] <= high[:, :, None]) & (node.far[None] >= low[:, :, None])
            wanted = meets.all(axis=1)
            for i, child in enumerate(node.children):
                if (some := at[wanted[:, i]]).size:
                    yield from down(child, some)

        yield from down(self.root, np.arange(len(queries)))


def spread_out(rows: np.ndarray, n: int) -> list[int]:
    """``n`` rows, each as far as can be from those before it; the first is the farthest from the mean."""
    chosen = [int(distances(rows, rows.mean(axis=0, keepdims=True))[:, 0].argmax())]
    gap = distances(rows, rows[chosen])[:, 0]
    while len(chosen) < n:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(rows, rows[chosen[-1:]])[:, 0])
    return chosen


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None] - 2 * (rows @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; beyond a long they are its bounds."""
    width = max(queries.shape[1], 1)
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * width < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object)
    return np.clip(whole(queries) @ whole(rows).T, LOWEST, HIGHEST).astype(np.int64)


def best(found: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, of equal ones those of the smallest ids, then rows."""
    at = np.arange(len(found))
    if len(found) > n:
        at = np.flatnonzero(found >= np.partition(found, -n)[-n])
    return at[np.lexsort((rows[at], ids[at], ~found[at]))][:n]


# --- vectors in Arrow ----------------------------------------------------------------


def packed(matrix: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(matrix, dtype=np.float64)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    return np.frombuffer(data.tobytes(), dtype=np.float64).reshape(-1, width)


def whole_numbers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component; vectors shorter than ``width`` go on with zeros."""
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None] < sizes[:, None]] = np.floor(scale * flat)
    return out


# --- the index -----------------------------------------------------------------------

ROW = "row long, id long, label int, vector binary"
ROW_COLUMNS = ["row", "id", "label", "vector"]


@dataclass
class Index:
    """``rows(leaf, block, row, id, label, vector)`` of all rows; ``blocks(leaf, block)``, whole vectors of a common
    ``width`` and, for the tasks, the measured tree and the sample it was fitted on: rows, labels, vectors."""

    rows: DataFrame
    blocks: DataFrame
    tree: Broadcast
    width: int


def build_index(
    vectors: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE, sample_rows: int = SAMPLE_ROWS,
    leaf_rows: int = LEAF_ROWS, block_rows: int | None = None,
) -> Index | None:
    """An index of all rows of ``vectors``; None if none takes part.

    Rows without a key, ``label`` or vector, or with a component that is null or not finite, take no part. Every other
    one does, repeated rows each as a row of its own; components become ``floor(scale * x)``, and vectors shorter than the
    longest go on with zeros. The driver gets the sample (``sample_rows`` rows on average) and, for each leaf, its
    size, norms and distances; there are fewer leaves than sampled rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"),
        label.cast("int").alias("label"), F.col(f"`{vector}`").alias("vector"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    rows = materialize(rows, "tree-vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return None
    width = max(width, 1)
    unit = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / (1 << 30)
    drawn = rows.where(unit < sample_rows / n).select("row", "label", "vector").toArrow()
    sample = (drawn["row"].to_numpy(), drawn["label"].to_numpy(), whole_numbers(drawn["vector"].combine_chunks(), width, scale))
    tree = Tree(sample[2], leaf_rows=leaf_rows)
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = whole_numbers(batch["vector"], width, scale)
            leaf = pa.array(shared.value.walk(numbers)[0])
            yield pa.RecordBatch.from_arrays([leaf, *batch.columns[:3], packed(numbers)], names=["leaf", *ROW_COLUMNS])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            numbers = unpacked(batch["vector"], width)
            norms = np.einsum("ij,ij->i", numbers, numbers)
            leaf, passed = shared.value.walk(numbers)
            seen = np.column_stack([passed, norms])
            for i in np.unique(leaf).tolist():
                own = seen[leaf == i]
                least, most = found.get(i, (own[0], own[0]))
                found[i] = [np.fmin(least, own.min(axis=0)), np.fmax(most, own.max(axis=0))]
        if found:
            ends = [pa.array([list(x[i]) for x in found.values()], pa.list_(pa.float64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), *ends], names=["leaf", "least", "most"])

    stored = materialize(rows.mapInArrow(assign, f"leaf long, {ROW}"), "tree-rows")
    spans = stored.mapInArrow(measure, "leaf long, least array<double>, most array<double>")
    spans = spans.select("leaf", F.posexplode(F.arrays_zip("least", "most")).alias("at", "span"))
    spans = spans.groupBy("leaf", "at").agg(F.min("span.least").alias("least"), F.max("span.most").alias("most"))
    spans = spans.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("at", "least", "most"))).alias("spans"))
    measured = {}
    for leaf, found in spans.collect():
        least, most = (np.array([x[c] for x in found], dtype=np.float64) for c in ("least", "most"))
        measured[leaf] = (least[:-1], most[:-1], least[-1], most[-1])
    tree.measure(measured)
    block_rows = block_rows or min(max(n // (4 * partitions(spark)), BLOCK_ROWS[0]), BLOCK_ROWS[1])
    sizes = stored.groupBy("leaf").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    sizes = materialize(sizes, "tree-leaves")
    # As many rows as leaves, so fewer than the sample has.
    blocks = sizes.select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rows = stored.join(F.broadcast(sizes), "leaf").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    return Index(rows.select("leaf", "block", *ROW_COLUMNS), blocks, spark.sparkContext.broadcast((tree, *sample)), width)


def search(index: Index, asked: DataFrame, same: bool, n: int) -> DataFrame:
    """``(query, window, row, id, score)``: for each window of scores of each row of ``asked(row, label, vector, low, high)``
    the first ``n`` rows of the same label (the row itself left out), or of other labels; ``low`` and ``high``
    are lists of as many bounds as there are windows.

    The sample gives ``n`` scores that a window has for certain, so the search begins with a narrower one. A query goes to every block of each leaf
    that the tree cannot rule out; a block and its queries meet in one task, block first, and queries
    pass by in batches.
    """
    width, shared = index.width, index.tree

    def wanted(found: np.ndarray, labels: np.ndarray, rows: np.ndarray, label: np.ndarray, row: np.ndarray) -> np.ndarray:
        fits = (labels[None] == label[:, None]) == same
        return fits & (rows[None] != row[:, None]) if same else fits

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rows, labels, sample = shared.value
        for batch in batches:
            size = max(1, SCORES // max(len(rows), 1))
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                numbers = unpacked(part["vector"], width)
                row, label = part["row"].to_numpy(), part["label"].to_numpy()
                low, high = (np.array(part[c].to_pylist(), dtype=np.int64) for c in ("low", "high"))
                found = scores(numbers, sample)
                fits = wanted(found, labels, rows, label, row)
                for i in range(len(row)):
                    for w in range(low.shape[1]):
                        own = found[i][fits[i] & (found[i] >= low[i, w]) & (found[i] <= high[i, w])]
                        if len(own) >= n:
                            low[i, w] = np.partition(own, -n)[-n]
                open_ = low <= high
                least = np.where(open_, low, HIGHEST).min(axis=1).astype(np.float64)
                most = np.where(open_, high, LOWEST).max(axis=1).astype(np.float64)
                some = np.flatnonzero(open_.any(axis=1))
                for leaf, at in tree.search(numbers[some], least[some], most[some]):
                    at = some[at]
                    bounds = [pa.array(list(x[at]), pa.list_(pa.int64())) for x in (low, high)]
                    own = [pa.array(row[at]), pa.array(label[at], pa.int32()), packed(numbers[at])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), leaf)), *own, *bounds], names=["leaf", "row", "label", "vector", "low", "high"])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in batches:
            places = np.stack([batch[c].to_numpy() for c in ("leaf", "block", "asks")], axis=1)
            cuts = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(places)]):
                part = batch.slice(start, stop - start)
                *place, asks = places[start].tolist()
                if place != at:
                    at, held, block = place, [], None
                numbers = unpacked(part["vector"], width)
                row, label = part["row"].to_numpy(), part["label"].to_numpy()
                if not asks:
                    held.append((row, part["id"].to_numpy(), label, numbers))
                    continue
                if not held:
                    continue
                block = block or tuple(np.concatenate(x) for x in zip(*held))
                size = max(1, SCORES // len(block[0]))
                for i in range(0, len(row), size):
                    some = slice(i, i + size)
                    if out := answers(block, row[some], label[some], numbers[some], part.slice(i, size)):
                        columns = zip(*out)
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["query", "window", "row", "id", "score"])

    def answers(block: tuple, row: np.ndarray, label: np.ndarray, numbers: np.ndarray, part: pa.RecordBatch) -> list[tuple]:
        rows, ids, labels, stored = block
        low, high = (np.array(part[c].to_pylist(), dtype=np.int64) for c in ("low", "high"))
        found = scores(numbers, stored)
        fits = wanted(found, labels, rows, label, row)
        out = []
        for i in range(len(row)):
            for w in range(low.shape[1]):
                at = np.flatnonzero(fits[i] & (found[i] >= low[i, w]) & (found[i] <= high[i, w]))
                at = at[best(found[i][at], ids[at], rows[at], n)]
                if at.size:
                    out.append((np.full(len(at), row[i]), np.full(len(at), w, dtype=np.int32), rows[at], ids[at], found[i][at]))
        return out

    bounds = "low array<long>, high array<long>"
    routed = asked.select("row", "label", "vector", "low", "high").mapInArrow(route, f"leaf long, row long, label int, vector binary, {bounds}")
    routed = routed.join(index.blocks, "leaf")
    none = F.array().cast("array<long>")
    stored = index.rows.select("leaf", "block", F.lit(0).alias("asks"), *ROW_COLUMNS, none.alias("low"), none.alias("high"))
    asking = routed.select("leaf", "block", F.lit(1).alias("asks"), "row", F.lit(0).cast("long").alias("id"), "label", "vector", "low", "high")
    both = stored.unionByName(asking).repartition(partitions(asked.sparkSession), "leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    found = both.mapInArrow(meet, "query long, window int, row long, id long, score long")
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    return top_per_group(found, ["query", "window"], order, n)


def hard_negatives(
    index: Index | None, spark: SparkSession, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows for whose ``id`` the condition ``anchors`` holds. A row's score is its inner product with the anchor;
    higher scores come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of the same
    label; a positive's negatives are the first ``negatives`` rows of other labels whose score is from ``least`` to ``most`` per
    cent of the positive's. An anchor without positives, and a positive without negatives, have no row; repeated rows are
    other rows. The result is exact, whatever the tree rules out. Without an index (no rows) it is empty.
    """
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index is None:
        return spark.createDataFrame([], names)
    asking = index.rows.where(anchors).select("row", "id", "label", "vector")
    whole = [F.array(F.lit(x)).alias(c) for c, x in (("low", LOWEST), ("high", HIGHEST))]
    near = search(index, asking.select("*", *whole), True, positives)
    near = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    near = materialize(near, "tree-positives")
    part = lambda score, c: score.cast("decimal(20,0)") * c / 100
    low = F.transform("near", lambda p: F.ceil(part(p["score"], least)).cast("long")).alias("low")
    high = F.transform("near", lambda p: F.floor(part(p["score"], most)).cast("long")).alias("high")
    found = search(index, asking.join(near, F.col("row") == F.col("query")).select("row", "label", "vector", low, high), False, negatives)
    whose = asking.select(F.col("row").alias("query"), F.col("id").alias("anchor_id")).join(near, "query")
    positive = F.col("near")[F.col("window")]
    return found.join(whose, "query").select(
        "anchor_id", positive["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
