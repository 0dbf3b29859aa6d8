"""Conversations as a trie of their first turns, with totals of each subtree.

A node is a sequence of first turns. It is known by its depth and two hashes, each the exclusive or of
a hash of every turn with its position; so a long conversation is hashed in pieces that are put together
afterwards. Its owner is the smallest of the conversations that begin with it; the nodes one
conversation owns are the last ones of its path.

Totals of subtrees are rolled up by bands of ``BAND`` depths: first each node explodes to its ancestors in
its own band only; then the first nodes of the bands, with what they have so far, are a trie of their own,
``BAND`` times lower, for which the same is done; last each finished band root explodes to its ancestors
in the band above. A node explodes to at most ``BAND`` ancestors twice per level, and there are as many levels
as the logarithm of the depth to the base ``BAND``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import partitions
from clickloom.shared import materialize

BAND = 8
# Positions of one conversation hashed in a row, and ids of one node written in a row.
PIECE, WRITTEN = 1024, 1000
KEY = ["depth", "p1", "p2"]

NO_IDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(part, conv, own, t1, t2, bytes)``, turns with two hashes of role and text, numbered from 1 in each
    part of a conversation; and ``(part, conv, before, turns)``, how many turns lie before a part, and in all.

    Turns are ordered by ``turn``, null first; equal ones by their hashes. A null role or text counts as
    empty. Rows without a conversation belong to none and are left out. Parts are ranges of the order, so a
    conversation with any share of the rows is cut where it is too long for one task.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("t1"),
        F.xxhash64(F.lit(2), *said).alias("t2"),
        F.octet_length(said[1]).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),  # tells repeated rows apart, which cannot be cut otherwise
    )
    order = [F.asc_nulls_first("turn"), F.asc("t1"), F.asc("t2"), F.asc("row")]
    ranged = rows.repartitionByRange(partitions(turns.sparkSession), F.asc("conv"), *order)
    stored = materialize(ranged.withColumn("part", F.spark_partition_id()), "trie-turns")
    own = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order))
    parts = stored.groupBy("part", "conv").agg(F.count("*").alias("own"))
    of_conv = Window.partitionBy("conv")
    earlier = of_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before")
    parts = materialize(parts.select("part", "conv", before, F.sum("own").over(of_conv).alias("turns")), "trie-parts")
    return stored.select("part", "conv", own.alias("own"), "t1", "t2", "bytes"), parts


def shared_heads(numbered: DataFrame, parts: DataFrame, group: int, heads: Column) -> tuple[DataFrame, DataFrame]:
    """``(conv, position, t1, t2, bytes, last)`` of rebuilt conversations, and ``(conv, turns)`` of all of them.

    Conversation c gets the first ``heads`` (a column over ``conv``) turns of
    conversation c - c % ``group``, all if there are fewer and none if there is no such one, and then
    its own turns after its first ``heads``.
    """
    sizes = parts.where("before = 0").select("conv", F.col("turns").alias("own"))  # the first part of each
    hosts = sizes.select(F.col("conv").alias("base"), F.col("own").alias("lent"))
    convs = sizes.withColumn("base", F.col("conv") - F.col("conv") % group).withColumn("h", heads.cast("long"))
    convs = convs.join(hosts, "base", "left")
    lent = F.least(F.col("h"), F.coalesce(F.col("lent"), F.lit(0)))
    turns = lent + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = materialize(convs.select("conv", "base", "h", lent.alias("lent"), turns.alias("turns")), "trie-conversations")
    target = F.struct("conv", "h", "lent", "turns")
    guests = convs.groupBy("base").agg(F.collect_list(target).alias("guests"))  # fewer than twice ``group`` each
    # By part as well, so that a conversation of many rows stays cut.
    told = parts.select("part", "conv", "before").join(convs.select("conv", target.alias("self")), "conv")
    told = told.join(guests.withColumnRenamed("base", "conv"), "conv", "left")
    rows = numbered.join(told, ["part", "conv"]).withColumn("n", F.col("before") + F.col("own"))
    at = lambda g, position: F.struct(g["conv"].alias("conv"), position.alias("position"), (position == g["turns"]).alias("last"))
    me = F.col("self")
    own = F.when(F.col("n") > me["h"], F.array(at(me, me["lent"] + F.col("n") - me["h"])))
    begun = F.transform(F.filter("guests", lambda g: F.col("n") <= g["h"]), lambda g: at(g, F.col("n")))
    none = F.array().cast("array<struct<conv:long,position:long,last:boolean>>")
    placed = F.explode(F.concat(F.coalesce(own, none), F.coalesce(begun, none))).alias("at")
    return rows.select("t1", "t2", "bytes", placed).select("at.conv", "at.position", "t1", "t2", "bytes", "at.last"), convs.select("conv", "turns")


def paths(turns: DataFrame, depth: int) -> DataFrame:
    """``(conv, depth, p1, p2, q1, q2, bytes, last)``: the node of each turn (p) and the one before it (q); ``depth`` is the
    greatest."""
    hashed = lambda i: F.xxhash64(F.lit(i), "position", "t1", "t2")
    rows = turns.select(
        "conv", F.col("position").cast("long").alias("depth"), hashed(3).alias("h1"), hashed(4).alias("h2"), "bytes", "last",
        F.floor((F.col("position") - 1) / PIECE).alias("piece"),
    )
    within = Window.partitionBy("conv", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"p{i}": F.bit_xor(f"h{i}").over(within) for i in (1, 2)})
    if depth > PIECE:  # put the pieces together by their last rows
        rows = materialize(rows, "trie-pieces")
        whole = rows.where(F.col("depth") % PIECE == 0)
        earlier = Window.partitionBy("conv").orderBy("piece")
        before = whole.select("conv", (F.col("piece") + 1).alias("piece"), *[F.bit_xor(f"p{i}").over(earlier).alias(f"b{i}") for i in (1, 2)])
        rows = rows.join(before, ["conv", "piece"], "left")
        rows = rows.withColumns({f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)})
    q = [F.col(f"p{i}").bitwiseXOR(F.col(f"h{i}")).alias(f"q{i}") for i in (1, 2)]
    return rows.select("conv", "depth", "p1", "p2", *q, "bytes", "last")


def _band(step: str = "step") -> Column:
    return F.floor((F.col(step) - 1) / BAND).alias("band")


def _totals(path: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """``(key, leaves, saved)``: sums of ``leaves`` and ``saved`` over the subtree of each node.

    ``path(conv, step, key)`` has every conversation's nodes in steps from 1, ``nodes(conv, step, key, leaves, saved)``
    each node once, by its owner; ``steps`` is the highest step.
    """
    lists = path.groupBy("conv", _band()).agg(F.collect_list(F.struct("step", "key")).alias("path"))  # at most BAND
    owned = nodes.groupBy("conv", _band()).agg(F.collect_list(F.struct("step", "leaves", "saved")).alias("owned"))
    sums = ["leaves", "saved"]
    below = lambda p: F.filter("owned", lambda o: o["step"] >= p["step"])
    summed = lambda p, c: F.aggregate(below(p), F.lit(0).cast("long"), lambda s, o: s + o[c]).alias(c)
    upward = F.filter("path", lambda p: F.exists("owned", lambda o: o["step"] >= p["step"]))
    upward = F.explode(F.transform(upward, lambda p: F.struct(p["key"].alias("key"), *[summed(p, c) for c in sums])))
    added = [F.sum(c).alias(c) for c in sums]
    local = owned.join(lists, ["conv", "band"]).select(upward.alias("up")).select("up.*").groupBy("key").agg(*added)
    if steps <= BAND:
        return local
    local = materialize(local, "trie-band-totals")
    first = (F.col("step") - 1) % BAND == 0
    coarse = (_band() + 1).alias("step")
    roots = nodes.where(first).select("conv", coarse, "key").join(local, "key")
    roots = materialize(roots, "trie-band-roots")
    finished = _totals(path.where(first).select("conv", coarse, "key"), roots, -(-steps // BAND))
    # A root of band step - 1 gives its total to its ancestors in the band before.
    given = roots.where("step > 1").select("conv", (F.col("step") - 2).alias("band"), "key").join(finished, "key").drop("key")
    pushed = given.join(lists, ["conv", "band"]).select(F.explode(F.col("path.key")).alias("key"), *sums)
    return local.unionByName(pushed).groupBy("key").agg(*added)


def _hashed_ids(ids: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)`` of ``ids(depth, p1, p2, conv)``: SHA-256 of each node's ids, ascending.

    The ids are sorted by ranges and written in rows of ``WRITTEN``, so a node with any share of them is cut; only
    these texts of a node come together, one after the other, because the hash takes them in order.
    """
    schema = "depth long, p1 long, p2 long"

    def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
        for batch in batches:
            *key, values, texts = (c.to_pylist() for c in batch.columns)
            keys, start = list(zip(*key)), 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start] or i - start == WRITTEN:
                    yield keys[start], values[start], texts[start:i]
                    start = i

    def rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = [[*k] for k in zip(*((*key, *rest) for key, *rest in found))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(key, first, ",".join(texts)) for key, first, texts in grouped([batch])]
            if found:
                yield rows(found, [*KEY, "first", "ids"])

    def hash_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for key, _, texts in grouped([batch]):
                if key != at:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                    state.update(",".join(texts).encode())
                else:
                    state.update(("," + ",".join(texts)).encode())
            if done:
                yield rows(done, [*KEY, "ends_sha256"])
        if at is not None:
            yield rows([(at, state.hexdigest())], [*KEY, "ends_sha256"])

    n = partitions(ids.sparkSession)
    spelled = ids.select(*KEY, "conv", F.col("conv").cast("string").alias("text"))
    ranged = spelled.repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
    written = ranged.mapInArrow(write, f"{schema}, first long, ids string")
    together = written.repartition(n, *KEY).sortWithinPartitions(*KEY, "first")
    return together.mapInArrow(hash_, f"{schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns(conv, position, t1, t2, bytes, last)``, positions from 1; ``convs(conv, turns)`` has
    every conversation once, those without turns too.

    ``conv_id``, the smallest conversation that begins so; ``depth``; ``parent_conv_id``, that of the node above (null
    for the root); ``n_convs``, how many begin so; ``n_children``; ``n_leaves``, the childless nodes in its subtree, itself
    included; ``saved_tokens``, over its subtree, the bytes of a node's last text times its conversations but one;
    ``ends_sha256`` of the ascending ids of those that end there. No conversations give no rows, not even a root.
    """
    depth = convs.agg(F.max("turns")).first()[0] or 0
    path = materialize(paths(turns, depth), "trie-paths")
    nodes = path.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"),
        *[F.max(c).alias(c) for c in ("q1", "q2", "bytes")],
    )
    nodes = materialize(nodes, "trie-nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = nodes.select(*above).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    key = F.struct(*KEY).alias("key")
    weighed = nodes.join(children, KEY, "left").select(
        "conv", F.col("depth").alias("step"), key, "n_convs", F.struct(*above).alias("above"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    weighed = materialize(weighed, "trie-weights")
    totals = _totals(path.select("conv", F.col("depth").alias("step"), key), weighed.drop("above"), depth)
    totals = totals.select("key", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = path.where("last").select(*KEY, "conv")
    zero = F.lit(0).cast("long")
    none = convs.where("turns = 0").select(*[zero.alias(c) for c in KEY], "conv")
    ends = _hashed_ids(ends.unionByName(none)).select(key, "ends_sha256")

    nobody = F.lit(None).cast("long")
    told = convs.select("conv", F.lit(1).alias("n_convs"), *[zero.alias(c) for c in ("n_children", "leaves", "saved")])
    first = (F.col("step") == 1).cast("long").alias("n_children")
    told = told.unionByName(weighed.select(nobody.alias("conv"), F.lit(0).alias("n_convs"), first, "leaves", "saved"))
    root = told.agg(
        F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    root = root.where("n_convs > 0").select(
        "conv", zero.alias("step"), F.struct(*[zero.alias(c) for c in KEY]).alias("key"),
        nobody.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
    )
    parents = weighed.select(F.col("key").alias("above"), F.col("conv").alias("parent_conv_id"))
    parents = parents.unionByName(root.select(F.col("key").alias("above"), F.col("conv").alias("parent_conv_id")))
    # A node with very many children is one join key; adaptive execution cuts its rows, of which the other side has one.
    found = weighed.join(parents, "above").join(totals, "key").select(*root.columns).unionByName(root).join(ends, "key", "left")
    return found.select(
        F.col("conv").alias("conv_id"), F.col("step").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )
