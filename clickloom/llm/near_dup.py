"""Near-duplicates by ProbMinHash.

A document is the multiset of its five-word shingles. For each shingle a Poisson process, with the
shingle's count as rate and its hash as seed, sends arrivals to random registers; a register keeps
the shingle of its first arrival, and a process ends once it is past the last register's time. Two
documents agree in a register with their probability Jaccard similarity, and with the plain one if
all rates are 1. Bands of registers by counts and by rates of 1 give candidates, and the texts of
candidates are compared in full.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from clickloom.llm.common import WordIds, fresh, hashes64, mix, partitions, per_slice
from clickloom.operators.skew import salted_join
from clickloom.shared import materialize

SHINGLE = 5
SIMILAR = 0.8
# A pair of 0.8 similarity by either measure shares a band of its with 1 - (1 - 0.8^6)^32 = 0.99994.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
# Shingles of a bucket's members that one task compares with as many others.
PIECE = 200_000
# Shingles worked on at once in a task.
GROUP = 400_000

WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``(doc, hash, count)`` of the distinct shingles, by document, and a digest of each
    document's words.

    Words are runs of letters and digits in lower case. A text with fewer than five words has one
    shingle of all of them, one without words has none.
    """
    ids = WordIds()
    numbers, digests = [], []
    for text in texts:
        words = WORD.findall(text.lower())
        digests.append(hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest())
        numbers.append(np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words)))
    codes = hashes64(w.encode("utf-8", "surrogatepass") for w in ids.words)
    sizes = np.array([len(n) for n in numbers], dtype=np.int64)
    words = codes[np.concatenate(numbers)] if sizes.sum() else np.zeros(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    spare = SHINGLE - 1
    rolled = np.zeros(max(len(words) - spare, 0), dtype=np.uint64)
    for j in range(SHINGLE):
        rolled = mix(rolled * _ODD + words[j : len(words) - spare + j] + np.uint64(j)) if len(rolled) else rolled
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(words)) - starts[owner]
    inside = np.flatnonzero(place + spare < sizes[owner])
    docs, hashes = [owner[inside]], [rolled[inside]]
    for d in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
        code = np.zeros(1, np.uint64)
        for w in words[starts[d] : starts[d + 1]]:
            code = mix(code * _ODD + w)
        docs.append(np.array([d]))
        hashes.append(code)
    doc, code = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(first)
    return doc[at], code[at], np.diff(np.append(at, len(doc))), digests


def signatures(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``REGISTERS`` shingle hashes; a document without shingles has zeros."""
    times = np.full(n * REGISTERS, np.inf)
    kept = np.zeros(n * REGISTERS, dtype=np.uint64)
    times_of = times.reshape(n, REGISTERS)
    doc, code = doc.copy(), code.copy()
    rate, clock = 1.0 / weight, np.zeros(len(doc))
    step = 0
    while len(doc):
        step += 1
        draw = mix(code + np.uint64(2 * step * int(_ODD) % 2**64))
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53)
        clock = clock + gap * rate
        cell = doc * REGISTERS + (mix(draw ^ _ODD) % np.uint64(REGISTERS)).astype(np.int64)
        won = np.flatnonzero(clock < times[cell])
        won = won[np.lexsort((code[won], -clock[won]))]  # the earliest is written last
        times[cell[won]] = clock[won]
        kept[cell[won]] = code[won]
        live = clock < times_of.max(axis=1)[doc]
        doc, code, rate, clock = doc[live], code[live], rate[live], clock[live]
    return kept.reshape(n, REGISTERS)


def bands(signature: np.ndarray) -> np.ndarray:
    """One key per band of each signature, as signed 64-bit numbers."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * _ODD + parts[:, :, r])
    return key.view(np.int64)


def both_bands(doc: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> list[np.ndarray]:
    """The distinct keys of ``n`` documents' bands by counts and by rates of 1: ``BANDS`` of each, and for a
    document that repeats no shingle only the one set, for both are the same."""
    found = list(bands(signatures(doc, code, weight, n)))
    repeats = np.bincount(doc, weights=weight > 1, minlength=n) > 0
    own = repeats[doc]
    place = np.cumsum(repeats) - 1
    plain = bands(signatures(place[doc[own]], code[own], np.ones(own.sum()), int(repeats.sum())))
    for d, keys in zip(np.flatnonzero(repeats), plain):
        found[d] = np.concatenate([found[d], keys[keys != found[d]]])
    return found


PRINTS = (
    StructType().add("digest", StringType()).add("n_shingles", LongType()).add("bands", ArrayType(LongType()))
)


def prints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, digest, n_shingles, bands)`` of each text: one pass, no row moves."""

    def work(texts: list[str]) -> dict:
        doc, code, weight, digests = shingles(texts)
        counts = np.bincount(doc, minlength=len(texts))
        ends, found, start = np.cumsum(counts), [], 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + GROUP, side="right")))
            own = slice(base, ends[stop - 1])
            found += both_bands(doc[own] - start, code[own], weight[own], stop - start)
            start = stop
        return {"digest": digests, "n_shingles": counts, "bands": found}

    return per_slice(docs, text, PRINTS, work, [key]).withColumnRenamed(key, "id")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Jaccard and probability Jaccard similarity of two (hashes ascending, counts)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(a[0]) + len(b[0]) - len(common))
    both = np.union1d(a[0], b[0])
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])], y[np.searchsorted(both, b[0])] = a[1], b[1]
    # Sum over k of max(x_k / x_i, y_k / y_i): by ascending y/x, y counts where its ratio is larger.
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    below, above = np.concatenate([[0], np.cumsum(x)]), np.concatenate([np.cumsum(y[::-1])[::-1], [0]])
    own_x, own_y = a[1][i].astype(float), b[1][j].astype(float)
    cut = np.searchsorted(ratio, own_y / own_x, side="right")
    return plain, float(np.sum(1.0 / (below[cut] / own_x + above[cut] / own_y)))


def _compared(pairs: DataFrame, similar: float) -> DataFrame:
    """The ``(a, b)`` of ``pairs(a, b, text_a, text_b)`` that are similar by either measure."""
    schema = StructType().add("a", LongType()).add("b", LongType())
    names = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
            step = 64  # pairs compared at once
            for at in range(0, len(a), step):
                own = slice(at, at + step)
                texts = list(dict.fromkeys(left[own] + right[own]))
                doc, code, weight, _ = shingles(texts)
                ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                sets = {t: (code[s:e], weight[s:e]) for t, s, e in zip(texts, ends, ends[1:])}
                good = [
                    (x, y) for x, y, p, q in zip(a[own], b[own], left[own], right[own])
                    if max(similarity(sets[p], sets[q])) >= similar
                ]
                yield pa.RecordBatch.from_pydict({"a": [g[0] for g in good], "b": [g[1] for g in good]}, schema=names)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def _smallest_linked(ids: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``(id, comp)``: the smallest id that each of ``ids`` is linked with, over any number of links.

    Labels go to the neighbours' smallest and then to their labels' labels until none changes; every
    round is written to the shared folder, and the driver sees one number of it.
    """
    ways = links.select(F.col("a").alias("id"), F.col("b").alias("to"))
    ways = materialize(ways.unionAll(ways.select(F.col("to"), F.col("id"))).distinct(), f"{label}-ways")
    labels = materialize(ids.select("id", F.col("id").alias("comp")), f"{label}-labels")
    while True:
        near = ways.join(labels.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("comp").alias("near"))
        best = labels.join(near, "id", "left").select("id", "comp", F.least("comp", F.coalesce("near", "comp")).alias("new"))
        hop = labels.select(F.col("id").alias("new"), F.col("comp").alias("hop"))
        moved = best.join(hop, "new", "left").select("id", "comp", F.least("new", F.coalesce("hop", "new")).alias("new"))
        moved = materialize(moved, f"{label}-labels")
        labels = moved.select("id", F.col("new").alias("comp"))
        if moved.where(F.col("new") != F.col("comp")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``(id, rep, class_id)`` of each row: ``rep`` is the smallest id with the same words, and
    ``class_id`` the smallest id that is linked with it.

    Two texts are linked if the probability Jaccard similarity of their five-word shingles, or the plain one, is
    at least ``similar``; bands of either give the candidates, and a class is what links join. Texts without words (null, empty) are copies of each other.
    Repeated rows are copies. An id names one text: of rows that share an id but not the text, one text
    is compared for both. Rows of null id are not compared: their ``rep`` and ``class_id`` are null.

    Copies are set aside first, so of a group of equal texts one goes on. In a bucket every member is
    compared with the member that shares most buckets, which joins most of a group at once. Where a bucket
    still has members of several classes, those outside its largest are compared with all of the
    other classes, in pieces of bounded size that give out only links that join classes. So no candidate
    of a different class is left uncompared, and the rows grow with the members of buckets, not with their pairs.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    made = prints(docs, "id", "text").withColumn("row", F.monotonically_increasing_id())
    made = materialize(made, "near-prints")  # which fixes the row numbers
    known = made.where(F.col("id").isNotNull())
    parts = 16 * partitions(spark)

    first = F.min(F.struct("id", "row"))
    groups = known.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
    groups = materialize(groups.select("digest", F.col("first.id").alias("rep"), "first.row", "n"), "near-groups")
    total = known.count()
    hot = _hot(groups, "digest", total, parts)
    members = salted_join(known.select("id", "digest"), groups.select("digest", "rep"), "digest", "left", hot, ["id"])
    members = materialize(members.select("id", "rep"), "near-members")

    one = known.where(F.col("n_shingles") > 0).join(groups.select("row"), "row", "left_semi")
    rows = one.select("id", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sizes = materialize(sizes, "near-sizes")
    hits = salted_join(rows, sizes, "bucket", "inner", _hot(sizes, "bucket", max(total, 1) * BANDS, parts), ["id"])
    hits = materialize(hits, "near-hits")
    labels = _labels(hits, docs, total, parts, similar)

    named = labels.select(F.col("id").alias("rep"), "comp")
    classes = groups.groupBy("rep").agg(F.sum("n").alias("n")).join(named, "rep", "left")
    classes = materialize(classes.select("rep", F.coalesce("comp", "rep").alias("class_id"), "n"), "near-classes")
    found = salted_join(members, classes.drop("n"), "rep", "left", _hot(classes, "rep", total, parts), ["id"])
    nameless = made.where(F.col("id").isNull()).select("id")
    none = F.lit(None).cast("long")
    nameless = nameless.select("id", none.alias("rep"), none.alias("class_id"))
    return found.select("id", "rep", "class_id").unionAll(nameless)


def _labels(hits: DataFrame, docs: DataFrame, total: int, parts: int, similar: float) -> DataFrame:
    """``(id, comp)``: the classes of the members of buckets, ``hits(bucket, id, n)``."""
    nodes = materialize(hits.groupBy("id").agg(F.sum("n").alias("degree")), "near-nodes")
    wanted = materialize(docs.join(nodes.select("id"), "id", "left_semi").dropDuplicates(["id"]), "near-texts")
    ranked = materialize(hits.join(nodes, "id"), "near-ranked")
    best = F.max_by("id", F.struct("degree", -F.col("id"))).alias("centre")
    centre = materialize(ranked.groupBy("bucket").agg(best, F.max("n").alias("n")), "near-centres")
    hot = _hot(centre, "bucket", max(total, 1) * BANDS, parts)
    pairs = salted_join(ranked.select("bucket", "id"), centre.drop("n"), "bucket", "inner", hot, ["id"])
    pairs = _ordered(pairs.where(F.col("id") != F.col("centre")), "id", "centre")
    links = materialize(_verified(pairs, wanted, similar), "near-links")
    labels = _smallest_linked(nodes.select("id"), links, "near")
    links = links.unionAll(_across_classes(ranked, centre, labels, wanted, total, similar))
    return _smallest_linked(nodes.select("id"), materialize(links, "near-links"), "near")


def _joining(rows: dict[str, list], similar: float) -> list[tuple[int, int]]:
    """Links between the ``outside`` rows and all others of another class, without those between classes
    that other links have joined already.

    Shared shingles are counted through an inverted list of the outside rows'. The weighted similarity is the
    plain one where no shingle repeats; else it is at most the sum over shared shingles of the smaller of their two
    shares, and only worked out where that is enough.
    """
    bags = [np.unique(np.frombuffer(bag, dtype=np.uint64), return_counts=True) for bag in rows["bag"]]
    shares = [count / count.sum() for _, count in bags]
    out = [i for i, o in enumerate(rows["outside"]) if o]
    if not out:
        return []
    codes, weights = np.concatenate([bags[i][0] for i in out]), np.concatenate([shares[i] for i in out])
    sizes, classes = np.array([len(bags[i][0]) for i in out]), np.array([rows["comp"][i] for i in out])
    plain = np.array([bool((count == 1).all()) for _, count in bags])
    plain_out = plain[out]
    order = np.argsort(codes, kind="stable")
    owner = np.repeat(np.arange(len(out)), sizes)[order]
    codes, weights = codes[order], weights[order]
    parent = {c: c for c in rows["comp"]}

    def top(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    found = []
    for j, (code, _) in enumerate(bags):
        if rows["twin"][j]:
            continue
        low, high = np.searchsorted(codes, code, side="left"), np.searchsorted(codes, code, side="right")
        hits = high - low
        at = np.repeat(low - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
        shared = np.bincount(owner[at], minlength=len(out))
        most = np.bincount(owner[at], weights=np.minimum(weights[at], np.repeat(shares[j], hits)), minlength=len(out))
        even = shared / (sizes + len(code) - shared) >= similar
        weigh = (most >= similar - 1e-9) & ~(plain_out & plain[j])
        for k in np.flatnonzero((even | weigh) & (classes != rows["comp"][j])):
            i = out[k]
            x, y = top(rows["comp"][i]), top(rows["comp"][j])
            if x != y and (even[k] or similarity(bags[i], bags[j])[1] >= similar):
                parent[x] = y
                found.append((min(rows["id"][i], rows["id"][j]), max(rows["id"][i], rows["id"][j])))
    return found


def _across_classes(
    ranked: DataFrame, centre: DataFrame, labels: DataFrame, texts: DataFrame, total: int, similar: float
) -> DataFrame:
    """Links ``(a, b)`` that join classes, of all pairs of members of different classes in a bucket.

    The class of a bucket's centre stands for its largest; at least one of such a pair is outside of it.
    A bucket is dealt into pieces by ``PIECE`` shingles of those outside and ``PIECE`` of all.
    """
    parts = 16 * partitions(ranked.sparkSession)
    placed = ranked.select("bucket", "id").join(labels, "id")
    spread = F.min("comp") != F.max("comp")
    mixed = placed.groupBy("bucket").agg(spread.alias("mixed"), F.count("*").alias("n")).where("mixed")
    main = centre.select("bucket", F.col("centre").alias("id")).join(labels, "id")
    main = main.select("bucket", F.col("comp").alias("main"))
    mixed = materialize(mixed.drop("mixed").join(main, "bucket"), "near-mixed")
    hot = _hot(mixed, "bucket", max(total, 1) * BANDS, parts)
    open_ = salted_join(placed, mixed.select("bucket", "main"), "bucket", "inner", hot, ["id"])
    open_ = open_.select("bucket", "id", "comp", (F.col("comp") != F.col("main")).alias("outside"))
    open_ = materialize(open_, "near-open")
    bags = _bags(texts.join(open_.select("id").distinct(), "id", "left_semi"))
    bags = materialize(bags, "near-bags")

    sized = open_.join(bags.select("id", "n_shingles"), "id")
    size = F.col("n_shingles")
    pieces = lambda n: F.ceil(n / PIECE).cast("int")
    dealt = sized.groupBy("bucket").agg(
        pieces(F.sum(F.when(F.col("outside"), size))).alias("n_left"),
        pieces(F.sum(size)).alias("n_right"),
        F.sum(size).alias("shingles"),
        F.count("*").alias("n"),
    )
    dealt = materialize(dealt, "near-dealt")
    hot = _hot(dealt, "bucket", max(total, 1) * BANDS, parts)
    rows = salted_join(open_, dealt.drop("n", "shingles"), "bucket", "inner", hot, ["id"])
    left, right = (
        F.pmod(F.xxhash64(F.lit(side), "id"), F.col(f"n_{side}")).cast("int") for side in ("left", "right")
    )
    every = lambda side: F.sequence(F.lit(0), F.col(f"n_{side}") - 1)
    # In its own piece an outside row is both: elsewhere it stands on one side only.
    as_right = F.transform(every("left"), lambda i: F.struct(i.alias("left"), right.alias("right")))
    as_left = F.transform(every("right"), lambda i: F.struct(left.alias("left"), i.alias("right")))
    as_left = F.when(F.col("outside"), as_left).otherwise(F.array().cast("array<struct<left:int,right:int>>"))
    at = F.explode(F.array_distinct(F.concat(as_right, as_left))).alias("at")
    rows = rows.select("bucket", "id", "comp", "outside", left.alias("own_left"), right.alias("own_right"), at)
    rows = rows.select(
        "bucket", "id", "comp", "at.left", "at.right",
        (F.col("outside") & (F.col("own_left") == F.col("at.left"))).alias("outside"),
        (F.col("own_right") != F.col("at.right")).alias("twin"),
    )
    # Pieces are small as a rule: about ``PIECE`` shingles of them go to a task's call at once.
    whole = dealt.agg(F.sum(F.col("shingles") * F.col("n_left"))).first()[0] or 0
    calls = F.lit(max(4 * partitions(ranked.sparkSession), -(-whole // PIECE)))
    call = F.pmod(F.xxhash64("bucket", "left", "right"), calls).alias("call")
    schema = StructType().add("a", LongType()).add("b", LongType())
    names = to_arrow_schema(schema)

    def compare(pieces: pa.Table) -> pa.Table:
        columns = pieces.to_pydict()
        place = defaultdict(list)
        for i, key in enumerate(zip(columns["bucket"], columns["left"], columns["right"])):
            place[key].append(i)
        found = []
        for own in place.values():
            rows_of = {c: [columns[c][i] for i in own] for c in ("id", "comp", "outside", "twin", "bag")}
            found += _joining(rows_of, similar)
        return pa.Table.from_pydict({"a": [f[0] for f in found], "b": [f[1] for f in found]}, schema=names)

    rows = rows.join(bags.select("id", "bag"), "id").select("*", call)
    return rows.groupBy("call").applyInArrow(compare, schema)


def _bags(texts: DataFrame) -> DataFrame:
    """``(id, n_shingles, bag)``: the shingle hashes of each text, ascending and with repetitions."""

    def work(values: list[str]) -> dict:
        doc, code, weight, _ = shingles(values)
        ends = np.searchsorted(doc, np.arange(len(values) + 1))
        own = [np.repeat(code[s:e], weight[s:e]) for s, e in zip(ends, ends[1:])]
        return {"n_shingles": [len(x) for x in own], "bag": [x.tobytes() for x in own]}

    schema = StructType().add("n_shingles", LongType()).add("bag", BinaryType())
    return per_slice(texts, "text", schema, work, ["id"])


def _hot(counts: DataFrame, key: str, total: int, parts: int) -> DataFrame:
    """``(key, _salts)`` of the keys with more than a ``parts``-th of ``total`` rows; fewer than ``parts``, or twice
    as many buckets, of which a document has ``BANDS`` to twice ``BANDS``."""
    pieces = F.greatest(F.lit(2), F.ceil(F.col("n") * parts / total)).cast("int")
    return counts.where(F.col("n") * parts > total).select(key, pieces.alias("_salts"))


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return _compared(pairs.join(right, "b").join(left, "a"), similar)


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row of each class of near-duplicates, that of the smallest id, with all its columns; of
    rows that repeat that id, one. Rows of null id are not compared and all kept."""
    chosen = near_duplicates(docs, key, text, similar).where(F.col("id") == F.col("class_id"))
    mine = fresh(docs, "kept_id")
    chosen = chosen.select(F.col("id").alias(mine)).distinct()
    kept = docs.join(chosen, F.col(key) == F.col(mine), "left_semi").dropDuplicates([key])
    return kept.unionByName(docs.where(F.col(key).isNull()))
