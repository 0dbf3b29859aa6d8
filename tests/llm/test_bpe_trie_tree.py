"""Byte-level BPE, the conversation trie and hard negatives against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe, hyperplane_tree, prefix_trie
from clickloom.llm.common import remainder
from clickloom.llm.queries import PATTERN, RANKS
from tests.conftest import rows

# --- byte-level BPE ------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def one_match(ranks):
    """The library's encoding of a whole text as one match."""
    return tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_merges_like_the_library(ranks):
    """All at once and one by one."""
    vocabulary, dice, whole = byte_bpe.Vocabulary(ranks), random.Random(1), one_match(ranks)
    texts = ["".join(dice.choice("abcdehinorst漢é") for _ in range(dice.randint(1, 200))) for _ in range(300)]
    texts += ["a" * 5000, "ab" * 5000, "é" * 999, "z"]
    want = [tuple(whole(text)) for text in texts if text.encode() not in ranks]
    parted = [text.encode() for text in texts if text.encode() not in ranks]
    assert byte_bpe.merge(vocabulary, parted) == want
    assert [byte_bpe.merge(vocabulary, [match])[0] for match in parted] == want


def test_lower_rank_made_by_a_merge_comes_first():
    """Merging b and c makes a pair of lower rank than the next in the bucket."""
    dice, single = random.Random(2), {bytes([b]): b for b in range(256)}
    vocabularies = [single | {b"abc": 300, b"bc": 400, b"abcd": 350, b"cd": 390}]
    for _ in range(20):  # ranks in any order
        pieces = {"".join(dice.choice("abc") for _ in range(dice.randint(2, 5))).encode() for _ in range(30)}
        vocabularies.append(single | dict(zip(pieces, dice.sample(range(256, 600), len(pieces)))))
    for ranks in vocabularies:
        whole = one_match(ranks)
        texts = ["".join(dice.choice("abcd") for _ in range(dice.randint(1, 80))) for _ in range(20)]
        texts = [text for text in texts if text.encode() not in ranks]
        assert byte_bpe.merge(byte_bpe.Vocabulary(ranks), [t.encode() for t in texts]) == [tuple(whole(t)) for t in texts]


def test_encode_and_decode(spark, ranks, library):
    texts = ["It's 1234 words,\n\n  and   ends ", "", None, "<|endoftext|> x", "\x1c  漢字 ñandú 😀", "x" * 70_000 + " 1" * 999, "same", "same"]
    docs = spark.createDataFrame([(i % 7, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = byte_bpe.encode(docs, ranks, PATTERN, keep=["doc_id", "ids"])
    assert coded.columns == ["doc_id", "ids", "_ids"]
    want = sorted((i % 7, library.encode_ordinary(t or "")) for i, t in enumerate(texts))
    assert sorted((r["doc_id"], r["_ids"]) for r in coded.collect()) == want
    decoded = byte_bpe.decode(coded.withColumn("data", F.lit(1)), ranks, ids="_ids")
    assert decoded.columns == ["doc_id", "ids", "data", "_data"]
    assert sorted((r["doc_id"], bytes(r["_data"]).decode()) for r in decoded.collect()) == sorted((i % 7, t or "") for i, t in enumerate(texts))


def test_encode_no_rows_and_null_lists(spark, ranks):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(empty, ranks, PATTERN), ranks).collect() == []
    lists = spark.createDataFrame([(1, None), (2, []), (3, [0])], "doc_id long, ids array<int>")
    assert [bytes(r["data"]) for r in byte_bpe.decode(lists, ranks).orderBy("doc_id").collect()] == [b"", b"", b"!"]


def test_bytes_and_ids_without_a_piece(spark):
    with pytest.raises(ValueError, match="no piece for the byte"):
        byte_bpe.merge(byte_bpe.Vocabulary({b"a": 0}), [b"ab"])
    lists = spark.createDataFrame([([5],)], "ids array<int>")
    with pytest.raises(Exception, match="vocabulary lacks"):
        byte_bpe.decode(lists, {b"a": 0, b"b": 9}).collect()


# --- conversation trie ---------------------------------------------------------------


def brute_trie(turns):
    """Nodes of ``(conv, turn, role, text)`` rows, by the definition."""
    said = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            said[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    said = {c: [t[1:] for t in sorted(own, key=lambda t: t[0])] for c, own in said.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # as SQL: with the sign of c
        rebuilt[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, own in sorted(rebuilt.items()):
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)

    def totals(node):
        parts = [totals(child) for child in below[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        return sum(p[0] for p in parts) or 1, saved + sum(p[1] for p in parts)

    return [
        (
            own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(below[node]), *totals(node),
            hashlib.sha256(",".join(str(c) for c in own if rebuilt[c] == node).encode()).hexdigest(),
        )
        for node, own in members.items()
    ]


TURNS = "conv_id long, turn long, role string, text string"


def trie(spark, turns):
    df = spark.createDataFrame(turns, TURNS).withColumn("depth", F.lit("clash"))
    numbered = prefix_trie.numbered_turns(df)
    return prefix_trie.prefix_trie(*prefix_trie.shared_heads(*numbered, 5, remainder("conv", 9)))


def drawn_turns(seed, convs, longest):
    dice = random.Random(seed)
    turns = []
    for c in range(convs):
        for t in range(dice.randint(1, longest)):
            turn = dice.choice([None, 0]) if t == 0 else t
            turns.append((c, turn, dice.choice(["user", "bot", None]), dice.choice(["", None, "hé", "yes"])))
    return turns


def found_nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, convs, longest", [(1, 40, 8), (2, 23, 40)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, convs, longest):
    """Also with pieces and written rows of two, so that both are put together again."""
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    monkeypatch.setattr(prefix_trie, "WRITTEN", 2)
    turns = drawn_turns(seed, convs, longest)
    assert found_nodes(trie(spark, turns)) == sorted(brute_trie(turns), key=repr)


def test_trie_of_odd_rows(spark):
    """A null conversation, a conversation that loses all its turns, repeated rows, a long text."""
    turns = [(None, 1, "user", "x"), (7, 1, "user", "gone"), (5, 1, "user", "a" * 100_000), (6, 1, None, None), (6, 1, None, None), (6, 1, None, None)]
    turns += [(-3, 1, "a", "b"), (-5, 1, "user", "c"), (0, 2, "user", "d")]
    assert found_nodes(trie(spark, turns)) == sorted(brute_trie(turns), key=repr)
    assert trie(spark, []).collect() == []


# --- hard negatives ------------------------------------------------------------------


def brute_negatives(vectors):
    taking = [
        (i, label, np.floor(256 * np.array(v, dtype=float)))
        for i, label, v in vectors
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max([len(v) for *_, v in taking], default=0)
    taking = [(i, label, [int(x) for x in v] + [0] * (width - len(v))) for i, label, v in taking]
    out = []
    for at, (anchor, label, v) in enumerate(taking):
        if anchor % 10:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w)), i, n) for n, (i, _, w) in enumerate(taking))
        positives = [r for r in ranked if r[2] != at and taking[r[2]][1] == label][:5]
        for minus, positive, _ in positives:
            fits = [r for r in ranked if taking[r[2]][1] != label and -30 * minus <= -100 * r[0] <= -90 * minus][:10]
            out += [(anchor, positive, k + 1, r[1], -minus, -r[0]) for k, r in enumerate(fits)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, id string"


def negatives(spark, vectors, **options):
    df = spark.createDataFrame([(i, v, label, "clash") for i, label, v in vectors], VECTORS)
    index = hyperplane_tree.build_index(df, "vec_id", "embedding", F.col("label"), **options)
    return rows(hyperplane_tree.hard_negatives(index, spark, F.col("id") % 10 == 0))


def drawn_vectors(seed, n, width=6):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(5, width))
    made = centres[dice.integers(5, size=n)] + 0.4 * dice.normal(size=(n, width))
    return [(i, int(dice.integers(3)), [float(x) for x in np.float32(v)]) for i, v in enumerate(made)]


@pytest.mark.parametrize("options", [{"leaf_rows": 8}, {"leaf_rows": 8, "sample_rows": 60, "block_rows": 16}, {}])
def test_negatives_equal_brute_force(spark, options):
    vectors = drawn_vectors(3, 300)
    vectors += [(1000 + i, 1, vectors[0][2]) for i in range(60)]  # one vector, many rows
    assert negatives(spark, vectors, **options) == sorted(brute_negatives(vectors), key=repr)


def test_negatives_of_odd_rows(spark):
    odd = [(10, None, [1.0]), (None, 1, [1.0]), (20, 1, None), (30, 1, [float("nan"), 1.0]), (40, 1, [float("inf")]), (50, 1, [None, 1.0])]
    short = [(60, 1, []), (61, 2, [0.5]), (62, 1, [0.7, 0.1]), (70, 1, [0.9, 0.2]), (71, 2, [0.4, 0.0]), (71, 2, [0.4, 0.0])]
    assert negatives(spark, odd + short) == sorted(brute_negatives(odd + short), key=repr)
    assert negatives(spark, odd) == [] and negatives(spark, []) == []
    huge = [(i, i % 3, [1e5 * (i + 1), -3e4 * i, 1e4]) for i in range(40)]
    assert negatives(spark, huge, leaf_rows=8) == sorted(brute_negatives(huge), key=repr)


def test_tree_rules_out_leaves_but_no_row():
    """Windows of high scores leave few leaves, and those hold every row in the window."""
    dice = np.random.default_rng(5)
    made = np.floor(256 * (4 * dice.normal(size=(20, 4)).repeat(50, axis=0) + 0.1 * dice.normal(size=(1000, 4))))
    tree = hyperplane_tree.Tree(made[::4], leaf_rows=8)
    leaf, passed = tree.walk(made)
    norms = (made**2).sum(axis=1)
    with np.errstate(all="ignore"):
        tree.measure({
            i: (np.fmin.reduce(passed[leaf == i]), np.fmax.reduce(passed[leaf == i]), norms[leaf == i].min(), norms[leaf == i].max())
            for i in np.unique(leaf).tolist()
        })
    asked = made[:40]
    found = asked @ made.T
    most = found.max(axis=1)
    least = most - 0.02 * np.abs(most)
    visited = defaultdict(set)
    for one, at in tree.search(asked, least, most):
        for i in at.tolist():
            visited[i].add(one)
    for i in range(len(asked)):
        inside = np.flatnonzero((found[i] >= least[i]) & (found[i] <= most[i]))
        assert set(leaf[inside].tolist()) <= visited[i]
    assert sum(map(len, visited.values())) < len(asked) * tree.leaves / 2
