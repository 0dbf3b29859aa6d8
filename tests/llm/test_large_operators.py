"""Archives, classifiers, near-duplicates, the hidden Markov model and the pipeline."""

import collections
import gzip
import hashlib
import io
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import decontaminate, hmm, near_dup, quality, secret_scan, toxicity, warc
from clickloom.shared import shared_folder

FOLDER = "/root/testdata/sf0.001"


def text_table(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def words(draw, n, letters="abcdefgh"):
    return [draw.choice(letters) + draw.choice(letters) + draw.choice(letters) for _ in range(n)]


# Archives


def arc_file(version, *records):
    return warc.arc_version_block(version, "x.arc", "19990102") + b"\n" + b"".join(r + b"\n" for r in records)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip_by_version(version):
    blocks = [warc.http_response(b"<p>\nhttp://x 1 2 3 4\n</p>", 7), b"\x00\xff\r\n\r\n", b""]
    urls = ["http://a/b c", "dns:a", "http://c"]
    data = arc_file(version, *(warc.arc_record(version, u, "1.2.3.4", "20010203040506", "text/html", b) for u, b in zip(urls, blocks)))
    for content in (data, gzip.compress(data), gzip.compress(data[:200]) + gzip.compress(data[200:])):
        found = list(warc.parse_arc(warc._opened(content)))
        assert [r["block"] for r in found[1:]] == blocks and [r["url"] for r in found] == ["filedesc://x.arc", "http://a/b%20c", "dns:a", "http://c"]
        assert not any(r["truncated"] for r in found)
        made = [warc.convert(r, "f") for r in found]
        assert [m["record_type"] for m in made] == ["warcinfo", "response", "resource", "resource"]
        assert made[1]["key"] == 7 and made[1]["date"] == "2001-02-03T04:05:06Z" and made[0]["date"] == "1999-01-02T00:00:00Z"
        assert made[1]["payload_digest"] == hashlib.sha1(b"<p>\nhttp://x 1 2 3 4\n</p>").hexdigest()
        assert len({m["record_id"] for m in made}) == 4


def test_damaged_arc():
    whole = warc.arc_record(1, "http://a b", "1.2.3.4", "2001", "text/plain", b"x" * 50)
    data = arc_file(1, b"noise without a length", whole, whole[:-20])
    found = list(warc.parse_arc(io.BytesIO(data)))
    assert [(r["url"], len(r["block"]), r["truncated"]) for r in found[1:]] == [("http://a%20b", 50, False), ("http://a%20b", 31, True)]
    spaced = whole.replace(b"a%20b", b"a b")
    assert [r["url"] for r in warc.parse_arc(io.BytesIO(arc_file(1, spaced)))][1:] == ["http://a b"]
    assert warc.warc_date("not a date") == "1970-01-01T00:00:00Z" and warc.warc_date("199613") == "1970-01-01T00:00:00Z"


def test_archives_out_of_the_ordinary():
    """Other declared fields, bare line feeds, a gzip file cut short, a length that is no number."""
    body = b"HTTP/1.0 200 OK\nServer: x\n\none\r\n\r\ntwo"
    head = "2 0 x\nURL Content-type Archive-length\n"
    version = f"filedesc://x 0.0.0.0 20200101000000 text/plain {len(head)}\n{head}\n".encode()
    record = f"http://a/ text/html {len(body)}\n".encode() + body
    made = [warc.convert(r, "x.arc", "2020-01-01T00:00:00Z") for r in warc.parse_arc(warc._opened(version + record))]
    assert [(m["record_type"], m["target_uri"], m["date"], m["ip"]) for m in made[1:]] == [("response", "http://a/", "2020-01-01T00:00:00Z", None)]
    assert made[1]["payload"] == b"one\r\n\r\ntwo" and made[1]["head"] == b"HTTP/1.0 200 OK\nServer: x\n\n"

    noise = random.Random(1).randbytes(100_000)
    whole = b"".join(warc.arc_record(1, f"http://{i}/", "1.2.3.4", "20200101000000", "text/plain", noise) for i in range(3))
    packed = gzip.compress(whole)
    cut = list(warc.parse_arc(warc._opened(packed[: len(packed) // 2])))
    assert [r["truncated"] for r in cut] == [False, True] and noise.startswith(cut[1]["block"])

    bad = b"WARC/1.1\r\nContent-Length: many\r\n\r\nx\r\n\r\nWARC/1.1\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    assert [block for _, block in warc.parse_warc(warc._opened(bad))] == [b"ok"]


def test_files_are_bounded_by_bytes(spark):
    pages = spark.createDataFrame([(i, f"http://{i}/", "x" * (1_000 if i else 9_000)) for i in range(20)], "page_id long, url string, html string")
    path = shared_folder(spark, "arc-test")
    warc.write_arc(pages.coalesce(1), path, file_bytes=3_000)
    sizes = [len(gzip.decompress(bytes(r["content"]))) for r in spark.read.format("binaryFile").load(f"{path}/*.gz").collect()]
    assert len(sizes) > 6 and sorted(sizes)[-2] < 3_500 < 9_000 < max(sizes)
    assert warc.read_arc(spark, path).where("record_type = 'response'").count() == 20


def test_archive_pages(spark):
    big, other = "é" * 600, "<p>\r\n\r\nWARC/1.1\r\n" + "y" * 2000
    rows = [(1, "u1", big), (5, "u 5", big), (3, None, big), (2, "u2", "small"), (4, "u4", "small"), (6, "u6", None),
            (None, "u7", other), (7, "u7", other), (8, "u8", ""), (9, "u9", "z" * 300_000), (10, "u10", big + "x"), (10, "u10", big + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash")).repartition(3)
    got = warc.archive_pages(pages).collect()
    seen = {(r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to_key"]) for r in got}
    sha = lambda t: (len((t or "").encode()), hashlib.sha1((t or "").encode()).hexdigest())
    first = {big: 5, other: 7}
    want = set()
    for k, _, html in rows:
        again = html in first and first[html] != k
        want.add((k, *sha(html), "revisit" if again else "response", first[html] if again else None))
    twice = (10, *sha(big + "x"))
    want |= {(*twice, "revisit", 10), (*twice, "response", None)}
    assert len(got) == len(rows) and seen == want
    payloads = {r["key"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert payloads[7] == other and payloads[9] == "z" * 300_000
    assert warc.archive_pages(pages.limit(0)).count() == 0


# Classifiers


def labelled(spark, n=240):
    draw = random.Random(3)
    texts, rows = [], []
    for i in range(n):
        own = words(draw, draw.randint(30, 80))
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            for _ in range(5):
                own.insert(draw.randrange(len(own)), draw.choice(["idiot", "M0R0N", "grumpfeln", "grumpfig"]))
        texts.append(" ".join(own) if good else "!!! ".join(w.upper() for w in own))
        rows.append((i, int(good), int(toxic)))
    return text_table(spark, texts), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("model, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_on_held_out_rows(spark, model, label):
    docs, labels = labelled(spark)
    scored = model.score_documents(docs, labels.where("doc_id < 160"), label=label)
    held = scored.join(labels, "doc_id").where("doc_id >= 160").select("score", label).collect()
    right = sum((r["score"] >= 0.5) == bool(r[label]) for r in held) / len(held)
    assert right > 0.93 and all(0 <= r["score"] <= 1 for r in held)


@pytest.mark.parametrize("model, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_of_odd_rows(spark, model, label):
    docs, labels = labelled(spark, 60)
    odd = text_table(spark, [None, "", "w " * 60_000, "same", "same"], [900, 901, 902, 903, None])
    every = docs.unionAll(odd).unionAll(odd)
    scored = model.score_documents(every, labels.unionByName(spark.createDataFrame([(None, None, None)], labels.schema)), label=label)
    rows = scored.select("doc_id", "score").collect()
    assert len(rows) == 70 and all(0 <= r["score"] <= 1 for r in rows)
    for few, score in ((labels.limit(0), 0.0), (labels.where(f"{label} = 1"), 1.0)):
        assert {r["score"] for r in model.score_documents(odd, few, label=label).collect()} <= {score, 0.0}
    assert model.score_documents(docs.limit(0), labels, label=label).count() == 0


def test_toxicity_keeps_columns_of_its_own_names(spark):
    docs, labels = labelled(spark, 120)
    for name in ("score", "features", "label", "part", "vector", "raw", "margin", "kind"):
        docs = docs.withColumn(name, F.lit("own"))
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 60 < kept.count() < 115
    assert kept.where("score = 'own' and raw = 'own'").count() == kept.count()


def test_toxic_words_in_disguise():
    hidden = toxicity.FEATURES.index("hidden_hits")
    for text in ("an 1d10t here", "stuuuuupid thing", "what an i d i o t you are", "m.o.r.o.n then"):
        assert toxicity.text_features([text])[0, hidden] > 0, text
    near = toxicity.FEATURES.index("near_second")
    assert toxicity.text_features(["you are an idiot", "idiot " + "x " * 9 + "you"])[:, near].tolist() == [1, 0]
    assert not toxicity.text_features([""]).any()


def test_random_indexing_by_loop():
    texts = ["a b c a", "", "b a"]
    table = np.zeros((quality.BUCKETS, quality.WIDTH))
    quality.add_contexts(table, texts)
    want = np.zeros_like(table)
    for text in texts:
        own = text.split()
        codes = quality.mix(np.array([zlib.crc32(w.encode()) for w in own], dtype=np.uint64) + np.uint64(1))
        for i in range(len(own)):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                for k in range(quality.NONZERO if i != j else 0):
                    draw = int(quality.mix(codes[j : j + 1] + np.uint64(1000 + k))[0])
                    want[int(codes[i]) % quality.BUCKETS, draw % quality.WIDTH] += 1 if draw >> 63 else -1
    assert np.array_equal(table, want)


# Near-duplicates


def shingle_counts(text):
    own = re.findall(r"\w+", text.lower())
    return collections.Counter(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else collections.Counter()


def both_similarities(a, b):
    common = a.keys() & b.keys()
    weighted = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in common)
    return len(common) / max(1, len(a.keys() | b.keys())), weighted


def test_similarity_and_signature_agree_with_the_definition():
    draw = random.Random(4)
    for _ in range(6):
        base = words(draw, 150)
        other = list(base)
        for _ in range(draw.randint(1, 25)):
            other[draw.randrange(len(other))] = "zzz"
        base[50:50] = base[:20] * draw.randint(0, 3)
        texts = [" ".join(base), " ".join(other)]
        doc, code, weight, _ = near_dup.shingles(texts)
        sets = [(code[doc == d], weight[doc == d]) for d in (0, 1)]
        want = both_similarities(*map(shingle_counts, texts))
        assert near_dup.similarity(*sets) == pytest.approx(want)
        signature = near_dup.signatures(doc, code, weight, 2)
        assert abs((signature[0] == signature[1]).mean() - want[1]) < 0.15


def classes_by_force(texts):
    counts = [shingle_counts(t or "") for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if counts[i] == counts[j] or counts[i] and counts[j] and max(both_similarities(counts[i], counts[j])) >= 0.8:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(texts))]


def near_texts(seed, groups, each, n=60):
    """Copies of copies, each a few words off, so that classes hang together by chains."""
    draw, out = random.Random(seed), []
    for _ in range(groups):
        text = words(draw, n)
        for _ in range(each):
            out.append(" ".join(text))
            text = list(text)
            text[draw.randrange(n)] = "".join(draw.choice("xyz") for _ in range(4))
    draw.shuffle(out)
    return out


def test_classes_match_brute_force(spark):
    draw = random.Random(6)
    shared = " ".join(words(draw, 40))
    passages = [shared + " " + " ".join(words(draw, 30)) for _ in range(25)]
    texts = near_texts(1, 8, 9) + passages + ["", None, "two words", "Two words.", "a b c d e", "a b c d f", "", "w " * 20_000] * 2
    found = near_dup.near_duplicates(text_table(spark, texts).withColumn("bands", F.lit(1)))
    got = {r["id"]: r["class_id"] for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_force(texts)


def test_texts_that_differ_in_repetitions_only(spark):
    """Links by the plain similarity alone are found whatever the weighted one, and the other way round."""
    draw, texts = random.Random(7), []
    for i in range(10):
        own = words(draw, 104)
        part, other = own[20:34], own[60:74]
        texts += [" ".join(own), " ".join(own[:34] + part * 50 + own[34:]), " ".join(own[:74] + other * (40 + i) + own[74:])]
        texts += [" ".join(own[20:34] * 60 + words(draw, 30))]
    pairs = [(shingle_counts(a), shingle_counts(b)) for a, b in zip(texts[::4], texts[1::4])]
    assert all(plain >= 0.8 and weighted < 0.3 for plain, weighted in (both_similarities(*p) for p in pairs))
    found = {r["id"]: r["class_id"] for r in near_dup.near_duplicates(text_table(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == classes_by_force(texts)


def test_a_large_bucket_is_compared_in_pieces(spark, monkeypatch):
    """In pieces of two or three texts, a chain of copies still ends in one class."""
    monkeypatch.setattr(near_dup, "PIECE", 120)
    texts = near_texts(2, 2, 14, 50)
    found = {r["id"]: r["class_id"] for r in near_dup.near_duplicates(text_table(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == classes_by_force(texts)


def test_near_duplicates_of_odd_tables(spark):
    table = text_table(spark, ["a b c d e f"] * 3 + [None, "q"], [1, 1, None, 2, None])
    got = sorted((tuple(r) for r in near_dup.near_duplicates(table).collect()), key=repr)
    assert got == [(1, 1, 1), (1, 1, 1), (2, 2, 2), (None, None, None), (None, None, None)]
    kept = near_dup.first_of_each(table.withColumn("kept_id", F.lit(0)))
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, None, None] and kept.columns[-1] == "kept_id"
    assert near_dup.near_duplicates(table.limit(0)).count() == 0
    shared = text_table(spark, ["a b c d e f", "g h i j k l", "g h i j k l", "a b c d e f"], [5, 5, 6, 7])
    assert near_dup.near_duplicates(shared).count() == 4


# Hidden Markov model


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or "")) if w] + [""]


def test_forward_is_the_sum_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "CLASSES", 5)
    monkeypatch.setattr(hmm, "STATES", 2)
    draw = np.random.default_rng(1)
    model = hmm.Model(*(x / x.sum(axis=a, keepdims=True) for x, a in ((draw.random(2), 0), (draw.random((2, 2)), 1), (draw.random((5, 2)), 0))))
    flat, sizes = np.array([0, 3, 4, 1, 2, 2, 0]), np.array([4, 1, 2])
    starts = np.cumsum(sizes) - sizes
    want = []
    for s, n in zip(starts, sizes):
        total = 0.0
        for path in np.ndindex(*(2,) * n):
            p = model.start[path[0]] * model.emit[flat[s], path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * model.emit[flat[s + t], path[t]]
            total += p
        want.append(math.log(total))
    assert hmm.log_likelihoods(model, flat, starts, sizes) == pytest.approx(want)


def test_rounds_raise_the_likelihood_and_counts_add_up():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 60, 40)
    flat = np.concatenate([draw.integers(0, 20, n) + 40 * (i % 2) for i, n in enumerate(sizes)]).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    model, last = hmm.Model.initial(np.bincount(flat, minlength=hmm.CLASSES)), -np.inf
    for _ in range(5):
        likely = hmm.log_likelihoods(model, flat, starts, sizes).sum()
        assert likely > last - 1e-6
        last, counts = likely, np.zeros(hmm.N_CELLS)
        hmm.add_counts(counts, model, flat, starts, sizes)
        assert counts.sum() == pytest.approx(len(sizes) + (sizes - 1).sum() + sizes.sum())
        model = hmm.Model.from_counts(counts)


def test_counts_are_those_of_whole_texts_whatever_the_part(monkeypatch):
    draw = np.random.default_rng(3)
    sizes = np.array([1, 700, 3, 64, 65, 128, 2, 1, 333])
    flat = draw.integers(0, hmm.CLASSES, sizes.sum()).astype(np.int32)
    flat[::2] = draw.integers(0, 9, len(flat[::2]))
    starts = np.cumsum(sizes) - sizes
    model = hmm.Model.initial(np.bincount(flat, minlength=hmm.CLASSES))
    model.start[:] = [0.5, 0.2, 0.1, 0.1, 0.05, 0.05]
    found = []
    for part in (10_000, 64, 7, 1):
        monkeypatch.setattr(hmm, "SEGMENT", part)
        found.append(np.zeros(hmm.N_CELLS))
        hmm.add_counts(found[-1], model, flat, starts, sizes)
    for other in found[1:]:
        np.testing.assert_allclose(other, found[0], rtol=1e-8, atol=1e-10)
    hmm.add_counts(found[0], model, flat, starts[:0], sizes[:0])


def test_counts_are_the_expectations_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm, "CLASSES", 5)
    monkeypatch.setattr(hmm, "STATES", 2)
    monkeypatch.setattr(hmm, "SEGMENT", 3)
    draw = np.random.default_rng(4)
    model = hmm.Model(*(x / x.sum(axis=a, keepdims=True) for x, a in ((draw.random(2), 0), (draw.random((2, 2)), 1), (draw.random((5, 2)), 0))))
    flat = np.array([0, 3, 4, 1, 2, 2, 0, 4])
    want, total = np.zeros(2 + 4 + 10), 0.0
    for path in np.ndindex(*(2,) * len(flat)):
        own = np.zeros(len(want))
        own[path[0]] += 1
        p = model.start[path[0]]
        for t, s in enumerate(path):
            p *= model.emit[flat[t], s] * (model.move[path[t - 1], s] if t else 1)
            own[6 + 2 * flat[t] + s] += 1
            if t:
                own[2 + 2 * path[t - 1] + s] += 1
        want, total = want + p * own, total + p
    got = np.zeros(len(want))
    hmm.add_counts(got, model, flat, np.array([0]), np.array([len(flat)]))
    assert got == pytest.approx(want / total)


def test_long_texts_are_scored_in_parts_and_only_parts_between_need_matrices(monkeypatch):
    draw = np.random.default_rng(5)
    sizes = np.array([1, 9, 20, 10, 47, 11, 30, 3, 21])
    flat = draw.integers(0, 50, sizes.sum()).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    model = hmm.Model.initial(np.bincount(flat, minlength=hmm.CLASSES))
    want = []
    for s, n in zip(starts, sizes):
        state, total = model.start, 0.0
        for t in range(n):
            state = (state @ model.move if t else state) * model.emit[flat[s + t]]
            total, state = total + math.log(state.sum()), state / state.sum()
        want.append(total)
    steps, parts, padded, transfers = [], [], hmm._padded, hmm._transfers
    monkeypatch.setattr(hmm, "SEGMENT", 10)
    monkeypatch.setattr(hmm, "_padded", lambda c, s, n: steps.append(int(n[0])) or padded(c, s, n))
    monkeypatch.setattr(hmm, "_transfers", lambda m, c, s, n: parts.append(len(s)) or transfers(m, c, s, n))
    assert hmm.log_likelihoods(model, flat, starts, sizes) == pytest.approx(want, rel=1e-10)
    hmm.add_counts(np.zeros(hmm.N_CELLS), model, flat, starts, sizes)
    assert max(steps) <= 10
    assert parts == [sum(max(0, -(-n // 10) - 2) for n in sizes)] * 2
    assert hmm.log_likelihoods(model, flat, starts[:0], sizes[:0]).shape == (0,)


def test_odds_of_a_very_large_corpus_do_not_vanish_between_scalings(monkeypatch):
    draw = np.random.default_rng(6)
    sizes = np.array([1, 2, 7, 8, 9, 40, 200])
    flat = draw.integers(0, hmm.STATES, sizes.sum()).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    move = np.full((hmm.STATES, hmm.STATES), 1e-13) + np.eye(hmm.STATES)
    emit = np.full((hmm.CLASSES, hmm.STATES), 1e-14)
    emit[: hmm.STATES] += np.eye(hmm.STATES)  # each state has a word of its own, and never moves
    model = hmm.Model(np.full(hmm.STATES, 1 / hmm.STATES), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    found = []
    for rescale, part in ((1, 10_000), (hmm.RESCALE, 10_000), (hmm.RESCALE, 16)):
        monkeypatch.setattr(hmm, "RESCALE", rescale)
        monkeypatch.setattr(hmm, "SEGMENT", part)
        counts = np.zeros(hmm.N_CELLS)
        hmm.add_counts(counts, model, flat, starts, sizes)
        found.append((hmm.log_likelihoods(model, flat, starts, sizes), counts))
    assert np.isfinite(found[0][0]).all() and found[0][1].sum() == pytest.approx(len(sizes) + (sizes - 1).sum() + sizes.sum())
    for likely, counts in found[1:]:
        np.testing.assert_allclose(likely, found[0][0], rtol=1e-10)
        np.testing.assert_allclose(counts, found[0][1], rtol=1e-8, atol=1e-10)


def test_scores_of_texts(spark, monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK_CHARS", 200)
    draw = random.Random(8)
    texts = [" ".join(words(draw, draw.randint(0, 30), "abC")) for _ in range(40)] + [None, "", "É é\x0b\xa0 A", "new " * 3000, "same", "same"]
    ids = [*range(len(texts) - 1), None]
    table = text_table(spark, texts, ids).withColumn("block", F.lit(1)).repartition(3)
    held = F.coalesce(F.col("doc_id") % 5 == 2, F.lit(False)).alias("held_out")
    got = {r["doc_id"]: r for r in hmm.score_texts(table, held).collect()}
    learned = collections.Counter(w for i, t in zip(ids, texts) if i is None or i % 5 != 2 for w in tokens(t))
    n, v = sum(learned.values()), len(learned)
    assert len(got) == len(texts)
    for i, t in zip(ids, texts):
        own = tokens(t)
        want = (i is not None and i % 5 == 2, len(own), sum(learned[w] > 0 for w in own), n)
        assert tuple(got[i])[1:5] == want
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((learned[w] + 1) / (n + v + 1)) for w in own))
        assert got[i]["score"] < 0
    assert hmm.score_texts(table.limit(0), held).count() == 0
    nothing = hmm.score_texts(table, F.lit(True).alias("held_out")).collect()
    assert all(r["base_score"] == 0 and r["train_tokens"] == 0 for r in nothing)


# Pipeline


def test_pipeline_matches_its_stages_by_hand(spark):
    """Every stage against brute force over what the one before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    kept = sorted(d for d in rows if scores[d] < toxicity.REJECT)
    classes = classes_by_force([rows[d]["text"] for d in kept])
    kept = [kept[i] for i in sorted(set(classes))]
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    plain = lambda t: re.sub(r"[^\w\s]", "", t.lower()).split()

    def asks(text):
        own = plain(text)
        seen = {tuple(own[i : i + 8]) for i in range(len(own) - 7)}
        for item in items:
            w = plain(item)
            parts = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
            if parts and sum(p in seen for p in parts) >= decontaminate.SHARE * len(parts):
                return True
        return False

    kept = [d for d in kept if not asks(rows[d]["text"])]
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert set(r["doc_id"] for r in final) <= set(kept) and len(final) > 0.7 * len(kept)
    for r in final:
        text = rows[r["doc_id"]]["text"]
        spans = secret_scan.base_spans(text) + secret_scan.entropy_spans(text)
        assert ("[secret]" in r["text"]) == bool(spans) and (spans or r["text"] == text)
    assert [name for name, _ in corpus_pipeline.STAGES][:2] == ["toxicity", "minhash near-dedup"]


def test_stages_keep_the_columns_and_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
