"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are the densities of two lexicons (a given one, as written and after undoing
look-alike letters, stretched letters and spaced-out words; and words and word beginnings that labelled
texts show to be telling), how often their words stand near a second person, and rates of
capitals, punctuation and obfuscated words. Spark's own trees and isotonic regression learn from
labelled rows; lexicon, trees and calibration each from other rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from clickloom.llm.common import WordIds, fresh, per_slice
from clickloom.shared import materialize

# Labelled rows that the model learns from, on average at most (a hash draws them).
SAMPLE_ROWS = 20_000
# Of so many parts of the drawn rows, the first go to the learned lexicon, the next to the trees, the rest
# to the calibration.
PARTS, LEXICON_PARTS, TREE_PARTS = 6, 3, 2
REJECT = 0.7
NEAR = 5  # words

# A word or beginning is telling if it is in this many toxic texts, so many times as frequent there as
# elsewhere, and the likelihood ratio statistic is this large; at most so many are kept.
LEAST_TEXTS, LEAST_LIFT, LEAST_G = 4, 4.0, 18.0
LEARNED_WORDS = 5_000
BEGINNINGS = (5, 6, 7)

LEXICON = frozenset(
    "idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown clowns "
    "imbecile jerk creep freak vermin filth filthy ugly useless retard retarded bastard bastards "
    "bitch bitches whore slut asshole assholes dick cunt fuck fucking fucker shit shitty crap "
    "idiota idiotas estupido estupida imbecil basura asqueroso patetico mierda puta cabron "
    "idiote imbecile debile connard connasse salope merde ordure minable pathetique degueulasse "
    "dumm dummkopf trottel arschloch scheisse abschaum widerlich wertlos erbarmlich schwachkopf hure".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tus usted ustedes vosotros".split()
)
LOOKALIKE = str.maketrans("013457@$!|+€", "oieastasiite")
EDGE = ".,;:!?\"'()[]{}<>«»„“”…-–*_~/\\#&%$|+="

FEATURES = (
    "hits", "hidden_hits", "learned_hits", "distinct_hits", "distinct_learned", "log_hits", "second", "near_second", "capitals", "caps_words",
    "exclaiming", "repeated_marks", "obfuscated", "stretched", "log_words",
)
_PER_WORD = 11


def _squeezed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


_SQUEEZED = frozenset(map(_squeezed, LEXICON))
_STRETCH = re.compile(r"(\w)\1\1")


def stems(word: str) -> list[str]:
    """A word without its edges, marked by a blank, and its beginnings; none of a word below three letters."""
    low = word.strip(EDGE).lower()
    return [f"{low} ", *(low[:n] for n in BEGINNINGS if len(low) > n)] if len(low) > 2 else []


def _word(word: str, learned: frozenset[str]) -> tuple:
    """Hit, hidden hit, learned hit, second person, letters, capitals, caps word, ! and ?, repeated marks,
    mixed, stretched."""
    told = bool(learned) and not learned.isdisjoint(stems(word))
    core = word.strip(EDGE)
    low = core.lower()
    hit = low in LEXICON
    plain_word = core.isalpha()
    letters = len(word) if word.isalpha() else sum(map(str.isalpha, word))
    capitals = 0 if word.islower() else sum(map(str.isupper, word))
    mixed = not plain_word and any(map(str.isalpha, core))
    stretched = bool(_STRETCH.search(low))
    hidden = False
    if not hit and (mixed or stretched):
        plain = "".join(c for c in low.translate(LOOKALIKE) if c.isalpha())
        hidden = plain in LEXICON or (stretched or plain != low) and len(plain) > 3 and _squeezed(plain) in _SQUEEZED
    marks = 0 if plain_word and core == word else word.count("!") + word.count("?")
    caps = letters > 2 and capitals == letters
    return (hit, hidden, told, low in SECOND_PERSON, letters, capitals, caps, marks, marks > 1, mixed, stretched)


def _spelled(words: list[str], single: np.ndarray) -> int:
    """Lexicon words that are spelled out in runs of four or more one-letter words."""
    found, at = 0, 0
    while at < len(single):
        end = at
        while end < len(single) and single[end]:
            end += 1
        if end - at >= 4:
            run = "".join(words[at:end]).lower().translate(LOOKALIKE)
            found += any(run[i:j] in LEXICON for i in range(len(run)) for j in range(i + 4, min(len(run), i + 12) + 1))
        at = max(end, at + 1)
    return found


def text_features(texts: list[str], learned: frozenset[str] = frozenset()) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text has zeros."""
    ids = WordIds()
    words = [t.split() for t in texts]
    numbers = [np.fromiter(map(ids.__getitem__, w), dtype=np.int64, count=len(w)) for w in words]
    table = np.array([_word(w, learned) for w in ids.words], dtype=np.float32).reshape(len(ids.words), _PER_WORD)
    one = np.array([len(w.strip(EDGE)) == 1 for w in ids.words], dtype=bool)
    out = np.zeros((len(texts), len(FEATURES)))
    for i, own in enumerate(numbers):
        n = len(own)
        if not n:
            continue
        rows = table[own]
        hit, hidden, told, second, letters, capitals, caps, marks, repeated, mixed, stretched = rows.sum(axis=0, dtype=np.float64)
        single = one[own]
        if single.sum() >= 4:
            hidden += _spelled([w.strip(EDGE) for w in words[i]], single)
        at = np.flatnonzero(rows[:, :3].any(axis=1))
        you = np.flatnonzero(rows[:, 3])
        near = 0
        if len(at) and len(you):
            right = np.searchsorted(you, at)
            gap = np.minimum(np.abs(at - you[np.minimum(right, len(you) - 1)]), np.abs(at - you[np.maximum(right - 1, 0)]))
            near = int((gap <= NEAR).sum())
        length = max(len(texts[i]), 1)
        out[i] = (
            hit / n, hidden / n, told / n, len(np.unique(own[rows[:, :2].any(axis=1)])), len(np.unique(own[rows[:, 2] > 0])),
            np.log1p(len(at)), second / n, near, capitals / max(letters, 1),
            caps / n, marks / length, repeated / n, mixed / n, stretched / n, np.log1p(n),
        )
    return out


def drawn(labels: DataFrame, key: str, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(key, label, part)`` of about ``rows`` rows of ``labels`` at most, by a hash of the key; rows with a null are
    left out."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    share = min(1.0, rows / max(known.count(), 1))
    mine = F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1_000_000)) < F.lit(int(1_000_000 * share))
    part = F.pmod(F.xxhash64(F.lit("part"), key), F.lit(PARTS)).cast("int")
    return known.where(mine).select(key, F.col(label).cast("int").alias("label"), part.alias("part")).dropDuplicates([key])


def learn_lexicon(taught: DataFrame) -> frozenset[str]:
    """The telling words and beginnings of ``taught(text, label)``, whose rows are few by construction.
    Tasks count them, and ``LEARNED_WORDS`` at most reach the driver."""
    schema = StructType().add("stem", StringType()).add("toxic", LongType()).add("clean", LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for value, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {s for w in set((value or "").split()) for s in stems(w)}
                counts[bool(label)].update(found)
                counts[bool(label)][""] += 1  # texts
        every = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_pydict(
            {"stem": every, "toxic": [counts[1][s] for s in every], "clean": [counts[0][s] for s in every]},
            schema=to_arrow_schema(schema),
        )

    sums = taught.select("text", "label").mapInArrow(run, schema).groupBy("stem")
    sums = sums.agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    sums = materialize(sums.where((F.col("a") >= LEAST_TEXTS) | (F.col("stem") == "")), "tox-stems")
    texts_of = sums.where(F.col("stem") == "").first()
    if texts_of is None or not texts_of["a"] or not texts_of["b"]:
        return frozenset()
    toxic, clean = float(texts_of["a"]), float(texts_of["b"])
    n, a, b = F.col("a") + F.col("b"), F.col("a"), F.col("b")
    part = lambda x, total: F.when(x > 0, x * F.log(x / (n * total / (toxic + clean)))).otherwise(0.0)
    sums = sums.withColumn("g", 2 * (part(a, toxic) + part(b, clean)))
    telling = (F.col("stem") != "") & (a / toxic > LEAST_LIFT * (b + 0.5) / clean) & (F.col("g") >= LEAST_G)
    rows = sums.where(telling).orderBy(F.desc("g"), "stem").limit(LEARNED_WORDS).collect()
    return frozenset(r["stem"] for r in rows)


def with_features(docs: DataFrame, text: str, column: str, keep: list[str], learned: frozenset[str]) -> DataFrame:
    """``keep`` and the array of features of each whole text: one pass, no row moves."""
    schema = StructType().add(column, ArrayType(DoubleType()))
    return per_slice(docs, text, schema, lambda texts: {column: list(text_features(texts, learned))}, keep)


class ToxicityModel:
    """Trees and their calibration; or one constant score, where the labels are of one kind or none."""

    def __init__(self, trees: Transformer | None, steps: Transformer | None, constant: float = 0.0) -> None:
        self.trees, self.steps, self.constant = trees, steps, constant

    def score(self, rows: DataFrame, features: str, score: str) -> DataFrame:
        """``rows`` with their ``features`` replaced by ``score``, from 0 to 1."""
        if self.trees is None:
            return rows.withColumn(score, F.lit(self.constant)).drop(features)
        vector, raw = (fresh(rows, n) for n in ("vector", "raw"))
        margin, kind = (fresh(rows, n) for n in ("margin", "kind"))
        names = {"featuresCol": vector, "probabilityCol": raw, "rawPredictionCol": margin, "predictionCol": kind}
        model = self.trees.copy({self.trees.getParam(k): v for k, v in names.items()})
        made = model.transform(rows.withColumn(vector, array_to_vector(features)))
        made = made.withColumn(raw, vector_to_array(raw)[1]).drop(features, vector, margin, kind)
        steps = self.steps.copy({self.steps.featuresCol: raw, self.steps.predictionCol: score})
        made = steps.transform(made).drop(raw)
        return made.withColumn(score, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(score))))


def fit(labelled: DataFrame) -> ToxicityModel:
    """Learn from ``labelled(key, features, label, part)``, which has few rows by construction."""
    # A fixed order of few partitions: the trees come out the same however the input was laid.
    labelled = labelled.select("key", array_to_vector("features").alias("features"), F.col("label").cast("double"), "part")
    labelled = materialize(labelled.repartitionByRange(4, "key").sortWithinPartitions("key"), "tox-labelled")
    n, ones = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return ToxicityModel(None, None, float(bool(n and ones)))
    learn = labelled.where(F.col("part").between(LEXICON_PARTS, LEXICON_PARTS + TREE_PARTS - 1))
    hold = labelled.where(F.col("part") >= LEXICON_PARTS + TREE_PARTS)
    if learn.select("label").distinct().count() < 2 or hold.select("label").distinct().count() < 2:
        learn = hold = labelled
    trees = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.2, minInstancesPerNode=5, seed=1).fit(learn)
    held = trees.transform(hold).select(vector_to_array("probability")[1].alias("raw"), "label")
    return ToxicityModel(trees, IsotonicRegression(featuresCol="raw", labelCol="label").fit(held))


def _learn(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> tuple[ToxicityModel, frozenset[str]]:
    """The model and the lexicon it needs, from the drawn rows' texts, which are stored."""
    sample = F.broadcast(materialize(drawn(labels, key, label), "tox-sample"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    taught = materialize(texts.join(sample.withColumnRenamed(key, "key"), "key"), "tox-taught")
    learned = learn_lexicon(taught.where(F.col("part") < LEXICON_PARTS))
    return fit(with_features(taught, "text", "features", ["key", "label", "part"], learned)), learned


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", column: str = "score"
) -> DataFrame:
    """``docs`` with a ``column`` from 0 to 1 (underscores before it if ``docs`` has one so called); learned from ``labels(key, label)``, matched by key.

    Null and empty texts are scored by their zero features; repeated rows and null keys each get their own score,
    null keys teach nothing, and of repeated labels one counts. Without labels all scores are 0; with
    labels of one kind, that kind. No text is shuffled; the texts are read once to find the drawn rows' and once
    to be scored.
    """
    model, learned = _learn(docs, labels, text, key, label)
    features = fresh(docs, "features")
    rows = with_features(docs, text, features, docs.columns, learned)
    return model.score(rows, features, fresh(docs, column))


def without_toxic(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", reject: float = REJECT
) -> DataFrame:
    """The rows of ``docs`` with a score below ``reject``, with all their columns."""
    score = fresh(docs, "score")
    kept = score_documents(docs, labels, text, key, label).where(F.col(score) < reject)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
