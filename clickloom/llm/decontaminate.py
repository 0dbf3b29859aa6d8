"""Benchmark decontamination by templates. DataFrame functions only.

Numbers, units after numbers and names become typed place-holders, a run of one type a single one, so a question
asked again with other values has the same template. Windows of words are hash-joined with those of the benchmark
three ways: as they are, with place-holders, and with words that may be names for opening a sentence as names too;
along an alignment of a document with an item, a name or unit of the item must have turned into one value, and
windows with another one do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import fresh

# Words in a window, and the fewest of them that are no place-holders. Windows with fewer are found as they
# are, values and all.
WINDOW = 8
LITERALS = 4
# Share of an item's windows that a document must have.
SHARE = 0.5
# Benchmark windows joined at once: some 250 bytes each, so below 64 MB in memory.
BLOCK = 250_000

MARK = "\u0001"  # begins a place-holder; then its type and its value

# Letters of scripts that put no blanks between words (Thai to Myanmar, Khmer, kana, ideographs): each is a word.
UNSPACED = r"[\u0E00-\x{3FFFF}&&[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]]"

UNITS = (
    "mm cm m km inch inches ft feet foot yd yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters "
    "litre litres s sec secs second seconds min mins minute minutes h hour hours day days week weeks month months "
    "year years percent usd eur gbp dollar dollars euro euros pound pounds cent cents kb mb gb tb hz khz mhz ghz "
    "w kw mw v kv a c f k mph kmh"
).split()


def marked_words(text: Column) -> Column:
    """The words of a text in lower case without punctuation; a number, unit or name is ``MARK``,
    its type (n, u, p) and its value, and a capitalised word that may be a name is of type s.

    A word with a digit is a number; one of ``UNITS`` after a number is a unit; a capitalised word
    after a lower-case word, a number or a comma is a name, and one elsewhere (where a sentence, a line
    or a quotation begins) may be one. A letter of a script without blanks is a word.
    """
    text = F.regexp_replace(F.coalesce(text, F.lit("")), UNSPACED, " $0 ")
    names = F.regexp_replace(text, r" (?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{Nd},;] )(\p{Lu}\p{Ll}+)", f" {MARK}p$1")
    begun = rf"(?<!\S)([^\p{{L}}\p{{N}}\s{MARK}]*+)(?=\p{{Lu}}\p{{Ll}})"
    names = F.regexp_replace(names, begun, f"{MARK}s$1")
    joined = F.regexp_replace(names, r"(\d)[.,:/](?=\d)", "$1")
    numbers = F.regexp_replace(joined, r"[^\s\d]*+\d\S*", f"{MARK}n$0")
    units = F.regexp_replace(numbers, rf"({MARK}n\S*\s+)(?:{MARK}s)?(?=(?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))", f"$1{MARK}u")
    marked = F.when(names.rlike(r"\d"), units).otherwise(names)
    # A mark inside a word (a name inside a number) is dropped with the rest of the punctuation.
    plain = F.regexp_replace(F.lower(marked), rf"(?:[^\p{{L}}\p{{N}}\s{MARK}]|(?<=\S){MARK}[nups])+", "")
    return F.array_remove(F.split(plain, r"\s+"), "")


def template_words(text: Column) -> Column:
    """``marked_words`` with numbers, units and certain names only."""
    return F.transform(marked_words(text), lambda w: F.when(w.startswith(f"{MARK}s"), _plain(w)).otherwise(w))


def _plain(word: Column) -> Column:
    return F.when(word.startswith(MARK), word.substr(F.lit(3), F.length(word))).otherwise(word)


# The forms of a text, by number: as it is, with certain names, with all that may be names.
PLAIN, STRICT, LOOSE = range(3)


def _heads(loose: bool) -> Column:
    """Places of ``words`` that begin a word of the form: all but those that go on a place-holder of their type."""

    def begins(i: Column) -> Column:
        word, last = F.get("words", i), F.get("words", i - 1)
        kind, before = F.substring(word, 1, 2), F.substring(last, 1, 2)
        goes_on = kind == before
        if loose:
            goes_on = goes_on | ((kind == f"{MARK}p") & (before == f"{MARK}s"))
        return F.when(~word.startswith(MARK) | word.startswith(f"{MARK}s") | last.isNull(), True).otherwise(~goes_on)

    return F.filter(_places(), begins)


def _places() -> Column:
    return F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>"))


def _coded(df: DataFrame) -> DataFrame:
    """``df(words)`` with the places where words of the two template forms begin, and the hashes of the words in
    the three forms (of a place-holder its type)."""

    def code(loose: bool):
        def of(i: Column) -> Column:
            word = F.get("words", i)
            if loose:
                word = F.when(word.startswith(f"{MARK}s"), f"{MARK}p").otherwise(word)
            typed = word.startswith(MARK) & ~word.startswith(f"{MARK}s")
            return F.when(typed, F.xxhash64(F.substring(word, 1, 2))).otherwise(F.get("plain", i))

        return of

    plain = F.transform("words", lambda w: F.xxhash64(_plain(w)))
    df = df.select("*", _heads(False).alias("strict_at"), _heads(True).alias("loose_at"), plain.alias("plain"))
    strict, loose = F.transform("strict_at", code(False)), F.transform("loose_at", code(True))
    return df.select("*", strict.alias("strict"), loose.alias("loose"))


def _token(words: str, start: Column, stop: Column) -> Column:
    """The word or the whole place-holder at the places ``start`` to ``stop`` (exclusive) of ``words``."""
    rest = F.transform(F.slice(words, start + 2, stop - start - 1), lambda w: F.concat(F.lit(" "), _plain(w)))
    return F.concat(F.get(words, start), F.array_join(rest, ""))


def _typed(token: Column, form: Column) -> Column:
    """Whether the token makes a window of the form another one than that of the form before."""
    may_be = token.startswith(f"{MARK}s")
    return F.when(form == STRICT, token.startswith(MARK) & ~may_be).when(form == LOOSE, may_be).otherwise(True)


def benchmark_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item_id, size, span, strong, n_windows, n_strong, item_pos, hash, tokens)``, a row for each distinct form
    of each window of an item: it begins at the word ``item_pos``, has ``size`` words of its form and spans ``span``
    words of the text; ``tokens`` are ``(place, token)``.

    An item with fewer than ``window`` words is one window of its own size, however short. In a form where a window
    has fewer than ``LITERALS`` words besides place-holders it says too little and is left out; as it is, with its
    values, every window has a row. ``strong`` places begin a window that has enough words where certain names alone
    are place-holders. Items without words have no rows.
    """
    words = _coded(items.select(F.col(item).alias("item_id"), marked_words(F.col(text)).alias("words")))
    form = lambda n, at, codes: F.struct(F.lit(n).alias("form"), at.alias("at"), F.col(codes).alias("codes"))
    forms = F.array(form(PLAIN, _places(), "plain"), form(STRICT, F.col("strict_at"), "strict"), form(LOOSE, F.col("loose_at"), "loose"))
    rows = words.where(F.size("words") > 0).select("item_id", "words", F.explode(forms).alias("f")).select("item_id", "words", "f.*")
    rows = rows.withColumn("size", F.least(F.lit(window), F.size("at")))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("at") - F.col("size"))))
    after = lambda k: F.coalesce(F.get("at", k), F.size("words"))
    made = lambda k: F.struct(F.get("at", k).alias("place"), _token("words", F.get("at", k), after(k + 1)).alias("token"))
    start = F.get("at", F.col("i"))
    rows = rows.select(
        "item_id", "form", "size", start.alias("item_pos"), (after(F.col("i") + F.col("size")) - start).alias("span"),
        F.xxhash64(F.slice("codes", F.col("i") + 1, F.col("size"))).alias("hash"),
        F.transform(F.sequence(F.col("i"), F.col("i") + F.col("size") - 1), made).alias("tokens"),
    )
    literal = lambda t: ~t["token"].startswith(MARK) | ((F.col("form") == STRICT) & t["token"].startswith(f"{MARK}s"))
    rows = rows.where((F.col("form") == PLAIN) | (F.size(F.filter("tokens", literal)) >= LITERALS))
    place, whole = Window.partitionBy("item_id", "item_pos"), Window.partitionBy("item_id")
    places = lambda kind: F.size(F.collect_set(F.when(kind, F.col("item_pos"))).over(whole)).cast("long")
    rows = rows.withColumn("strong", F.max(F.col("form") == STRICT).over(place))
    rows = rows.withColumn("n_windows", places(F.col("form") == PLAIN)).withColumn("n_strong", places(F.col("strong")))
    return rows.where(F.exists("tokens", lambda t: _typed(t["token"], F.col("form")))).drop("form")


def _pairs(tokens: Column, doc: Column) -> Column:
    """``(place in the item, item value, document value, certain)`` of what is a place-holder in the item's
    window or may be one."""

    def slot(t: Column, i: Column) -> Column:
        may_be = t["token"].startswith(f"{MARK}s")
        kind = F.when(may_be, f"{MARK}p").otherwise(F.substring(t["token"], 1, 2))
        value = lambda w: F.concat(kind, _plain(w))
        made = F.struct(t["place"].alias("place"), value(t["token"]).alias("item"), value(F.get(doc, i)).alias("doc"), (~may_be).alias("certain"))
        return F.when(t["token"].startswith(MARK), made)

    return F.filter(F.transform(tokens, slot), lambda s: s.isNotNull())


def _settled(lines: DataFrame) -> DataFrame:
    """``lines(at, span, slots)`` without the windows that hold a minority value of a name or unit.

    Numbers may be equal by chance, so each place of one is a slot of its own. A name or unit that has turned into
    several values keeps the one at most places, its own if that is among those; where several others
    are equally frequent it is no slot at all, and the alignment is a chance match.
    """
    bound = F.filter("slots", lambda s: ~s["item"].startswith(f"{MARK}n"))
    pairs = F.array_distinct(F.transform("bound", lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"))))
    clash = F.size("pairs") > F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    lines = lines.withColumn("bound", bound).withColumn("pairs", pairs).withColumn("clash", clash)
    weight = lambda p: F.size(F.filter("bound", lambda s: (s["item"] == p["item"]) & (s["doc"] == p["doc"])))
    own = lambda p: (p["item"] == p["doc"]).cast("int")
    ranked = F.transform("pairs", lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc"), (2 * weight(p) + own(p)).alias("rank")))
    lines = lines.withColumn("ranked", F.when(F.col("clash"), ranked))
    rival = lambda p, q: (p["item"] == q["item"]) & (p["doc"] != q["doc"])
    beaten = F.filter("ranked", lambda p: F.exists("ranked", lambda q: rival(p, q) & (q["rank"] > p["rank"])))
    lines = lines.withColumn("beaten", F.transform(beaten, lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc"))))
    tied = F.exists("ranked", lambda p: F.exists(
        "ranked", lambda q: rival(p, q) & (q["rank"] == p["rank"])
    ) & ~F.array_contains("beaten", F.struct(p["item"].alias("item"), p["doc"].alias("doc"))))
    lines = lines.where(~F.col("clash") | ~tied)
    lost = F.filter("slots", lambda s: F.array_contains("beaten", F.struct(s["item"].alias("item"), s["doc"].alias("doc"))))
    lines = lines.withColumn("lost", F.transform(lost, lambda s: s["place"]))
    inside = lambda place, i: (place >= i) & (place < i + F.col("span"))
    at = F.filter("at", lambda i: ~F.exists("lost", lambda place: inside(place, i)))
    lines = lines.withColumn("at", F.when(F.col("clash"), at).otherwise(F.col("at")))
    slots = F.filter("slots", lambda s: F.exists("at", lambda i: inside(s["place"], i)))
    return lines.withColumn("slots", F.when(F.col("clash"), slots).otherwise(F.col("slots"))).where(F.size("at") > 0)


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, item_id, n_windows, n_strong, strong, item_pos, span, shift, slots)``: every window that a document and
    an item have in common, with its place-holder values.

    The documents are read once for windows of all sizes. The benchmark is the stated query set: its windows are
    joined in blocks of at most ``BLOCK`` on average, each broadcast, so the documents are never shuffled, however
    large the benchmark is; each further block reads them again.
    """
    wanted = benchmark_windows(items, window=window)
    shape = wanted.groupBy("size").agg(F.count("*").alias("n")).collect()  # at most ``window`` rows
    sizes, blocks = sorted(r["size"] for r in shape), max(1, -(-sum(r["n"] for r in shape) // BLOCK))
    made = _coded(docs.select(F.col(key).alias("doc_id"), marked_words(F.col(text)).alias("words")))
    kept = ("doc_id", "words", "strict_at", "loose_at")
    # The outer form: for the other one Spark adds a filter on the array's size below, and makes
    # every expression of the array anew. Places beyond the end of a form have shorter windows, which are right too.
    seen = made.select(*kept, "plain", "strict", "loose", F.posexplode_outer("plain").alias("at", "code"))
    hashes = [F.xxhash64(F.slice(form, F.col("at") + 1, size)) for size in sizes for form in ("plain", "strict", "loose")]
    hashes = F.array(*hashes) if hashes else F.array().cast("array<bigint>")
    seen = seen.select(*kept, "at", F.posexplode_outer(hashes).alias("form", "hash"))
    parts = []
    for block in range(blocks):
        some = wanted
        if blocks > 1:
            some = some.where(F.pmod(F.xxhash64("item_id", "item_pos"), F.lit(blocks)) == block)
        parts.append(_hits(seen.join(F.broadcast(some), "hash").withColumn("form", F.col("form") % 3)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _hits(hit: DataFrame) -> DataFrame:
    """The joined windows with their values, those left out that an earlier form has as well."""
    # Without functions of arrays' elements, so that the windows are cut where they are joined and no row
    # carries its whole text on.
    plain = F.col("form") == PLAIN
    heads = F.when(F.col("form") == STRICT, F.col("strict_at")).otherwise(F.col("loose_at"))
    end = F.col("at") + F.col("size")
    hit = hit.withColumn("first", F.when(plain, F.col("at")).otherwise(F.get(heads, F.col("at"))))
    hit = hit.withColumn("stop", F.when(plain, end).otherwise(F.coalesce(F.get(heads, end), F.size("words"))))
    hit = hit.withColumn("cut", F.slice("words", F.col("first") + 1, F.col("stop") - F.col("first")))
    certain = F.array_join("cut", " ").rlike(f"{MARK}[nup]")
    may_be = F.array_join("cut", " ").contains(f"{MARK}s")
    hit = hit.where(plain | ((F.col("form") == STRICT) & certain) | ((F.col("form") == LOOSE) & may_be))
    starts = F.slice(heads, F.col("at") + 1, F.col("size"))
    counts = ("n_windows", "n_strong", "strong")
    hit = hit.select("doc_id", "item_id", *counts, "item_pos", "span", "form", "first", "stop", "cut", starts.alias("starts"), "tokens")
    after = lambda k: F.coalesce(F.get("starts", k + 1), F.col("stop")) - F.col("first")
    of_form = F.transform("starts", lambda p, k: _token("cut", p - F.col("first"), after(k)))
    own = F.when(plain, F.col("cut")).otherwise(of_form)
    shift = (F.col("first") - F.col("item_pos")).alias("shift")
    hit = hit.select("doc_id", "item_id", *counts, "item_pos", "span", shift, "tokens", own.alias("own"))
    return hit.select("doc_id", "item_id", *counts, "item_pos", "span", "shift", _pairs(F.col("tokens"), F.col("own")).alias("slots"))


def find_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, share: float = SHARE
) -> DataFrame:
    """``(doc_id, item_id, matched, share, slots, changed)``: the items that a document asks again,
    with the same values or with others.

    Where a name or unit turns into several values along an alignment (a shift of positions), the windows
    that hold another one than the most frequent do not count; if none is most frequent nor the item's own, the
    alignment is a chance match and dropped. Equal numbers may turn into different ones. ``matched`` counts the
    item's windows, ``share`` is their part of all its windows or of the strong ones, whichever is more, ``slots``
    the place-holder values of the item in them (of words that may be names, those that changed), and ``changed``
    those that the document has another value for. Null and empty texts leak nothing and items without words are in no
    result; an item of a word or two is found wherever a document has these. Very long texts are read whole, in one
    task each; repeated rows of one id count as one document, and so do null ids. A name asked again with more
    or fewer words moves what follows, so consistency is judged piece by piece. A group has no more rows than an item
    has windows, times their repetitions in one document.
    """
    found = matches(docs, items, key, text, window)
    lines = found.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set("item_pos").alias("at"),
        F.collect_set(F.when(F.col("strong"), F.col("item_pos"))).alias("strong"),
        F.max("n_windows").alias("n_windows"),
        F.max("n_strong").alias("n_strong"),
        F.max("span").alias("span"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    lines = _settled(lines)
    told = F.filter("slots", lambda s: s["certain"] | (s["item"] != s["doc"]))
    pairs = F.transform(told, lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc")))
    lines = lines.withColumn("slots", F.array_distinct(pairs))
    both = lines.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("matched"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.array_intersect("at", "strong"))))).alias("matched_strong"),
        F.max("n_windows").alias("n_windows"),
        F.max("n_strong").alias("n_strong"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    changed = F.size(F.filter("slots", lambda s: s["item"] != s["doc"]))
    of_strong = F.when(F.col("n_strong") > 0, F.col("matched_strong") / F.col("n_strong")).otherwise(0.0)
    both = both.withColumn("share", F.greatest(F.col("matched") / F.col("n_windows"), of_strong)).where(F.col("share") >= share)
    return both.select("doc_id", "item_id", "matched", "share", F.size("slots").alias("slots"), changed.alias("changed"))


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id leaks no item; a null id is kept unless rows of null id leak."""
    leaking = fresh(docs, "leaking")
    leaks = find_leaks(docs, items, key, text).select(F.col("doc_id").alias(leaking)).distinct()
    return docs.join(leaks, F.col(key).eqNullSafe(F.col(leaking)), "left_anti")
