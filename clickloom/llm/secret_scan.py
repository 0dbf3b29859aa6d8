"""Secrets in texts: known patterns, and strings of high entropy.

Candidate strings are long runs of letters, digits and a few marks. A window slides over each run
of one character class inside a candidate; its Shannon entropy follows from counts that are
changed by one letter in and one letter out. Windows above the class's bound that no allow-list
rule explains are joined to spans of kind ``entropy``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from clickloom.llm.common import fresh, per_slice

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns. Only the letters A-Z and a-z count as letters.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more: shorter runs fail as a whole

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class CharClass:
    """Runs of ``run`` are looked at through windows of ``width`` letters, and a window with at
    least ``bits`` bits of entropy a letter is suspicious."""

    name: str
    run: str
    width: int
    bits: float


CLASSES = (
    CharClass("hex", r"[0-9A-Fa-f]{20,}", 20, 3.0),
    CharClass("alphanumeric", r"[0-9A-Za-z]{20,}", 20, 3.8),
    CharClass("base64", r"[0-9A-Za-z+/_=-]{24,}", 24, 4.0),
)

# A window that one of these finds is no secret: words without digits, digits alone, UUIDs, file
# names and paths of words, place-holders, and the example key of a public manual. Rules for whole strings begin
# with ^; of the others, each match explains the windows that overlap it. A place-holder word counts where
# a run of letters and digits begins or ends with it: further inside, it is there by chance.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[0-9=_/+-]*$",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?i)(?<![0-9a-z])(?:example|sample|placeholder)|(?:example|sample|placeholder)(?![0-9a-z])",
    r"(?i)xxxx|0123456789|abcdefgh",
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    r"^(?:[A-Za-z]+|[0-9]+)(?:[/_-](?:[A-Za-z]+|[0-9]+))+$",
)

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if "=" in text or ":" in text else []
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def window_entropies(run: str, width: int) -> Iterator[float]:
    """Bits a letter of each window of ``width`` letters, by counts kept from the last one."""
    weigh = [0.0] + [n * math.log2(n) for n in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, letter in enumerate(run):
        n = counts.get(letter, 0)
        counts[letter] = n + 1
        total += weigh[n + 1] - weigh[n]
        if i >= width:
            out = run[i - width]
            n = counts[out]
            counts[out] = n - 1
            total += weigh[n - 1] - weigh[n]
        if i >= width - 1:
            yield math.log2(width) - total / width


def explained(candidate: str, rules: list[str]) -> list[int]:
    """How many letters before each place are in a match of ``rules``."""
    marks = bytearray(len(candidate))
    for rule in rules:
        for m in re.finditer(rule, candidate):
            marks[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    return list(accumulate(marks, initial=0))


def entropy_spans(text: str, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> list[Span]:
    """Unions of suspicious windows, by start; of windows that overlap an explained part, none."""
    found: list[tuple[int, int]] = []
    whole, inner = [r for r in allowed if r.startswith("^")], [r for r in allowed if not r.startswith("^")]
    for candidate in CANDIDATE.finditer(text):
        if any(re.search(rule, candidate[0]) for rule in whole):
            continue
        known = explained(candidate[0], inner)
        for kind in classes:
            for run in re.finditer(kind.run, candidate[0]):
                at = candidate.start() + run.start()
                for i, bits in enumerate(window_entropies(run[0], kind.width)):
                    window = run[0][i : i + kind.width]
                    start = run.start() + i
                    if bits < kind.bits or known[start + kind.width] > known[start]:
                        continue
                    if not any(re.search(rule, window) for rule in whole):
                        found.append((at + i, at + i + kind.width))
    spans: list[Span] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][2]:
            spans[-1] = (spans[-1][0], 3, max(end, spans[-1][2]))
        else:
            spans.append((start, 3, end))
    return spans


SPANS = StructType().add(
    "spans",
    ArrayType(StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType())),
)


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: ``doc_id``) with ``spans``: the secrets of each whole text, as
    ``kind, start, end`` in code points (end exclusive), by start, then kind in the order of ``KINDS``.

    A null or empty text has no spans; repeated rows are scanned each on their own; spans of
    different kinds may overlap. No row moves, and a task holds a few texts at a time.
    """

    def work(texts: list[str]) -> dict:
        found = [sorted(base_spans(t) + entropy_spans(t)) for t in texts]
        return {"spans": [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in one] for one in found]}

    return per_slice(docs, text, SPANS, work, keep or ["doc_id"])


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars", cover: str = "[secret]") -> DataFrame:
    """``docs`` with every span of each text replaced by ``cover`` (overlapping spans by one), and
    ``size``, if there is such a column, set to the new length. A null text stays null; a text without
    spans stays as it is. Columns and their order stay."""
    new = fresh(docs, "covered")

    def covered(value: str) -> str:
        parts, at = [], 0
        for start, _, end in sorted(base_spans(value) + entropy_spans(value)):
            if start >= at:
                parts += [value[at:start], cover]
            at = max(at, end)
        return "".join(parts) + value[at:] if parts else value

    schema = StructType().add(new, StringType())
    made = per_slice(docs, text, schema, lambda texts: {new: list(map(covered, texts))}, docs.columns)
    changed = F.col(text).isNotNull() & (F.col(new) != F.col(text))
    columns = {text: F.when(changed, F.col(new)).otherwise(F.col(text)).alias(text)}
    if size in docs.columns:
        kind = docs.schema[size].dataType
        columns[size] = F.when(changed, F.length(new).cast(kind)).otherwise(F.col(size)).alias(size)
    return made.select(*[columns.get(c, F.col(f"`{c}`")) for c in docs.columns])
