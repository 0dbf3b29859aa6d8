"""Word-piece counts by a linear longest-match automaton.

A trie of the vocabulary gets a failure link for each node and, with it, the number of pieces
that are complete when the link is taken. One pass over a word then counts the pieces of its
greedy longest-match split without building any of them; no letter is read twice.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructType

from clickloom.llm.common import per_slice

# Words remembered by a task; the memory is emptied when it is full.
MEMORY = 500_000

COUNTS = StructType().add("n_words", LongType()).add("n_tokens", LongType()).add("n_unknown", LongType())


def piece_vocabulary(path: str, mark: str = "▁") -> tuple[set[str], set[str]]:
    """The pieces that begin a word, and those that go on with one, of a sentencepiece file.

    A piece that starts with ``mark`` begins a word; the lone mark, if it is a piece, is the empty
    text among them. Control and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, later = set(), set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if mark in piece[1:]:
            continue
        (first if piece.startswith(mark) else later).add(piece.removeprefix(mark))
    return first, later - {""}


class Automaton:
    """Counts the pieces of words; as large as the vocabulary, whatever the input.

    With the empty text in ``first`` (the lone mark) a word that no longer piece begins is that
    piece, counted, and pieces of ``later``.
    """

    FIRST, LATER = 0, 1

    def __init__(self, first: Iterable[str], later: Iterable[str]) -> None:
        first = set(first)
        self.next: list[dict[str, int]] = [{}, {}]
        ends = {self._add(self.FIRST, p) for p in first if p} | {self._add(self.LATER, p) for p in later if p}
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        if "" in first:
            self.fail[self.FIRST], self.popped[self.FIRST] = self.LATER, 1
        queue = deque([self.FIRST, self.LATER])
        while queue:
            parent = queue.popleft()
            for letter, node in self.next[parent].items():
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = self.LATER, 1
                    continue
                at, pieces = self.fail[parent], self.popped[parent]
                while at >= 0 and letter not in self.next[at]:
                    pieces += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.next[at][letter], pieces

    def _add(self, root: int, piece: str) -> int:
        node = root
        for letter in piece:
            if letter not in self.next[node]:
                self.next[node][letter] = len(self.next)
                self.next.append({})
            node = self.next[node][letter]
        return node

    def count(self, word: str) -> int:
        """Pieces of ``word``; 0 if some part of it is in no piece (the word is unknown)."""
        node, pieces = self.FIRST, 0
        follow, fail, popped = self.next, self.fail, self.popped
        for letter in word:
            while letter not in follow[node]:
                if fail[node] < 0:
                    return 0
                pieces += popped[node]
                node = fail[node]
            node = follow[node][letter]
        while node != self.LATER:
            if fail[node] < 0:
                return 0
            pieces += popped[node]
            node = fail[node]
        return pieces


def count_tokens(
    docs: DataFrame, first: set[str], later: set[str], text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (default: ``doc_id``) with ``n_words``, ``n_tokens`` and ``n_unknown`` of each
    whole text.

    Words are runs without white space. A word that the vocabulary cannot spell counts as one
    token and in ``n_unknown``. A null or empty text has no words and no tokens; repeated rows are
    counted each on their own. No row moves: it is one pass over the texts, and the automaton sent
    to the tasks is as large as the vocabulary.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Automaton(first, later))

    class Memory(dict):
        def __missing__(self, word):
            if len(self) >= MEMORY:
                self.clear()
            self[word] = found = vocabulary.value.count(word)
            return found

    memory: list[Memory] = []

    def work(texts: list[str]) -> dict:
        if not memory:
            memory.append(Memory())
        counts = [list(map(memory[0].__getitem__, t.split())) for t in texts]
        unknown = [c.count(0) for c in counts]
        return {
            "n_words": [len(c) for c in counts],
            "n_tokens": [sum(c) + u for c, u in zip(counts, unknown)],
            "n_unknown": unknown,
        }

    return per_slice(docs, text, COUNTS, work, keep or ["doc_id"])
