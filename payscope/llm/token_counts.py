"""Greedy word-piece token counts by a linear longest-match automaton.

A word is split into the longest vocabulary piece at its start, then the
longest at the rest, and so on.  The automaton is a trie of the vocabulary
with failure links: where the next byte has no edge, the pieces that greedy
matching would emit from the text read so far are popped and the automaton
moves to the state of what is left.  Only their *number* is stored per state, so
a word is counted in time linear in its length without building pieces.

A word starts with the marker byte (a space): pieces that begin with it are
word starts, all others continue a word.  Words are what lies between
Unicode blanks.  A word that cannot be split is one unknown token.

One Arrow pass without a shuffle.  The vocabulary is read once per Python
process; counts of words are kept in a bounded table that is emptied when full.

Defined results: null and empty texts have no words and no tokens.  Words and
texts of any length are read whole.  Repeated rows are counted alike.  Only the
id and text columns are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.tokens import load_ranks

MARKER = b" "
MAX_WORDS = 300_000


class LongestMatch:
    """States are numbers, 0 the root; ``goto`` maps state * 256 + byte."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        self.goto: dict[int, int] = {}
        ends = [False]
        for piece in pieces:
            state = 0
            for byte in piece:
                after = self.goto.get(state * 256 + byte)
                if after is None:
                    after = self.goto[state * 256 + byte] = len(ends)
                    ends.append(False)
                state = after
            if state:
                ends[state] = True
        self.fail = [-1] * len(ends)
        self.popped = [0] * len(ends)
        self._link(ends)

    def _link(self, ends: list[bool]) -> None:
        edges: list[list[tuple[int, int]]] = [[] for _ in ends]
        for key, after in self.goto.items():
            edges[key // 256].append((key % 256, after))
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for byte, after in edges[state]:
                queue.append(after)
                if ends[after]:  # a piece: pop it, begin anew
                    self.fail[after], self.popped[after] = 0, 1
                    continue
                back, n = self.fail[state], self.popped[state]
                while back >= 0 and back * 256 + byte not in self.goto:
                    n += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[after], self.popped[after] = self.goto[back * 256 + byte], n

    def count(self, word: bytes) -> int:
        """Pieces of ``word`` (marker included), or -1 if it cannot be split."""
        goto, fail, popped = self.goto, self.fail, self.popped
        state = n = 0
        for byte in word:
            after = goto.get(state * 256 + byte)
            while after is None:
                if fail[state] < 0:
                    return -1
                n += popped[state]
                state = fail[state]
                after = goto.get(state * 256 + byte)
            state = after
        while state:
            if fail[state] < 0:
                return -1
            n += popped[state]
            state = fail[state]
        return n


@lru_cache(maxsize=2)
def automaton(vocabulary: str) -> LongestMatch:
    return LongestMatch(load_ranks(vocabulary))


def count_text(text: str, automaton: LongestMatch, known: dict[str, int], max_words: int = MAX_WORDS) -> tuple[int, int, int]:
    """(words, tokens, unknown words) of one text; ``known`` has counts by word."""
    words = text.split()
    if len(known) > max_words:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = automaton.count(MARKER + w.encode("utf-8", "surrogatepass"))
    counts = list(map(known.__getitem__, words))
    unknown = counts.count(-1)
    return len(words), sum(counts) + 2 * unknown, unknown


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_tokens, n_unknown."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = counter(vocabulary)(F.col("text"))
    return narrow.select("doc_id", counts.alias("c")).select("doc_id", "c.*")


def counter(vocabulary: str):
    """Column function: struct(n_words, n_tokens, n_unknown) of a text column."""

    @F.pandas_udf("n_words long, n_tokens long, n_unknown long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for texts in batches:
            yield pd.DataFrame([count_text(t or "", automaton(vocabulary), known) for t in texts],
                               columns=["n_words", "n_tokens", "n_unknown"], dtype="int64")

    return counts
