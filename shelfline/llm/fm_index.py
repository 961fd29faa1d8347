"""Bidirectional FM-index over a delimited list of words, searched for many words at a time.

The text is ``|word|word|...|word|`` and a node of the search is an interval of equal size in the sorted suffixes of the
text and of the reversed text, which stand for the same occurrences; extending a match by a symbol on either side
narrows both. Words are searched by the scheme of the pigeonhole principle: one half is matched exactly, the other with
one error, symbol by symbol across the half.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

END, BAR, LETTER = 0, 1, 2  # symbols: the end of the text, the delimiter, the first letter


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the sorted suffixes, by doubling the length that is sorted."""
    rank, width = text.astype(np.int64), 1
    while True:
        after = np.zeros(len(text), np.int64)
        after[: max(0, len(text) - width)] = rank[width:] + 1
        key = rank * (rank.max() + 2) + after
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
        if rank[order[-1]] == len(text) - 1:
            return order
        width *= 2


def occurrences(text: np.ndarray, suffixes: np.ndarray, symbols: int) -> np.ndarray:
    """How often each symbol stands before one of the first ``i`` sorted suffixes, for all ``i``."""
    before = text[suffixes - 1]
    table = np.zeros((len(text) + 1, symbols), np.int32)
    table[np.arange(1, len(text) + 1), before] = 1
    return np.cumsum(table, axis=0, dtype=np.int32, out=table)


@dataclass
class Nodes:
    """Matches in progress: the query of each, its two intervals' starts and their size."""

    query: np.ndarray
    lo: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def at(self, where: np.ndarray) -> Nodes:
        return Nodes(self.query[where], self.lo[where], self.back[where], self.size[where])

    @staticmethod
    def joined(parts: Sequence[Nodes]) -> Nodes:
        return Nodes(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("query", "lo", "back", "size")))


class BidirectionalIndex:
    def __init__(self, words: Sequence[np.ndarray] | None = None, symbols: int = 0) -> None:
        """``words`` as arrays of symbols from ``LETTER`` up to below ``symbols``."""
        if words is None:
            return
        body = np.full(sum(map(len, words)) + len(words) + 1, BAR, np.int64)
        stops = np.cumsum([len(w) + 1 for w in words])
        for word, stop in zip(words, stops):
            body[stop - len(word) : stop] = word
        self.starts = np.r_[0, stops[:-1]] + 1
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.body = body
        bars = np.cumsum(body == BAR) - 1
        self.first = np.r_[0, np.cumsum(np.bincount(np.r_[body, END], minlength=symbols))[:-1]]
        tables = []
        for text, number in ((body, bars), (body[::-1], bars[::-1] - 1)):
            text = np.r_[text, END]
            suffixes = suffix_array(text)
            # The word behind the delimiter at the start of a suffix of the text, and before it in the reversed text.
            word_at = np.r_[number, -1][suffixes]
            tables.append((occurrences(text, suffixes, symbols), word_at))
        (self.forth, self.word), (self.backward, self.word_back) = tables

    def reversed(self) -> BidirectionalIndex:
        """The same index with left and right exchanged."""
        other = BidirectionalIndex()
        other.__dict__ = {**self.__dict__, "forth": self.backward, "backward": self.forth, "word": self.word_back, "word_back": self.word}
        return other

    def everywhere(self, queries: int) -> Nodes:
        zero = np.zeros(queries, np.int64)
        return Nodes(np.arange(queries), zero, zero, zero + len(self.forth) - 1)

    def left(self, nodes: Nodes, symbol: np.ndarray | int) -> Nodes:
        """The nodes extended to the left by a symbol each; empty ones are left out."""
        top = self.forth[nodes.lo]
        counts = self.forth[nodes.lo + nodes.size] - top
        row = np.arange(len(nodes.lo))
        symbol = np.broadcast_to(symbol, row.shape)
        size = counts[row, symbol]
        smaller = np.cumsum(counts, axis=1)[row, symbol] - size
        made = Nodes(nodes.query, self.first[symbol] + top[row, symbol], nodes.back + smaller, size)
        return made.at(size > 0)

    def right(self, nodes: Nodes, symbol: np.ndarray | int) -> Nodes:
        flipped = self.reversed().left(Nodes(nodes.query, nodes.back, nodes.lo, nodes.size), symbol)
        return Nodes(flipped.query, flipped.back, flipped.lo, flipped.size)

    def all_right(self, nodes: Nodes) -> tuple[Nodes, np.ndarray]:
        """The nodes extended to the right by every letter that occurs there, and those letters."""
        top = self.backward[nodes.back]
        counts = self.backward[nodes.back + nodes.size] - top
        smaller = np.cumsum(counts, axis=1) - counts
        row, letter = np.nonzero(counts[:, LETTER:])
        letter += LETTER
        return Nodes(nodes.query[row], nodes.lo[row] + smaller[row, letter], self.first[letter] + top[row, letter], counts[row, letter]), letter

    def half_exact(self, queries: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words that begin with the first ``half`` symbols of a query, a row of ``queries``, and
        differ from it by one inserted, deleted or replaced symbol behind them.

        Each pair comes once: what is inserted differs from the symbol after it, what is deleted from the one after it.
        """
        length = queries.shape[1]
        exact = self.everywhere(len(queries))
        for j in range(half - 1, -1, -1):
            exact = self.left(exact, queries[exact.query, j])
        exact = self.left(exact, BAR)
        wrong: Nodes | None = None
        for at in range(half, length + 1):
            wanted = queries[:, at] if at < length else np.full(len(queries), BAR)
            other, letter = self.all_right(exact)
            other = other.at(letter != wanted[other.query])
            found = self.right(other if wrong is None else Nodes.joined([wrong, other]), wanted[(other.query if wrong is None else np.r_[wrong.query, other.query])])
            if at == length:
                return found.query, self.word_back[found.back]
            after = queries[:, at + 1] if at + 1 < length else np.full(len(queries), BAR)
            wrong = Nodes.joined([found, other, exact.at(wanted[exact.query] != after[exact.query])])
            exact = self.right(exact, wanted[exact.query])
        raise AssertionError("the loop returns at the end of the words")

    def begins_alike(self, words: np.ndarray, queries: np.ndarray, half: int) -> np.ndarray:
        """Do the words begin with the first ``half`` symbols of the queries beside them?"""
        alike = self.lengths[words] >= half
        for j in range(half):
            alike[alike] = self.body[self.starts[words[alike]] + j] == queries[alike, j]
        return alike
