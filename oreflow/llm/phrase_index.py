"""A bidirectional FM-index over one shard's words, as deep as phrases are long.

Words are whole numbers from 1 on; 0 stands between pieces and is part of no phrase. Suffixes are sorted
by their first ``depth`` words only: up to that depth, the suffixes that begin with a phrase are one
interval, and counting the words before an interval's start places the intervals of longer phrases, as with
whole suffixes. One index is over the text and one over the reversed text. A phrase has an interval in both;
extending it on either side splits its interval in one index by the neighbouring words and
moves along in the other by the number of occurrences of smaller neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the next ``depth`` words (1, 2 or 4), by doubling."""
    rank, length = text, 1
    while length < depth:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:]
        keys = rank * (int(after.max(initial=0)) + 1) + after
        length *= 2
        if length >= depth:
            return np.argsort(keys, kind="stable")
        rank = np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1
    return np.argsort(rank, kind="stable")


@dataclass(frozen=True)
class Phrases:
    """Phrases as rows of words, their intervals' starts in both indexes, and their number of occurrences."""

    words: np.ndarray
    low: np.ndarray
    low_reversed: np.ndarray
    count: np.ndarray

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], self.low[keep], self.low_reversed[keep], self.count[keep])


class PhraseIndex:
    """``text`` holds words below ``size`` and ends with 0."""

    def __init__(self, text: np.ndarray, size: int, depth: int):
        self.n, self.size = len(text), size
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        forward, backward = _order(text, depth), _order(text[::-1].copy(), depth)
        # The word before each sorted suffix, and the word after each sorted reversed prefix.
        self.before = text[forward - 1]
        self.after = text[::-1][backward - 1]
        self._sorted: dict[bool, np.ndarray] = {}

    def words(self) -> Phrases:
        """Every word that occurs."""
        count = np.diff(self.starts)
        found = np.flatnonzero(count[1:]) + 1
        return Phrases(found[:, None], self.starts[found], self.starts[found], count[found])

    def _rank(self, left: bool, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each word stands before its place in the column of neighbours."""
        if left not in self._sorted:
            column = self.before if left else self.after
            self._sorted[left] = np.sort(column * self.n + np.arange(self.n))
        return np.searchsorted(self._sorted[left], word * self.n + place) - self.starts[word]

    def extend(self, phrases: Phrases, left: bool) -> Phrases:
        """All phrases with one more word on the left or on the right."""
        column = self.before if left else self.after
        own, other = (phrases.low, phrases.low_reversed) if left else (phrases.low_reversed, phrases.low)
        parent = np.repeat(np.arange(len(own)), phrases.count)
        inside = np.arange(len(parent)) - np.repeat(np.cumsum(phrases.count) - phrases.count, phrases.count)
        pairs, count = np.unique(parent * self.size + column[np.repeat(own, phrases.count) + inside], return_counts=True)
        parent, word = pairs // self.size, pairs % self.size
        # Occurrences of smaller neighbours of the same phrase.
        smaller = np.cumsum(count) - count
        smaller -= smaller[np.searchsorted(parent, parent, "left")]
        keep = word > 0
        parent, word, count, smaller = parent[keep], word[keep], count[keep], smaller[keep]
        moved = self.starts[word] + self._rank(left, word, own[parent])
        along = other[parent] + smaller
        words = np.column_stack([word, phrases.words[parent]] if left else [phrases.words[parent], word])
        return Phrases(words, moved if left else along, along if left else moved, count)
