"""A bidirectional FM-index over a text of word ids, and phrases by interval extension.

The text and its reverse each have a suffix array and a Burrows-Wheeler transform. A phrase is a pair of intervals, its
rows in either index; both have the size of its count. A backward step in the one index lengthens the phrase to the
left, in the other to the right, and the other interval follows by counting smaller symbols. All phrases of a level are
lengthened in one go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """The row of every suffix in sorted order. Symbol 0 ends a piece; ends differ by place and come before all words, so
    comparing two suffixes stops at the end of a piece. The text's last symbol is an end."""
    n, ends = len(text), np.flatnonzero(text == 0)
    symbol = text.astype(np.int64) + (len(ends) - 1)
    symbol[ends] = np.arange(len(ends))
    key = symbol * (int(symbol.max(initial=0)) + 1)
    key[:-1] += symbol[1:]
    key[ends] = symbol[ends] - n  # an end is told apart by itself
    order = np.argsort(key)
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    del key
    rank = np.empty(n, dtype=np.int32)
    rank[order] = start  # the first row of all suffixes alike so far
    del start
    alone = first & np.concatenate([first[1:], [True]])
    todo, depth = order[~alone], 2
    while len(todo):  # suffixes alike in `depth` symbols have no end in them: there is a symbol at that distance
        group, key = rank[todo], rank[todo + depth]
        order = np.lexsort((key, group))
        todo, group, key = todo[order], group[order], key[order]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        first = new_group | np.concatenate([[True], key[1:] != key[:-1]])
        places = np.arange(len(todo))
        at_group = np.maximum.accumulate(np.where(new_group, places, 0))
        at_first = np.maximum.accumulate(np.where(first, places, 0))
        rank[todo] = group + at_first - at_group
        alone = first & np.concatenate([first[1:], [True]])
        todo, depth = todo[~alone], 2 * depth
    return rank


class _Side:
    """Burrows-Wheeler transform of a text and its mapping from a row to that of the suffix one symbol longer."""

    def __init__(self, text: np.ndarray):
        rank = suffix_ranks(text)
        before = np.concatenate([[len(text) - 1], np.arange(len(text) - 1)])
        self.bwt = np.empty(len(text), dtype=np.int32)
        self.longer = np.empty(len(text), dtype=np.int32)
        self.bwt[rank], self.longer[rank] = text[before], rank[before]


@dataclass
class Phrases:
    """Phrases of one length: first rows in the index of the text and of its reverse, counts, and the words' ids."""

    rows: np.ndarray
    back_rows: np.ndarray
    counts: np.ndarray
    words: np.ndarray  # phrases x length


class BidirectionalIndex:
    """Over `text`, words 1, 2, ... in pieces that end in 0; the last symbol is 0."""

    def __init__(self, text: np.ndarray):
        self.symbols = int(text.max(initial=0)) + 1
        self.counts = np.bincount(text, minlength=self.symbols)
        self.text, self.back = _Side(text), _Side(np.concatenate([text[-2::-1], [0]]))

    def single(self) -> Phrases:
        """All words of the text."""
        words = np.flatnonzero(self.counts[1:]) + 1
        starts = np.cumsum(self.counts) - self.counts
        return Phrases(starts[words], starts[words], self.counts[words], words[:, None])

    def right(self, phrases: Phrases) -> Phrases:
        """All phrases that are one of these and a word after it, in the order of the words' ids."""
        which, symbol, back, rows, counts = self._step(self.back, phrases.back_rows, phrases.rows, phrases.counts)
        return Phrases(rows, back, counts, np.column_stack([phrases.words[which], symbol]))

    def left(self, phrases: Phrases) -> Phrases:
        """All phrases that are a word and one of these after it."""
        which, symbol, rows, back, counts = self._step(self.text, phrases.rows, phrases.back_rows, phrases.counts)
        return Phrases(rows, back, counts, np.column_stack([symbol, phrases.words[which]]))

    def _step(self, side: _Side, lows: np.ndarray, other_lows: np.ndarray, counts: np.ndarray):
        offsets = np.cumsum(counts) - counts
        rows = np.repeat((lows - offsets).astype(np.int32), counts) + np.arange(int(counts.sum()), dtype=np.int32)
        key = np.repeat(np.arange(len(counts)) * self.symbols, counts) + side.bwt[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
        size = np.diff(np.concatenate([first, [len(key)]]))
        which, symbol = np.divmod(key[first], self.symbols)
        lows, other = side.longer[rows[order[first]]], other_lows[which] + first - offsets[which]
        inside = symbol > 0  # ends of pieces lengthen nothing
        return which[inside], symbol[inside], lows[inside], other[inside], size[inside]
