"""A run-length index over short, repetitive strings, and their matching statistics.

The Burrows-Wheeler transform of all strings is cut into runs, and the suffix array is sampled at both
ends of each run. Rows that are neighbours within a run have the same character before them, so the match
of their suffixes is that of the suffixes one character earlier, less one. Only at the ends of runs must
suffixes be compared. The matching statistics of all places, that is, how long the longest match that
begins there and also elsewhere is, are then streamed along the text: known at the samples, one less from
place to place in between. Repetitive strings have few runs.
"""

from __future__ import annotations

import numpy as np

#: Symbols: the end of the text, the end of a string, and bytes from there on.
END, BREAK, FIRST_BYTE = 0, 1, 2
SYMBOLS = 258
#: So many symbols of nine bits fit in a first sort key.
PACKED = 7

_BASE = np.uint64(0x9E3779B97F4A7C15)


def joined(strings: list[bytes]) -> np.ndarray:
    """The strings as one text of symbols."""
    text = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + FIRST_BYTE
    sizes = np.array([len(s) for s in strings])
    text = np.insert(text, np.cumsum(sizes), BREAK)
    return np.append(text, END)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; in each round only those that are not yet apart are sorted."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(PACKED, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for k in range(PACKED):
        key = key << 9 | padded[k : k + n]
    order = key.argsort()
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    is_first = np.diff(key[order], prepend=-1) != 0
    first = np.flatnonzero(is_first)
    rank[order] = first[np.cumsum(is_first) - 1]  # the place of the first of equals
    size = PACKED
    while len(first) < n:
        counts = np.diff(np.append(first, n))
        tied = np.repeat(counts > 1, counts)
        places = np.flatnonzero(tied)
        if not len(places):
            break
        at = order[places]
        follow = rank[np.minimum(at + size, n)]
        by = (rank[at] * (n + 2) + follow + 1).argsort()
        at, follow = at[by], follow[by]
        order[places] = at
        own = rank[at]
        heads = (np.diff(own, prepend=-1) != 0) | (np.diff(follow, prepend=-2) != 0)
        new = places[heads][np.cumsum(heads) - 1]
        rank[at] = new
        is_first[places[heads]] = True
        first = np.flatnonzero(is_first)
        size *= 2
    return order


class RunIndex:
    """Runs of the transform of a text, with what the suffix array has at their ends."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = suffix_order(text)
        column = text[order - 1]
        starts = np.flatnonzero(np.diff(column, prepend=-1))
        ends = np.append(starts[1:], n) - 1
        # suffixes at the start of each run and above it, at the end of each run and below it
        self.first, self.above = order[starts[1:]], order[starts[1:] - 1]
        self.last, self.below = order[ends[:-1]], order[ends[:-1] + 1]
        self.runs, self.text = len(starts), text
        self.top, self.bottom = int(order[0]), int(order[-1])
        self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, dtype=np.uint64))])
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(text.astype(np.uint64) * self.powers[:n])])

    def matching_statistics(self, most: int) -> np.ndarray:
        """By place: the length of the longest match with any other place, counted up to ``most``."""
        up = self._streamed(self.first, self.above, self.top, most)
        return np.maximum(up, self._streamed(self.last, self.below, self.bottom, most))

    def _streamed(self, places, others, without: int, most: int) -> np.ndarray:
        n = len(self.text)
        known = np.full(n, -1, dtype=np.int64)
        known[places] = self._common(places, others)
        known[without] = 0
        sample = np.maximum.accumulate(np.where(known >= 0, np.arange(n), 0))
        return np.clip(known[sample] - (np.arange(n) - sample), 0, most)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the text has in common at a and b."""
        high = len(self.text) - np.maximum(a, b)
        low, size = np.zeros_like(high), 64
        # most differ soon: the bound is doubled as long as all up to it is equal
        bound = np.minimum(size, high)
        while len(open_ := np.flatnonzero(self._equal(a, b, bound) & (bound < high))):
            low[open_] = bound[open_]
            bound[open_] = np.minimum(bound[open_] * 4, high[open_])
        high = bound
        while len(open_ := np.flatnonzero(low < high)):
            half = (low[open_] + high[open_] + 1) // 2
            same = self._equal(a[open_], b[open_], half)
            low[open_] = np.where(same, half, low[open_])
            high[open_] = np.where(same, high[open_], half - 1)
        return low

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the text has the same ``size`` symbols at a and at b."""
        low, high = np.minimum(a, b), np.maximum(a, b)
        left = (self.sums[low + size] - self.sums[low]) * self.powers[high - low]
        return left == self.sums[high + size] - self.sums[high]


def repeated_windows(strings: list[bytes], wanted: np.ndarray, size: int) -> list[np.ndarray]:
    """By wanted string: begins of its windows of ``size`` bytes that are elsewhere in the strings, too."""
    lengths = RunIndex(joined(strings)).matching_statistics(size) if strings else np.zeros(0)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    return [
        np.flatnonzero(lengths[begins[i] : begins[i] + max(0, sizes[i] - size + 1)] >= size)
        for i in np.flatnonzero(wanted)
    ]
