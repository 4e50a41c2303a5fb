"""Exact nearest codebook entries by slices and bitmasks.

The entries of a codebook are sorted along each dimension, and for each place in that order a mask has a
bit for every entry before it. The entries whose coordinate lies in a range are then the difference of two
masks, and those in a box around a point the intersection over the dimensions: one AND a dimension for 64
entries. A box of some radius has every entry within that distance, so the nearest entry in it is the nearest
of all if it is no farther than the radius. Points that a first, small radius does not settle are searched
again, with the distance found or twice the radius.
"""

from __future__ import annotations

import math

import numpy as np

#: Entries in one word of masks.
WORD = 64
#: Integers up to this size, in parts of up to 16 dimensions, have squared distances in 64 bits.
EXACT = 1 << 28
#: Dimensions for which that holds.
EXACT_WIDTH = 16


class SliceIndex:
    """Entries (integers, one row each) of one codebook, with their prefix masks by dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.count, self.width = entries.shape
        self.words = -(-self.count // WORD)
        self.sorted: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        for d in range(self.width):
            order = np.argsort(entries[:, d], kind="stable")
            bits = np.zeros((self.count, self.words), dtype=np.uint64)
            bits[np.arange(self.count), order // WORD] = np.uint64(1) << (order % WORD).astype(np.uint64)
            masks = np.zeros((self.count + 1, self.words), dtype=np.uint64)
            np.bitwise_or.accumulate(bits, axis=0, out=masks[1:])
            self.sorted.append(entries[order, d])
            self.before.append(masks)
        self.radius = self._first_radius()

    def _first_radius(self) -> int:
        """Half the median distance from an entry to another one: most points have an entry that near."""
        if self.count < 2:
            return 1
        gaps = self.entries[:, None, :].astype(np.float64) - self.entries[None, :, :]
        squares = (gaps**2).sum(axis=2)
        np.fill_diagonal(squares, np.inf)
        return max(1, int(math.sqrt(float(np.median(squares.min(axis=1))))) // 2)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries in the boxes around points."""
        found = None
        for d in range(self.width):
            low = np.searchsorted(self.sorted[d], points[:, d] - radius, side="left")
            past = np.searchsorted(self.sorted[d], points[:, d] + radius, side="right")
            # what lies before ``low`` also lies before ``past``
            slices = self.before[d][past] ^ self.before[d][low]
            found = slices if found is None else found & slices
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, the lowest of equals, and the squared distance.

        ``points`` and entries are at most ``EXACT`` in size, and of at most ``EXACT_WIDTH`` dimensions.
        """
        best = np.zeros(len(points), dtype=np.int64)
        error = np.full(len(points), np.iinfo(np.int64).max)
        if not self.width:
            return best, np.zeros(len(points), dtype=np.int64)
        open_ = np.arange(len(points))
        radius = np.full(len(points), self.radius, dtype=np.int64)
        while len(open_):
            self._search(points, open_, self.candidates(points[open_], radius[open_]), best, error)
            far = error[open_] > radius[open_] ** 2
            open_ = open_[far]
            # an entry was found, so its distance is enough; or none was
            seen = error[open_] < np.iinfo(np.int64).max
            reach = np.ceil(np.sqrt(error[open_].astype(np.float64))).astype(np.int64) + 1
            # no two coordinates are farther apart than twice EXACT
            radius[open_] = np.where(seen, reach, np.minimum(radius[open_] * 2, 1 << 31))
        return best, error

    def _search(self, points, open_, masks, best, error) -> None:
        """Compares points with their candidates, in the order of entries."""
        for word in range(self.words):
            left, rows = masks[:, word], open_
            some = left != 0
            left, rows = left[some], rows[some]
            while len(rows):
                lowest = left & (~left + np.uint64(1))
                # powers of two are exact in floats
                entry = np.frexp(lowest.astype(np.float64))[1].astype(np.int64) - 1 + word * WORD
                gaps = points[rows] - self.entries[entry]
                squares = (gaps * gaps).sum(axis=1)
                # a point may be searched twice, so an equal distance of a lower entry counts
                nearer = (squares < error[rows]) | ((squares == error[rows]) & (entry < best[rows]))
                best[rows[nearer]], error[rows[nearer]] = entry[nearer], squares[nearer]
                left = left ^ lowest
                some = left != 0
                left, rows = left[some], rows[some]


def nearest_of_large(points: list[list[int]], entries: list[list[int]]) -> tuple[list[int], list[int]]:
    """The same for integers of any size, by comparing with every entry."""
    best, error = [], []
    for point in points:
        squares = [sum((a - b) ** 2 for a, b in zip(point, entry, strict=True)) for entry in entries]
        error.append(min(squares))
        best.append(squares.index(error[-1]))
    return best, error
