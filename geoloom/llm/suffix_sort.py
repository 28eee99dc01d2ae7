"""Sorting suffixes by comparing hashes.

The common extension of two suffixes is found by binary search over its length, comparing
polynomial prefix hashes; the byte after it decides which comes first. With that comparison
suffixes are merge-sorted, all merges of a level at once: an element's place is its place in its
own run plus the number of smaller elements in the neighbouring run, found by binary search.
Hashes may lie, so the common extensions of neighbours in the final order are compared
byte by byte; where one differs, its group is sorted again by its bytes.
"""

from __future__ import annotations

import numpy as np

from .hashing import INVERSE, powers, prefix_hashes, span_hashes


class Suffixes:
    """Suffixes of `data`, each from a place in at[] for at most size[] bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.data = np.append(data, np.uint8(0))
        self.at, self.size = at.astype(np.int64), size.astype(np.int64)
        self.prefix = prefix_hashes(data)
        self.inverse = powers(INVERSE, len(self.prefix))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by hashes."""
        a, b = self.at[i], self.at[j]
        out = np.minimum(self.size[i], self.size[j])
        k = np.flatnonzero(~self._same(a, b, out))  # most are equal as a whole
        a, b, low, high = a[k], b[k], np.zeros(len(k), np.int64), out[k] - 1
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self._same(a, b, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        out[k] = low
        return out

    def _same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        return span_hashes(self.prefix, a, a + n, self.inverse) == span_hashes(self.prefix, b, b + n, self.inverse)

    def before(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before j; where they are equal, or_equal decides."""
        n = self.common(i, j)
        ended_i, ended_j = n >= self.size[i], n >= self.size[j]
        x, y = self.data[np.minimum(self.at[i] + n, len(self.data) - 1)], self.data[np.minimum(self.at[j] + n, len(self.data) - 1)]
        return np.where(ended_i & ended_j, or_equal, np.where(ended_i, True, np.where(ended_j, False, x < y)))

    def common_bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, byte by byte."""
        most = np.minimum(self.size[i], self.size[j])
        out, going, step = np.zeros(len(i), np.int64), np.flatnonzero(most > 0), 0
        while len(going):
            same = self.data[self.at[i[going]] + step] == self.data[self.at[j[going]] + step]
            going = going[same]
            step += 1
            out[going] = step
            going = going[most[going] > step]
        return out

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, lcp): suffixes by group, then by bytes; lcp[k] is shared with the one before, -1 at a group's start.

        group must be ascending.
        """
        n = len(group)
        order = np.arange(n)
        if not n:
            return order, np.zeros(0, np.int64)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.append(starts, n))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        run = 1
        while run < sizes.max():
            at = np.flatnonzero(size > run)  # groups that still have two runs or more
            rank = at - start[at]
            own = rank // run
            left = own % 2 == 0
            twin = start[at] + (own + np.where(left, 1, -1)) * run
            end = np.minimum(twin + run, start[at] + size[at])
            low, high = np.minimum(twin, end), end.copy()
            first = low.copy()
            while (open_ := low < high).any():
                k = np.flatnonzero(open_)
                middle = (low[k] + high[k]) // 2
                # elements of the left run go before equal ones of the right run
                less = self.before(order[middle], order[at[k]], ~left[k])
                low[k] = np.where(less, middle + 1, low[k])
                high[k] = np.where(less, high[k], middle)
            place = start[at] + (own - own % 2) * run + rank % run + (low - first)
            merged = order.copy()
            merged[place] = order[at]
            order = merged
            run *= 2
        inner = np.flatnonzero(np.r_[False, group[1:] == group[:-1]])
        lcp = np.full(n, -1, np.int64)
        lcp[inner] = self.common_bytes(order[inner - 1], order[inner])
        wrong = inner[lcp[inner] != self.common(order[inner - 1], order[inner])]
        for g in np.unique(group[wrong]):  # a hash lied
            k = np.flatnonzero(group == g)
            order[k] = sorted(order[k], key=lambda s: self.data[self.at[s] : self.at[s] + self.size[s]].tobytes())
            lcp[k[1:]] = self.common_bytes(order[k[:-1]], order[k[1:]])
        return order, lcp
