"""Suffix sort by hash comparison.

Suffixes are compared by the length of their common beginning, which a binary
search finds from prefix polynomial hashes: a comparison costs the logarithm of
the length.  Runs are merged pairwise, all segments at once: each suffix looks
for its place in the other run by binary search.  Suffixes that the hashes call
equal are compared byte by byte at the end; a collision sorts by bytes instead.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def powers(base: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up = np.ones(max(size, 1), dtype=np.uint64)
    up[1:] = base
    down = np.ones(max(size, 1), dtype=np.uint64)
    down[1:] = inverse
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Suffixes:
    """Beginnings of ``length`` bytes at ``start`` in the rows of a byte matrix."""

    def __init__(self, rows: np.ndarray, row: np.ndarray, start: np.ndarray, length: int):
        self.rows, self.row, self.start, self.length = rows, row, start, length
        up, self.down = powers(BASE, rows.shape[1] + 1)
        self.prefix = np.zeros((len(rows), rows.shape[1] + 1), dtype=np.uint64)
        np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * up[:-1], axis=1, dtype=np.uint64, out=self.prefix[:, 1:])

    def sharing(self, segment: np.ndarray) -> np.ndarray:
        """Places of the suffixes whose hash another one of their segment has; no others can be equal."""
        end = self.start + self.length
        whole = (self.prefix[self.row, end] - self.prefix[self.row, self.start]) * self.down[self.start]
        order = np.lexsort((whole, segment))
        same = (segment[order][1:] == segment[order][:-1]) & (whole[order][1:] == whole[order][:-1])
        return np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes a and b, by binary search over prefix hashes."""
        flat, width = self.prefix.ravel(), self.prefix.shape[1]
        at_a, at_b = self.start[a], self.start[b]
        place_a, place_b = self.row[a] * width + at_a, self.row[b] * width + at_b
        from_a, from_b = flat[place_a], flat[place_b]
        scale_a, scale_b = self.down[at_a], self.down[at_b]

        def same(size) -> np.ndarray:
            return (flat[place_a + size] - from_a) * scale_a == (flat[place_b + size] - from_b) * scale_b

        out = np.where(same(self.length), self.length, 0)
        rest = np.flatnonzero(out == 0)
        place_a, place_b, from_a, from_b = place_a[rest], place_b[rest], from_a[rest], from_b[rest]
        scale_a, scale_b = scale_a[rest], scale_b[rest]
        low, step = np.zeros(len(rest), dtype=np.int64), 1 << (self.length - 1).bit_length()
        while step := step // 2:
            further = np.minimum(low + step, self.length - 1)
            low = np.where(same(further), further, low)
        out[rest] = low
        return out

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        shared = self.common(a, b)
        ended = shared == self.length
        last = np.minimum(shared, self.length - 1)
        left = self.rows[self.row[a], self.start[a] + last]
        right = self.rows[self.row[b], self.start[b] + last]
        return np.where(ended, or_equal, left < right)

    def sorted(self, segment: np.ndarray) -> np.ndarray:
        """Places of the suffixes ordered by (segment, suffix); ``segment`` numbers must be ascending."""
        order = np.arange(len(segment))
        if not len(order):
            return order
        first = np.searchsorted(segment, segment, "left")
        last = np.searchsorted(segment, segment, "right")
        inside, size = order - first, last - first
        width, most = 1, int(size.max())
        while width < most:
            moving = np.flatnonzero(size > width)
            run = inside[moving] // width
            begin = first[moving] + (run ^ 1) * width
            end = np.minimum(begin + width, last[moving])
            begin = np.minimum(begin, end)
            low, high = begin.copy(), end.copy()
            second = run % 2 == 1  # behind its equals of the first run
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                before = self.less(order[middle], order[moving[open_]], second[open_])
                low[open_[before]] = middle[before] + 1
                high[open_[~before]] = middle[~before]
            pair = first[moving] + (run // 2) * 2 * width
            place = pair + (inside[moving] - run * width) + (low - begin)
            merged = order.copy()
            merged[place] = order[moving]
            order = merged
            width *= 2
        return order

    def equal_runs(self, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, run): sorted places, and for each the number of its run of equal suffixes."""
        order = self.sorted(segment)
        if not len(order):
            return order, order
        a, b = order[:-1], order[1:]
        beside = np.flatnonzero(segment[a] == segment[b])
        equal = np.zeros(len(order), dtype=bool)
        equal[1:][beside] = self.common(a[beside], b[beside]) == self.length
        claimed = np.flatnonzero(equal)
        if (self._bytes(order[claimed - 1]) != self._bytes(order[claimed])).any():
            return self._by_bytes(segment)
        return order, np.cumsum(~equal) - 1

    def _bytes(self, which: np.ndarray) -> np.ndarray:
        columns = self.start[which][:, None] + np.arange(self.length)
        return self.rows[self.row[which][:, None], columns]

    def _by_bytes(self, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.ascontiguousarray(self._bytes(np.arange(len(segment))))
        _, word = np.unique(text.view(f"V{self.length}").ravel(), return_inverse=True)
        order = np.lexsort((word, segment))
        new = (segment[order][1:] != segment[order][:-1]) | (word[order][1:] != word[order][:-1])
        return order, np.concatenate([[0], np.cumsum(new)])
