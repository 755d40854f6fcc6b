"""A K2-treap over a grid of terms (rows) and documents (columns), in numpy.

The square grid of side 2^h is quartered again and again.  A cell exists while points are left in it; it keeps
its point of greatest impact, and that point is taken out before the cell is quartered.  So every point is
stored once, impacts never grow downwards, and the impact of a cell bounds all that lies below.
Cells of a level stand in Morton order as one nibble each (which quarters exist), the place of the
point inside the cell, and the impact as the difference from the cell above; a child is found by counting the
quarters before it.  The levels are compressed with zstandard.
"""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import zstandard

#: Document ranges that are expanded at once.
BATCH = 512
_ROWS = 0xAAAAAAAAAAAAAAAA  # the row bits of a Morton code
_POPCOUNT = np.array([bin(i).count("1") for i in range(16)], np.int32)


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of ``x`` (32 at most) at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def gather(x: np.ndarray) -> np.ndarray:
    """The bits at the even places of ``x``: the inverse of :func:`spread`."""
    x = x.astype(np.uint64) & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                        (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x


def _place_type(level: int, h: int) -> np.dtype:
    bits = 2 * (h - level)
    return np.dtype("u1" if bits <= 8 else "u2" if bits <= 16 else "u4" if bits <= 32 else "u8")


def build(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, n_rows: int, n_cols: int) -> bytes:
    """The compressed treap of distinct points (row, col) with impacts from 1 to 2^31 - 1."""
    h = max(1, (n_rows - 1).bit_length(), (n_cols - 1).bit_length())
    codes = (spread(rows) << np.uint64(1)) | spread(cols)
    order = np.argsort(codes)
    codes, values = codes[order], impacts[order].astype(np.int64)
    parts: list[np.ndarray] = []
    above_key = above_value = None
    for level in range(h + 1):
        if not len(codes):
            break
        key = codes >> np.uint64(2 * (h - level))
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = len(codes)
        best = np.maximum.reduceat((values << 32) | np.arange(n - 1, -1, -1), starts)
        at = n - 1 - (best & 0xFFFFFFFF)
        own, value = key[starts], best >> 32
        if above_key is None:
            delta = -value
        else:
            parent = np.searchsorted(above_key, own >> np.uint64(2))
            masks = np.zeros(len(above_key), np.uint8)
            np.bitwise_or.at(masks, parent, np.left_shift(1, (own & np.uint64(3)).astype(np.uint8), dtype=np.uint8))
            parts.append(masks)
            delta = above_value[parent] - value
        place = codes[at] & np.uint64((1 << (2 * (h - level))) - 1)
        parts += [np.abs(delta).astype(np.uint32), place.astype(_place_type(level, h))]
        above_key, above_value = own, value
        left = np.ones(n, bool)
        left[at] = False
        codes, values = codes[left], values[left]
    if above_key is not None:
        parts.append(np.zeros(len(above_key), np.uint8))
    sizes = np.array([h, *(len(p) for p in parts[::3])], np.int64)
    body = b"".join(p.tobytes() for p in parts)
    return zstandard.ZstdCompressor(level=1).compress(len(sizes).to_bytes(4, "little") + sizes.tobytes() + body)


class Treap:
    """A decompressed treap: per level the quarters (masks), the first child, the impact and the place of each cell."""

    def __init__(self, packed: bytes):
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int.from_bytes(raw[:4], "little")
        sizes = np.frombuffer(raw, np.int64, n, 4)
        self.h, at = int(sizes[0]), 4 + 8 * n
        self.masks, self.first, self.impact, self.place = [], [], [], []
        parent = None
        for level, size in enumerate(sizes[1:].tolist()):
            delta = np.frombuffer(raw, np.uint32, size, at).astype(np.int32)
            at += 4 * size
            kind = _place_type(level, self.h)
            place = np.frombuffer(raw, kind, size, at)
            at += kind.itemsize * size
            mask = np.frombuffer(raw, np.uint8, size, at)
            at += size
            self.impact.append(delta if parent is None else self.impact[-1][parent] - delta)
            self.place.append(place)
            self.masks.append(mask)
            children = _POPCOUNT[mask]
            self.first.append(np.cumsum(children, dtype=np.int32) - children)
            parent = np.repeat(np.arange(size), children)

    def top(self, rows: np.ndarray, weights: np.ndarray, n_cols: int, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` columns of greatest sum of weight times impact over ``rows`` (equal sums: the smaller column
        first) among those whose sum is at least ``least`` (1 or more), as (sums, columns) in that order.

        Ranges of columns wait with an upper bound of their best sum: for each row the impact of the cell that the
        range has on that row's path, or of a point of the row that was met above and lies in the range.
        The ranges of greatest bound are halved first, until no bound reaches the k-th sum."""
        h, hc, nt = self.h, max(0, (n_cols - 1).bit_length()), len(rows)
        sums, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.impact or not nt:
            return sums, columns
        if int(weights.sum()) * int(self.impact[0][0]) >= 1 << 53:
            raise ValueError("the weights are too large for exact sums")
        weights = weights.astype(np.float64)  # sums of integers below 2^53 are exact
        met = np.zeros((nt, 2 << hc), np.int32)  # per row, over the halving tree of the columns: best point met
        term = np.arange(nt)
        row_code = spread(rows) << np.uint64(1)

        def judge(level: int, prefix: np.ndarray, cells: np.ndarray):
            """Bounds of ranges; notes the points met in their cells."""
            there = cells >= 0
            depth = max(0, level - (h - hc))
            if there.any():
                r, t = np.nonzero(there)
                c = cells[r, t]
                value = self.impact[level][c]
                place = self.place[level][c].astype(np.uint64)
                low = np.uint64((1 << (2 * (h - level))) - 1)
                hit = np.flatnonzero((place & np.uint64(_ROWS)) == (row_code[t] & low))
                if len(hit):
                    col = (prefix[r[hit]] << (h - level)) + gather(place[hit]).astype(np.int64)
                    for d in range(depth, hc + 1):
                        np.maximum.at(met, (t[hit], (1 << d) + (col >> (hc - d))), value[hit])
                bound = met[term, ((1 << depth) + prefix)[:, None]]
                bound[r, t] = np.maximum(bound[r, t], value)
            else:
                bound = met[term, ((1 << depth) + prefix)[:, None]]
            return (bound @ weights).astype(np.int64)

        heap: list = []
        number = count()  # no two entries are equal up to it, so that arrays are never compared

        def wait(level, prefix, cells, bounds):
            keep = np.flatnonzero(bounds >= least)
            if len(keep):
                order = keep[np.lexsort((prefix[keep], -bounds[keep]))]
                heapq.heappush(heap, (-int(bounds[order[0]]), -level, next(number), level, prefix[order], cells[order], bounds[order]))

        prefix, cells = np.zeros(1, np.int64), np.zeros((1, nt), np.int32)
        wait(0, prefix, cells, judge(0, prefix, cells))
        while heap and -heap[0][0] >= least:
            *_, level, prefix, cells, bounds = heapq.heappop(heap)
            if len(prefix) > BATCH:
                rest = slice(BATCH, None)
                wait(level, prefix[rest], cells[rest], bounds[rest])
                prefix, cells, bounds = prefix[:BATCH], cells[:BATCH], bounds[:BATCH]
            some = bounds >= least
            prefix, cells = prefix[some], cells[some]
            bit = h - level - 1
            halves = (0, 1) if bit < hc else (0,)
            q0 = ((rows >> bit & 1) * 2).astype(np.uint8)
            if level + 1 < len(self.impact):
                there = cells >= 0
                safe = np.where(there, cells, 0)
                mask, first = self.masks[level][safe], self.first[level][safe]
            new_prefix, new_cells = [], []
            for half in halves:
                p = prefix * 2 + half
                if level + 1 < len(self.impact):
                    own = np.left_shift(1, q0 + half, dtype=np.uint8)
                    c = np.where(there & (mask & own != 0), first + _POPCOUNT[mask & (own - 1)], -1)
                else:
                    c = np.full_like(cells, -1)
                inside = p << bit < n_cols
                new_prefix.append(p[inside]), new_cells.append(c[inside])
            prefix, cells = np.concatenate(new_prefix), np.concatenate(new_cells)
            bounds = judge(level + 1, prefix, cells)
            if bit:
                wait(level + 1, prefix, cells, bounds)
                continue
            good = bounds >= least
            sums, columns = np.concatenate((sums, bounds[good])), np.concatenate((columns, prefix[good]))
            order = np.lexsort((columns, -sums))[:k]
            sums, columns = sums[order], columns[order]
            if len(sums) == k:
                least = max(least, int(sums[-1]))
        return sums, columns
