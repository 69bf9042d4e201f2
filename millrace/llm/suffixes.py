"""Burrows-Wheeler transform and common prefixes of many short documents, built column by column.

Each round inserts one symbol of every document, from its end to its beginning. The transform and the common prefixes of all suffixes so far lie
in two files that each round reads from front to back and writes anew; in memory are the columns of one round only, as large as the block
that the caller chooses. Symbols are numbers from 1; 0 stands for a document's beginning.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

from .common import mix

WIDE = 64
#: Bytes of a symbol, for windows of a multiple of it. Windows at every start are met by as many shifted documents of each text.
SYMBOL = 20


class RangeMinimum:
    """Minima of ranges of a row of small numbers: within blocks by prefix and suffix minima, over blocks by doubling."""

    def __init__(self, x: np.ndarray) -> None:
        n = -(-len(x) // WIDE) * WIDE
        self.x = np.concatenate((x, np.full(n - len(x), 255, np.uint8)))
        blocks = self.x.reshape(-1, WIDE)
        self.prefix = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        self.suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [blocks.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= len(self.levels[0]):
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of x[start:end]; ranges are not empty."""
        last = end - 1
        a, b = start // WIDE, last // WIDE
        out = np.minimum(self.suffix[start], self.prefix[last])
        far = np.flatnonzero(b - a > 1)
        if len(far):
            lo, hi = a[far] + 1, b[far]
            level = np.frexp((hi - lo).astype(float))[1] - 1
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                row = self.levels[k]
                out[far[at]] = np.minimum(out[far[at]], np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))]))
        near = np.flatnonzero(a == b)
        if len(near):
            s, e = start[near], end[near]
            order = np.argsort(s, kind="stable")
            pairs = np.empty(2 * len(near), np.int64)
            pairs[0::2], pairs[1::2] = s[order], np.minimum(e[order], len(self.x) - 1)
            least = np.minimum.reduceat(self.x, pairs)[0::2]
            ends = e[order] == len(self.x)
            least[ends] = np.minimum(least[ends], self.x[-1])
            out[near[order]] = least
        return out


def _in_order(bwt: np.ndarray) -> tuple[np.ndarray, int]:
    """Places by symbol, equal ones as they lie (16 bits at a time); and how many of them hold a beginning."""
    order = np.argsort(bwt.astype(np.uint16), kind="stable").astype(np.int32)
    high = (bwt >> np.uint32(16)).astype(np.uint16)
    if high.any():
        order = order[np.argsort(high[order], kind="stable")]
    return order, len(bwt) - np.count_nonzero(bwt)


def build(flat: np.ndarray, sizes: np.ndarray, cap: int = 255) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes in order (the empty ones first): transform, common prefix with the suffix before (up to cap), document, length.

    flat: symbols of all documents in turn; sizes: how many each has."""
    m, flat = len(sizes), flat.astype(np.uint32)
    last = np.cumsum(sizes) - 1
    place = np.arange(m, dtype=np.int32)  # of each document's newest suffix
    rounds = int(sizes.max(initial=0))
    with tempfile.TemporaryDirectory() as home:
        bwt_file, lcp_file = os.path.join(home, "bwt"), os.path.join(home, "lcp")
        np.zeros(m, np.uint32).tofile(bwt_file)
        np.zeros(m, np.uint8).tofile(lcp_file)
        for j in range(rounds):
            live = np.flatnonzero(sizes > j)
            bwt, lcp = np.fromfile(bwt_file, np.uint32), np.fromfile(lcp_file, np.uint8)
            bwt[place[live]] = flat[last[live] - j]
            order, begins = _in_order(bwt)
            order = order[begins:]
            rank = np.empty(len(bwt), np.int32)
            rank[order] = np.arange(m, m + len(order), dtype=np.int32)
            new = rank[place[live]]
            total = len(bwt) + len(live)
            old = np.ones(total, bool)
            old[new] = False
            next_bwt, next_lcp = np.zeros(total, np.uint32), np.zeros(total, np.uint8)
            next_bwt[old], next_lcp[old] = bwt, lcp
            # of new suffixes and of those right after them: one more than the least between the places of the two without their first symbols
            touched = ~old
            touched[1:] |= ~old[:-1]
            touched[: m + 1] = False
            at = np.flatnonzero(touched)
            p, q = order[at - m], order[at - m - 1]
            same = np.flatnonzero(bwt[p] == bwt[q])
            value = np.zeros(len(at), np.uint8)
            if len(same):
                value[same] = np.minimum(RangeMinimum(lcp).of(q[same] + 1, p[same] + 1), cap - 1) + 1
            next_lcp[at] = value
            next_lcp[m : m + 1] = 0
            place[live] = new
            next_bwt.tofile(bwt_file)
            next_lcp.tofile(lcp_file)
        bwt, lcp = np.fromfile(bwt_file, np.uint32), np.fromfile(lcp_file, np.uint8)
    order, begins = _in_order(bwt)
    rank = np.zeros(len(bwt), np.int32)
    rank[order[begins:]] = np.arange(m, len(bwt), dtype=np.int32)
    doc, length = np.empty(len(bwt), np.int32), np.empty(len(bwt), np.int32)
    at = np.arange(m, dtype=np.int32)
    doc[:m], length[:m] = at, 0
    for j in range(rounds):
        live = np.flatnonzero(sizes > j)
        at[live] = rank[at[live]]
        doc[at[live]], length[at[live]] = live, j + 1
    return bwt, lcp, doc, length


def symbol_codes(data: np.ndarray, symbol: int) -> np.ndarray:
    """A number from 1 for the string of `symbol` bytes at each place: equal strings, equal numbers, and no others. Strings are sorted by a hash, and each is then
    compared with the first of its hash; if any differs, they are sorted by their bytes."""
    n = len(data) - symbol + 1
    padded = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(8, np.uint8))), 8)
    h, parts = np.zeros(n, np.uint64), []
    for k in range(0, symbol, 8):
        part = np.ascontiguousarray(padded[k : k + n]).view("<u8").reshape(-1)
        if symbol - k < 8:
            part = part & np.uint64((1 << 8 * (symbol - k)) - 1)
        parts.append(part)
        h = mix(h ^ part)
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    if any((part != part[first][code]).any() for part in parts):
        order = np.lexsort(parts)
        fresh = np.concatenate(([True], np.any([part[order][1:] != part[order][:-1] for part in parts], axis=0)))
        code = np.empty(n, np.int64)
        code[order] = np.cumsum(fresh) - 1
    return code.astype(np.uint32) + np.uint32(1)


def repeated_windows(contents: list[bytes], keys: np.ndarray, size: int, symbol: int = SYMBOL) -> tuple[np.ndarray, np.ndarray]:
    """(index, start) of each window of `size` bytes, a multiple of symbol, that also starts at a smaller key: keys are the places of the contents' first bytes."""
    none = np.empty(0, np.int64)
    length = np.array([len(c) for c in contents], np.int64)
    data = np.frombuffer(b"".join(contents), np.uint8)
    if len(data) < size:
        return none, none
    code = symbol_codes(data, symbol)
    # one document for each content and shift
    owner, shift = np.repeat(np.arange(len(contents)), symbol), np.tile(np.arange(symbol), len(contents))
    sizes = np.maximum(length[owner] - shift, 0) // symbol
    keep = sizes * symbol >= size
    owner, shift, sizes = owner[keep], shift[keep], sizes[keep]
    if not len(owner):
        return none, none
    first = (np.cumsum(length) - length)[owner] + shift
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    _, lcp, doc, have = build(code[np.repeat(first, sizes) + step * symbol], sizes, size // symbol)
    full = np.flatnonzero(have * symbol >= size)
    # a group goes on where the common prefix is a whole window; suffixes between two of a group have it as well
    group = np.cumsum(lcp < size // symbol)[full]
    index = owner[doc[full]]
    start = (sizes[doc[full]] - have[full]) * symbol + shift[doc[full]]
    key = keys[index] + start
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    least = np.repeat(np.minimum.reduceat(key, edge), np.diff(np.concatenate((edge, [len(group)]))))
    late = key > least
    return index[late], start[late]
