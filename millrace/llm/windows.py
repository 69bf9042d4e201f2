"""Minimizer spans: runs of consecutive SIZE-byte windows of a text that have the same minimizer.

A window's minimizer is the smallest hash of its SEED-byte strings. Equal windows have equal minimizers, so windows that are equal anywhere in the
corpus meet if spans are grouped by minimizer; a span of n windows is n + SIZE - 1 bytes. Seeds only say where spans are cut: their hash is fast and may
collide, which merges groups and changes no result. Contents are told apart by 128 bits of BLAKE2b with a salt drawn for each run.
"""

from __future__ import annotations

import hashlib

import numpy as np

from .common import prefix_sums, spans

SIZE, SEED = 100, 40
#: Spans have at most this many windows (texts of one repeated byte would have endless ones).
LONGEST = SIZE - SEED + 1


def _both(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    (x, s), (y, t) = a, b
    return np.minimum(x, y), (x == y) | s & (x < y) | t & (y < x)


def tied(seeds: np.ndarray, width: int) -> np.ndarray:
    """Whether the least of each run of width seeds stands there twice, by pieces that don't overlap."""
    piece = ((seeds >> np.uint64(32)).astype(np.uint32), np.zeros(len(seeds), bool))
    have, done, out = 1, 0, None
    n = len(seeds) - width + 1
    while True:
        if width & have:
            own = tuple(x[done : done + n] for x in piece)
            out, done = own if out is None else _both(out, own), done + have
        if done == width:
            return out[1]
        piece = _both(tuple(x[:-have] for x in piece), tuple(x[have:] for x in piece))
        have *= 2


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, salt: bytes) -> np.ndarray:
    """Two longs of each data[start:end]: BLAKE2b of the bytes, 128 bits."""
    view, blake = memoryview(data), hashlib.blake2b
    joined = b"".join([blake(view[a:b], digest_size=16, salt=salt).digest() for a, b in zip(start.tolist(), end.tolist())])
    return np.frombuffer(joined, "<i8").reshape(-1, 2)


def minimizer_spans(docs: list[bytes], salt: bytes, size: int = SIZE, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Of all spans, in order: minimizer, digest of the content (two longs), index of the text, first window's start in it, number of windows, whether
    two of its windows may be equal. (Two equal windows of a span are at most its length apart, so that a window between them holds their
    minimizer twice.)"""
    data = np.frombuffer(b"".join(docs), np.uint8)
    length = np.array([len(d) for d in docs])
    first = np.concatenate(([0], np.cumsum(length)))
    if len(data) < size:
        none = np.empty(0, np.int64)
        return none, none.reshape(-1, 2), none, none, none, none.astype(bool)
    sums = prefix_sums(data)
    at = np.arange(len(data) - seed + 1)
    least = spans(sums, at, at + seed)
    # sliding minimum over width seeds: halves double, then two overlap
    width, have = size - seed + 1, 1
    ties = np.concatenate(([0], np.cumsum(tied(least, width))))
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    # windows that lie in one text
    doc = np.repeat(np.arange(len(docs)), length)[: len(least)]
    inside = np.arange(len(least)) + size <= first[doc + 1]
    cut = np.concatenate(([True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])))
    start = np.flatnonzero(cut)
    run = np.diff(np.concatenate((start, [len(least)])))
    # long runs in pieces of width windows
    pieces = -(-run // width)
    if (pieces > 1).any():
        which = np.repeat(np.arange(len(start)), pieces)
        k = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = start[which] + run[which]
        start = start[which] + k * width
        run = np.minimum(width, end - start)
    # runs may reach beyond the last whole window of their text
    run = np.minimum(run, first[doc[start] + 1] - size + 1 - start)
    keep = inside[start] & (run > 0)
    start, run = start[keep], run[keep]
    return least[start].view(np.int64), digests(data, start, start + run + size - 1, salt), doc[start], start - first[doc[start]], run, ties[start + run] > ties[start]
