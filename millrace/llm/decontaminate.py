"""Benchmark decontamination: rare words of test items join passages to them, Smith-Waterman alignment scores them.

Seeds are each item's rarest words by the number of texts that hold them, counted over the whole corpus: one more than the threshold lets go
unmatched, so every alignment at the threshold matches one of them (prefix filter), whatever is replaced, inserted or left out and however
often a copy stands in the corpus. Passages around seeds are aligned with the item, word by word (match 2, other word -1, gap -1); similarity
is the share of the item's words matched in the best local alignment. An alignment spans less than three times the item's words, so passages
reach that far from a seed, and those that meet are one.

Benchmarks are taken in blocks of at most BLOCK_ITEMS items and BLOCK_WORDS words (a longer item comes alone), each against all texts. Words
are compared by a 64-bit hash of the whole word. An alignment keeps a few rows as long as a passage in memory, whatever the item's length.

Null and empty texts and items match nothing; rows that repeat a text or an item give results of their own; extra columns are not read; a null
doc_id or item_id stays null. Words are runs of digits, letters and other non-ASCII characters, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, settle, slices, table, texts, words

THRESHOLD, BLOCK_ITEMS, BLOCK_WORDS = 0.8, 5_000, 250_000
MATCH, OTHER, GAP = 2, -1, -1
#: Words aligned at once, at least; longer passages are taken in pieces that share as many words as an alignment can span.
PIECE = 4_096


def folded(docs: list[bytes]) -> list[bytes]:
    return [d if d.isascii() else d.decode().lower().encode() for d in docs]


class Items:
    """A block of test items: their words as places in the block's vocabulary, how many each needs matched, and the items of each seed."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float) -> None:
        self.ids = [r[0] for r in rows]
        word, doc = words(folded([(r[1] or "").encode() for r in rows]), "alnum")
        self.vocabulary, self.flat = np.unique(word, return_inverse=True)
        self.edge = np.searchsorted(doc, np.arange(len(rows) + 1))
        self.need = np.array([max(1, ceil(threshold * n - 1e-9)) for n in np.diff(self.edge)], np.int64)
        self.of_seed: list[np.ndarray] = []

    def words(self, i: int) -> np.ndarray:
        return self.flat[self.edge[i] : self.edge[i + 1]]

    def keep_rarest(self, counts: np.ndarray) -> None:
        """Without its seeds fewer than `need` words of an item are left. A word counts as often as it stands in the item."""
        items: list[list[int]] = [[] for _ in self.vocabulary]
        for i, need in enumerate(self.need.tolist()):
            own = self.words(i)
            order = own[np.lexsort((self.vocabulary[own], counts[own]))]
            for w in set(order[: len(own) - need + 1].tolist()):
                items[w].append(i)
        self.of_seed = [np.array(x, np.int64) for x in items]

    def lookup(self) -> tuple[np.ndarray, np.ndarray]:
        bits = np.zeros(1 << 20, bool)
        bits[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        return self.vocabulary, bits


def known(word: np.ndarray, vocabulary: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that the vocabulary holds, and where it holds them. A bit table rules out most of the others."""
    at = np.flatnonzero(bits[(word >> np.uint64(44)).astype(np.int64)])
    k = np.minimum(np.searchsorted(vocabulary, word[at]), len(vocabulary) - 1)
    same = vocabulary[k] == word[at]
    return at[same], k[same]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: matched words of the best local alignment, and the passage's words [start, end) it takes. Ties: the first end, then substitution before gaps.

    Each cell carries its alignment's start and matches along, so that two rows are all that is kept."""
    n = len(passage)
    at = np.arange(n + 1)
    step = at * GAP
    score, start, hits = np.zeros(n + 1, np.int64), at, np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for x in item:
        same = passage == x
        diagonal, above = score[:-1] + np.where(same, MATCH, OTHER), score[1:] + GAP
        row = np.zeros(n + 1, np.int64)
        row[1:] = np.maximum(np.maximum(diagonal, above), 0)
        row = np.maximum.accumulate(row - step) + step  # gaps along the passage
        body = row[1:]
        one, two = (body == diagonal) & (body > 0), (body == above) & (body > 0)
        new_start, new_hits = at.copy(), np.zeros(n + 1, np.int64)
        new_start[1:] = np.where(one, start[:-1], np.where(two, start[1:], at[1:]))
        new_hits[1:] = np.where(one, hits[:-1] + same, np.where(two, hits[1:], 0))
        own = np.concatenate(([True], one | two | (body == 0)))  # the others go on from the cell before
        source = np.maximum.accumulate(np.where(own, at, 0))
        score, start, hits = row, new_start[source], new_hits[source]
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(hits[j]), int(start[j]), j)
    return best[1:]


def found(item: np.ndarray, passage: np.ndarray, need: int) -> Iterator[tuple[int, int, int]]:
    """Best local alignments that match so many words: that of the passage, then those of what is left before and after it."""
    parts = [(0, len(passage))]
    while parts:
        a, e = parts.pop()
        if np.isin(item, passage[a:e]).sum() < need:  # no alignment can match more
            continue
        matched, s, t = align(item, passage[a:e])
        if matched >= need:
            yield matched, a + s, a + t
        parts += [(a, a + s), (a + t, e)]


def seed_counts(df: DataFrame, items: Items) -> np.ndarray:
    """Texts that hold each word of the block's vocabulary: at most BLOCK_WORDS rows (or one item's words) reach the driver."""
    schema = pa.schema([("k", pa.int64()), ("n", pa.int64())])
    shared = df.sparkSession.sparkContext.broadcast(items.lookup())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, bits = shared.value
        total = np.zeros(len(vocabulary), np.int64)
        for _, docs in slices(batches):
            word, doc = words(folded(docs), "alnum")
            at, k = known(word, vocabulary, bits)
            total += np.bincount(np.unique(doc[at] * len(total) + k) % len(total), minlength=len(total))
        held = np.flatnonzero(total)
        yield table(schema, k=held, n=total[held])

    counts = np.zeros(len(items.vocabulary), np.int64)
    for r in df.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    shared.destroy()
    return counts


def in_text(places: np.ndarray, word: np.ndarray, n: int, items: Items) -> Iterator[tuple[int, float, int, int]]:
    """(item, similarity, first word, last word) of a text of n words, of which `word` are known and stand at `places`."""
    held = np.unique(word)
    near = [items.of_seed[w] for w in held.tolist() if len(items.of_seed[w])]
    if not near:
        return
    near = np.unique(np.concatenate(near))
    present = np.zeros(len(items.vocabulary), np.int64)
    present[held] = 1
    sums = np.concatenate(([0], np.cumsum(present[items.flat])))
    near = near[sums[items.edge[near + 1]] - sums[items.edge[near]] >= items.need[near]]  # no text can match more
    whole = np.full(n, -1, np.int64)
    whole[places] = word
    for i in near.tolist():
        item, need = items.words(i), int(items.need[i])
        m = len(item)
        reach = 3 * m  # a score over 0 has fewer gaps and other words than twice the matches
        seeds = [w for w in np.unique(item).tolist() if i in items.of_seed[w]]
        at = places[np.isin(word, seeds)]
        cut = np.concatenate(([True], at[1:] - reach > at[:-1] + reach))
        best: tuple | None = None
        for a, e in zip(np.maximum(at[cut] - reach, 0).tolist(), np.minimum(at[np.append(cut[1:], True)] + reach, n).tolist()):
            while a < e:
                for matched, f, t in found(item, whole[a : min(e, a + max(PIECE, 2 * reach))], need):
                    if best is None or (matched, -a - f) > (best[0], -best[1]):
                        best = (matched, a + f, a + t - 1)
                a += max(PIECE, 2 * reach) - reach
        if best:
            yield i, best[0] / m, best[1], best[2]


LEAKS = "doc_id long, item_id long, similarity double, first_word long, last_word long"


def _leaks(df: DataFrame, items: Items) -> DataFrame:
    """Written before it returns, so that the block's broadcast can go."""
    names = ("doc_id", "item_id", "similarity", "first_word", "last_word")
    schema = pa.schema([(n, pa.float64() if n == "similarity" else pa.int64()) for n in names])
    shared = df.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        look = own.lookup()
        for ids, docs in slices(batches):
            word, doc = words(folded(docs), "alnum")
            edge = np.searchsorted(doc, np.arange(len(docs) + 1))
            at, k = known(word, *look)
            held = np.searchsorted(at, edge)
            out = []
            for d in np.unique(doc[at]).tolist():
                a, e = held[d], held[d + 1]
                out += [(ids[d], own.ids[i], *x) for i, *x in in_text(at[a:e] - edge[d], k[a:e], int(edge[d + 1] - edge[d]), own)]
            yield table(schema, **{n: [r[k] for r in out] for k, n in enumerate(names)})

    out = settle(df.mapInArrow(run, LEAKS), "leaks", narrow=False)
    shared.destroy()
    return out


def blocks(rows: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    held: list[tuple[int, str]] = []
    size = 0
    for key, text in rows:
        n = len((text or "").split())
        if held and (len(held) >= BLOCK_ITEMS or size + n > BLOCK_WORDS):
            yield held
            held, size = [], 0
        held.append((key, text))
        size += n
    if held:
        yield held


def leaks(df: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, first_word, last_word: a row for each text and item that it holds at this similarity or more, with the best place (the first of equals)."""
    df = texts(df, id_col, text_col)
    rows = ((r["doc_id"], r["text"]) for r in texts(benchmark, item_col, item_text).toLocalIterator())
    out = None
    for block in blocks(rows):
        items = Items(block, threshold)
        if not len(items.vocabulary):
            continue
        items.keep_rarest(seed_counts(df, items))
        part = _leaks(df, items)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else df.sparkSession.createDataFrame([], LEAKS)


def op1_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    """Every document against every benchmark item."""
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
