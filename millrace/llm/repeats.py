"""Suffix-array dedup: removal of every byte covered by a 100-byte string that starts earlier in the collection.

1. Texts are cut into minimizer spans (windows.py); equal windows share a minimizer. Spans of equal content are settled by a digest of 128 bits (BLAKE2b,
   with a salt drawn for each run): all but the first are repeated as a whole. Each task does that for its own spans before anything is shuffled, so that a passage shared by a third of all
   texts sends one row from each task.
2. The other spans matter only where a minimizer has several contents, or stands twice in one window. Those contents alone are fetched from the texts, grouped by minimizer
   and gathered into blocks; of each block the collection's Burrows-Wheeler transform and common prefixes are built (suffixes.py), and windows
   that lie next to each other with a common prefix of a whole window are one group, of which all but the first are repeated. A minimizer whose contents
   have more than LARGE bytes together (a passage just below a window's length in many texts) is no block: its windows are dealt one by one by their own
   digest, the first of each in its task, then in all.
3. Repeated windows go back to their texts, and what they cover is removed.

Null and empty texts are empty. Rows that repeat a doc_id, or have none, count as documents of their own, in order of doc_id (null first) and
text. Extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe_among, read, settle, slices, table, texts
from .suffixes import repeated_windows
from .windows import SIZE, digests, minimizer_spans

SPANS_HELD = 500_000
BLOCK = 1 << 20
#: Bytes of one minimizer's contents that are one block still.
LARGE = 16 << 20
ROWS_HELD = 400_000
#: Added to the number of windows of a span whose own windows may be equal.
TIED = 256


def keyed(df: DataFrame) -> DataFrame:
    """key, doc_id, text: key orders the documents and is unique. It is doc_id itself unless one is repeated or null."""
    ids = df.select("doc_id").groupBy("doc_id").count()
    if ids.filter("count > 1 or doc_id is null").isEmpty():
        return df.select(F.col("doc_id").alias("key"), "doc_id", "text")
    rows = df.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return settle(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "keyed")


def _rows(m, h, g, key, pos, n) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(x, t)) for x, t in zip((m, h, g, key, pos, n), (*4 * [np.int64], *2 * [np.int32]))]
    return pa.RecordBatch.from_arrays(arrays, names=["m", "h", "g", "key", "pos", "n"])


def _joined(key: np.ndarray, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that follow on one another as one."""
    if not len(key):
        return key, pos, n
    order = np.lexsort((pos, key))
    key, pos, n = key[order], pos[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (pos[1:] != pos[:-1] + n[:-1]))))
    return key[first], pos[first], np.add.reduceat(n, first)


SPAN = "m long, h long, g long, key long, pos int, n int"


def spans_of(df: DataFrame, salt: bytes) -> DataFrame:
    """Spans (minimizer, digest, key, first window, windows); rows with negative n are repeated windows that the task knows already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(map(np.concatenate, zip(*held)))
            order = np.lexsort(rows[4::-1])
            m, h, g, key, pos, n = (x[order] for x in rows)
            again = np.concatenate(([False], (m[1:] == m[:-1]) & (h[1:] == h[:-1]) & (g[1:] == g[:-1])))
            yield _rows(*(x[~again] for x in (m, h, g, key, pos, n)))
            if again.any():
                k, p, c = _joined(key[again], pos[again], n[again] % TIED)
                none = np.zeros(len(k), np.int64)
                yield _rows(k * 1_000_003 + p, none, none, k, p, -c)

        for keys, docs in slices(batches):
            m, h, doc, pos, n, tie = minimizer_spans(docs, salt)
            if len(m):
                held.append((m, h[:, 0], h[:, 1], np.array(keys, np.int64)[doc], pos, n + TIED * tie))
                size += len(m)
            if size > SPANS_HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return df.select("key", "text").mapInArrow(run, SPAN)


def sorted_out(spans: DataFrame, parts: int) -> DataFrame:
    """Of spans dealt by minimizer: repeated ones (negative n), and one span of each content where a minimizer has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        begun: tuple | None = None  # (minimizer, digest) of the last row of a group that was cut

        def settle_rows(*rows) -> Iterator[pa.RecordBatch]:
            known = rows[-1] < 0
            yield _rows(*(x[known] for x in rows))
            m, h, g, key, pos, n = (x[~known] for x in rows)
            if not len(m):
                return
            fresh = np.concatenate(([True], m[1:] != m[:-1]))
            other = fresh | np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
            cut = begun is not None and begun[0] == m[0]
            if cut and begun[1:] == (h[0], g[0]):
                other[0] = False
            group = np.cumsum(fresh) - 1
            contents = np.bincount(group, weights=other).astype(int)
            if cut or whole:  # part of a group: its other parts may hold other contents
                contents[0 if cut else -1] = 2
            if len(again := np.flatnonzero(~other)):
                k, p, c = _joined(key[again], pos[again], n[again] % TIED)
                none = np.zeros(len(k), np.int64)
                yield _rows(none, none, none, k, p, -c)
            keep = other & ((contents[group] > 1) | (n >= TIED))
            yield _rows(m[keep], h[keep], g[keep], key[keep], pos[keep], n[keep] % TIED)

        whole = False
        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            count += batch.num_rows
            if count < ROWS_HELD:
                continue
            rows = list(map(np.concatenate, zip(*held)))
            m = rows[0]
            k = len(m) - int(np.argmax(m[::-1] != m[-1])) if (m != m[-1]).any() else 0
            if k:
                yield from settle_rows(*(x[:k] for x in rows))
                begun = None
            rest = [x[k:] for x in rows]
            if len(rest[0]) >= ROWS_HELD // 2:  # one minimizer fills the batch
                whole = True
                yield from settle_rows(*rest)
                whole = False
                begun = tuple(x[-1] for x in rest[:3])
                rest = []
            held, count = ([tuple(rest)], len(rest[0])) if rest else ([], 0)
        if held:
            yield from settle_rows(*map(np.concatenate, zip(*held)))

    return spans.repartition(parts, "m").sortWithinPartitions("m", "h", "g", "key", "pos").mapInArrow(run, SPAN)


def _among(df: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among the ids, and the others: by a filter, before any shuffle."""
    inside = maybe_among(F.col("key"), ids)
    return df.filter(inside), df.filter(~inside)


def contents_of(spans: DataFrame, df: DataFrame) -> DataFrame:
    """m, key, pos, content of the spans that are left."""
    schema = pa.schema([("m", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(2)
            at = 0
            for keys, docs in slices([batch.select([0, 1])]):
                m, key, pos, content = [], [], [], []
                for i, (k, data) in enumerate(zip(keys, docs)):
                    for c in cuts[at + i].as_py():
                        m.append(c["m"])
                        key.append(k)
                        pos.append(c["pos"])
                        content.append(data[c["pos"] : c["pos"] + c["n"] + SIZE - 1])
                at += len(docs)
                yield table(schema, m=m, key=key, pos=pos, content=content)

    some, _ = _among(df, spans.select(F.col("key").alias("id")))
    cuts = spans.groupBy("key").agg(F.collect_list(F.struct("m", "pos", "n")).alias("cuts"))  # of one text each
    return some.select("key", "text").join(cuts, "key").select("key", "text", "cuts").mapInArrow(run, "m long, key long, pos int, content binary")


def matched(contents: DataFrame, parts: int) -> DataFrame:
    """Repeated windows (key, pos, n), by the transform of blocks of whole minimizer groups."""
    schema = pa.schema([("key", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])

    def block(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[2]))
        key = np.array([r[1] for r in rows])
        ids, which = np.unique(key, return_inverse=True)
        pos = np.array([r[2] for r in rows], np.int64)
        index, start = repeated_windows([r[3] for r in rows], which.astype(np.int64) << 32 | pos, SIZE)
        k, p, c = _joined(key[index], pos[index] + start, np.ones(len(index), np.int64))
        return table(schema, key=k, pos=p.astype(np.int32), n=c.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BLOCK and row[0] != held[-1][0]:
                    yield block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield block(held)

    return contents.repartition(parts, "m").sortWithinPartitions("m", "key", "pos").mapInArrow(run, "key long, pos int, n int")


def dealt_windows(contents: DataFrame, salt: bytes) -> DataFrame:
    """Repeated windows (key, pos, n) of contents (m, key, pos, content), each window dealt by its digest. A task gives on only the first of those that it holds."""
    schema = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 5_000) for b in batches for at in range(0, b.num_rows, 5_000)):
            docs = batch.column(3).to_pylist()
            size = np.array([len(d) for d in docs])
            n = size - SIZE + 1
            which = np.repeat(np.arange(len(docs)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = (np.cumsum(size) - size)[which] + step
            d = digests(np.frombuffer(b"".join(docs), np.uint8), start, start + SIZE, salt)
            key, pos = batch.column(1).to_numpy()[which], batch.column(2).to_numpy()[which] + step
            order = np.lexsort((pos, key, d[:, 1], d[:, 0]))
            d, key, pos = d[order], key[order], pos[order]
            again = np.concatenate(([False], (d[1:] == d[:-1]).all(axis=1)))
            yield table(schema, h=d[:, 0], g=d[:, 1], key=key, pos=pos.astype(np.int32), again=again)

    found = settle(contents.mapInArrow(run, "h long, g long, key long, pos int, again boolean"), "dealt", narrow=True)
    place = F.struct("key", "pos")
    first = found.filter("not again").groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    late = found.filter("not again").join(first, ["h", "g"]).filter(place > F.col("first"))
    return late.select("key", "pos").union(found.filter("again").select("key", "pos")).select("key", "pos", F.lit(1).alias("n"))


def kept_parts(data: bytes, runs: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(removed, kept) byte ranges, of runs (first window, windows)."""
    removed: list[list[int]] = []
    for pos, n in sorted(runs):
        end = pos + n - 1 + SIZE
        if removed and pos <= removed[-1][1]:
            removed[-1][1] = max(removed[-1][1], end)
        else:
            removed.append([pos, end])
    edges = [0, *(x for r in removed for x in r), len(data)]
    return [(a, b) for a, b in removed], [(a, b) for a, b in zip(edges[0::2], edges[1::2]) if a < b]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, removed array<struct<start, end>> (bytes), kept (the other bytes): one row per input row."""
    spark = df.sparkSession
    df = keyed(texts(df, id_col, text_col))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    salt = os.urandom(16)
    spans = settle(sorted_out(spans_of(df, salt), parts), "spans")
    left = spans.filter("n > 0")
    large = settle(left.groupBy("m").agg(F.sum(F.col("n").cast("long") + SIZE - 1).alias("bytes")).filter(F.col("bytes") > LARGE).select("m"), "large", narrow=True)
    blocks, dealt = left, None
    if not large.isEmpty():
        blocks, dealt = left.join(large, "m", "left_anti"), dealt_windows(contents_of(left.join(large, "m", "left_semi"), df), salt)
    marks = matched(contents_of(blocks, df), parts)
    marks = settle(marks if dealt is None else marks.union(dealt), "windows")
    runs = spans.filter("n < 0").select("key", "pos", (-F.col("n")).alias("n")).union(marks)
    runs = settle(runs.groupBy("key").agg(F.collect_list(F.struct("pos", "n")).alias("runs")), "runs")  # of one text each
    some, others = _among(df, runs.select(F.col("key").alias("id")))
    rows = some.join(runs, "key", "left").select("doc_id", "text", "runs").unionByName(others.select("doc_id", "text", F.lit(None).cast("array<struct<pos:int,n:int>>").alias("runs")))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("removed", span), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for keys, docs in slices([batch.select([0, 1])]):
                cut, kept = [], []
                for i, data in enumerate(docs):
                    gone, stay = kept_parts(data, [(r["pos"], r["n"]) for r in batch.column(2)[at + i].as_py() or ()])
                    cut.append(gone)
                    kept.append(b"".join(data[a:b] for a, b in stay))
                at += len(docs)
                yield table(
                    schema,
                    doc_id=keys,
                    n_bytes=[len(d) for d in docs],
                    n_removed=[sum(b - a for a, b in g) for g in cut],
                    n_spans=[len(g) for g in cut],
                    removed=[[{"start": a, "end": b} for a, b in g] for g in cut],
                    kept=kept,
                )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, kept binary")


def op4_suffix_dedup(spark, sf_dir) -> DataFrame:
    """Contract query."""
    return remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
