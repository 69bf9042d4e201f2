"""Shared helpers of the training-data operators: reading, shared files, batches."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are taken from an Arrow batch in slices of about this many bytes.
SLICE_BYTES = 2 << 20
#: Set where the session sets none, as texts are wide: the size of an Arrow batch, the rows that a Parquet reader decodes at once (4,096 texts are 15 MB and
#: more, in arrays that double), and the bytes of a row group, which a writer gathers and a reader loads whole. They change no result.
WIDE_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.parquet.columnarReaderBatchSize": "512", "parquet.block.size": str(16 << 20)}
#: What a session says of those that nobody set, where it isn't None.
UNSET = {"spark.sql.execution.arrow.maxBytesPerBatch": "-1", "spark.sql.parquet.columnarReaderBatchSize": "4096"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, under fixed names; clashing extra columns are out."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def small_batches(spark: SparkSession) -> None:
    for name, value in WIDE_ROWS.items():
        if spark.conf.get(name, None) in (None, UNSET.get(name)):
            spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or one of our own on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and what made it runs once. Survives lost executors.

    narrow: rows of ids, not texts; a fourth as many tasks write them as shuffles have, two a core at least, so that they leave few files. Not for
    tasks that name files by their partition."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, name)
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    (df.coalesce(tasks) if narrow else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and a path in it, for any URI that pyarrow knows (file, hdfs, s3, gs)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))


def write_file(uri: str, data: bytes) -> None:
    """Write under another name, then move: a task that is run again or twice leaves whole files only."""
    store, path = open_fs(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part, compression=None) as out:
        out.write(data)
    store.move(part, path)


def read_file(uri: str) -> bytes:
    store, path = open_fs(uri)
    with store.open_input_stream(path, compression=None) as src:
        return src.read()


#: What a Python worker keeps for later tasks, by what it is of.
HELD: dict[str, dict] = {}


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task is small."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def release(keep: str = "") -> None:
    """Workers are used again by other operators: what is kept for those is let go."""
    gone = [k for k in HELD if k != keep]
    for k in gone:
        del HELD[k]
    if gone:
        gc.collect()
        trim()


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES, keep: str = "powers") -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8 bytes, null as empty) of about `size` bytes each; a longer text comes alone."""
    release(keep)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        held: list = []
        docs: list[bytes] = []
        total = 0
        for key, value in zip(ids, batch.column(1).cast(pa.binary())):
            data = value.as_py() or b""
            if held and total + len(data) > size:
                yield held, docs
                held, docs, total = [], [], 0
            held.append(key)
            docs.append(data)
            total += len(data)
        if held:
            yield held, docs
    batch = ids = held = docs = None
    trim()


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_LUT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    powers = HELD.setdefault("powers", {})
    if len(powers.get("up", ())) < n:
        m = max(n + (n >> 2), 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(m, base, dtype=np.uint64)
            a[0] = 1
            powers[name] = np.multiply.accumulate(a)
    return powers["up"][:n], powers["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 from which spans() takes the hash of any span of the bytes."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_LUT[data] * _powers(len(data))[0], out=sums[1:])
    return sums


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]: equal content, equal hash, wherever it stands."""
    down = _powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Byte classes: words between ASCII white space, and words of digits, letters and non-ASCII characters.
CLASSES = {"space": ~_SPACE, "alnum": _WORD}

_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words go through BLAKE2b one by one.
LONG_WORD = 256


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """Keyed 64-bit hashes of data[start:end]: eight bytes at a time are mixed into the state by a bijection, so that words of equal length up to eight
    bytes never collide, and longer ones do by chance alone (no sums of powers, which collide on some strings whatever their base)."""
    n = end - start
    h = mix(n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))
    blocks = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(8, np.uint8))), 8)
    live, done = np.flatnonzero(n <= LONG_WORD), 0
    while len(live):
        rest = n[live] - done
        part = blocks[start[live] + done].view("<u8").reshape(-1).astype(np.uint64, copy=False) & _MASK[np.minimum(rest, 8)]
        h[live] = mix(h[live] ^ part)
        live, done = live[rest > 8], done + 8
    for i in np.flatnonzero(n > LONG_WORD):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=key.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def places(docs: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts: index of the text, start and end byte in the texts joined by one space; and the joined bytes, A-Z in lower case."""
    data = _LOWER[np.frombuffer(b" ".join(docs) + b" ", dtype=np.uint8)]
    inside = CLASSES[kind][data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    first = np.cumsum([0, *(len(d) + 1 for d in docs)])
    return np.searchsorted(first, start, side="right") - 1, start, end, data


def words(docs: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Of all words of the texts, A-Z in lower case: hash, and index of the text."""
    doc, start, end, data = places(docs, kind)
    return hashes(data, start, end), doc


_STEP = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def shingles(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    if len(word) < n:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(len(word) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += word[j : len(word) - n + 1 + j] * _STEP[j]
    return mix(total + np.uint64(n))


def parts_of(rows: int, spark: SparkSession, each: int) -> int:
    """Tasks for so many rows: as many as keep each task to `each` rows, and one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


CHUNKS = 64


def id_filter(ids: DataFrame) -> tuple[int, np.ndarray]:
    """Number of bits, and which of them the hashes of the ids (one column, `id`) set: 16 bits an id, within 2**20 and 2**28 (32 MB, whatever the corpus).

    Beyond that the filter lets more rows pass, which costs a wider shuffle and no row."""
    bits = 1 << min(28, max(20, (16 * ids.count()).bit_length()))
    wide = bits // CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            v = batch.column(0).to_numpy()
            for k in np.unique(v // wide).tolist():
                total.setdefault(k, np.zeros(wide, bool))[v[v // wide == k] % wide] = True
        for k, b in total.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "bits": pa.array([np.packbits(b).tobytes()], pa.binary())})

    hashed = ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("h")).distinct()
    out = np.zeros(bits // 8, np.uint8)
    for r in hashed.repartition(12, (F.col("h") / wide).cast("int")).mapInArrow(run, "chunk int, bits binary").collect():
        out[r["chunk"] * wide // 8 : (r["chunk"] + 1) * wide // 8] |= np.frombuffer(r["bits"], np.uint8)
    return bits, out


def maybe_among(key: Column, ids: DataFrame) -> Column:
    """Whether a key may be among the ids: true for all that are, and for few others."""
    bits, packed = id_filter(ids)
    shared = ids.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("boolean")
    def named(h: pd.Series) -> pd.Series:
        v, have = h.to_numpy(), shared.value
        return pd.Series((have[v >> 3] >> (7 - (v & 7))) & 1 == 1)

    return named(F.pmod(F.xxhash64(key), F.lit(bits)))
