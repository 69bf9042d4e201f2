"""Token-id output in bit-plane files.

File: magic, then chunks of at most BLOCK_IDS ids, then a JSON index and its length. A chunk is the ids as 32-bit little-endian numbers,
transposed into 32 bit planes (or 4 byte planes); each plane is compressed with zstandard, a plane of zeros takes no bytes. The index holds
offset, ids and plane sizes of each chunk, and doc_id and ids of each document, in order. Chunks can be read without the others.

Documents lie in ascending doc_id over the files in order of their names; repeated doc_ids are ordered by text. Null and empty texts have the
end id alone. Files have at most FILE_IDS ids and one document more, so memory does not follow a partition's size.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HELD, fresh_dir, read, read_file, settle, slices, table, texts, write_file

MAGIC = b"BITPLANE1\n"
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 22
END_ID = 2
#: Ids of short words are kept in each Python worker, up to this many bytes of words.
HELD_BYTES, HELD_WORD = 16 << 20, 64


def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    out = []
    for k in range(4):
        if raw[:, k].any():
            out += [np.packbits((raw[:, k] >> b) & 1, bitorder="little").tobytes() for b in range(8)]
        else:
            out += [b"\0" * -(-len(raw) // 8)] * 8
    return out


def from_planes(planes: list[bytes | None], n: int, mode: str) -> np.ndarray:
    """None: a plane of zeros."""
    raw = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        if plane is None:
            continue
        if mode == "byte":
            raw[:, k] = np.frombuffer(plane, np.uint8)
        else:
            raw[:, k >> 3] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little") << (k & 7)
    return raw.reshape(-1).view("<u4")


def dump(docs: list[tuple[int, int]], ids: np.ndarray, mode: str = "bit", level: int = 1) -> bytes:
    pack, out, at, chunks = zstandard.ZstdCompressor(level=level), [MAGIC], len(MAGIC), []
    for a in range(0, len(ids), BLOCK_IDS):
        part = ids[a : a + BLOCK_IDS]
        planes = [pack.compress(p) if p.strip(b"\0") else b"" for p in to_planes(part, mode)]
        chunks.append([at, len(part), [len(p) for p in planes]])
        out += planes
        at += sum(map(len, planes))
    index = json.dumps({"mode": mode, "chunks": chunks, "docs": docs}, separators=(",", ":")).encode()
    return b"".join([*out, index, struct.pack("<Q", len(index))])


def load_index(data: bytes) -> dict:
    if not data.startswith(MAGIC):
        raise ValueError("not a bit-plane file")
    n = struct.unpack("<Q", data[-8:])[0]
    return json.loads(data[-8 - n : -8])


def load_chunk(data: bytes, index: dict, k: int) -> np.ndarray:
    at, n, sizes = index["chunks"][k]
    unpack, planes = zstandard.ZstdDecompressor(), []
    for s in sizes:
        planes.append(unpack.decompress(data[at : at + s]) if s else None)
        at += s
    return from_planes(planes, n, index["mode"])


def load(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) of each document."""
    index = load_index(data)
    ids = np.concatenate([np.empty(0, "<u4"), *(load_chunk(data, index, k) for k in range(len(index["chunks"])))])
    at = 0
    for key, n in index["docs"]:
        yield key, ids[at : at + n]
        at += n


#: A letter and the full stop or comma that ends its part of a text: the tokenizer always cuts between them.
ENDING = re.compile(r"([a-z])([.,])(?=[ \n])")


def parts_of(text: str) -> list[str]:
    """Parts of a text that the tokenizer never joins. ASCII texts are put in lower case first, as it does; not where a special token's string may be."""
    if text.isascii() and "<|" not in text:
        text = ENDING.sub(r"\1 \2", text.lower())
    return text.replace("\n", " ").split(" ")


class WordEncoder:
    """Ids of whole texts as the library gives them. The tokenizer drops white space and never joins across it, so a text's ids are those of its
    parts between spaces and line feeds; each distinct part goes through the library once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        self.batch = getattr(t, "encode_batch_fast", t.encode_batch)
        self.held: dict[str, bytes] = {"": b""}
        self.size = 0

    def encode(self, docs: list[str]) -> list[bytes]:
        """32-bit little-endian ids of each text."""
        cut = [parts_of(d) for d in docs]
        if self.size > HELD_BYTES:
            self.held, self.size = {"": b""}, 0
        new = [p for p in set().union(*cut) if p not in self.held]
        got = {w: struct.pack(f"<{len(ids)}I", *ids) for w, ids in zip(new, (e.ids for e in self.batch(new, add_special_tokens=False)))}
        short = {w: b for w, b in got.items() if len(w) <= HELD_WORD}
        self.held.update(short)
        self.size += sum(map(len, short))
        if len(short) < len(got):
            find = lambda w: self.held[w] if w in self.held else got[w]
        else:
            find = self.held.__getitem__
        return [b"".join(map(find, parts)) for parts in cut]


def word_encoder(path: str) -> WordEncoder:
    held = HELD.setdefault("tokens", {})
    if path not in held:
        held[path] = WordEncoder(path)
    return held[path]


def write_tokens(df: DataFrame, path: str, out_dir: str, mode: str = "bit", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files; returns their manifest: file, n_docs, n_ids, start (ids in all files before it). Texts are dealt by ranges of doc_id, once."""
    schema = pa.schema([("file", pa.string()), ("place", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, place = word_encoder(path), TaskContext.get().partitionId()
        docs: list[tuple[int, int]] = []
        held: list[bytes] = []
        n = seq = 0

        def flush() -> pa.RecordBatch:
            name = f"{out_dir}/ids-{place:08d}-{seq:08d}.bin"
            write_file(name, dump(docs, np.frombuffer(b"".join(held), "<u4"), mode))
            return table(schema, file=[name], place=[place], n_docs=[len(docs)], n_ids=[n])

        for keys, part in slices(batches, keep="tokens"):
            for key, ids in zip(keys, enc.encode([d.decode() for d in part])):
                docs.append((key, len(ids) // 4 + 1))
                held += [ids, end]
                n += docs[-1][1]
                if n >= FILE_IDS:
                    yield flush()
                    docs, held, n, seq = [], [], 0, seq + 1
        if docs:
            yield flush()

    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = texts(df, id_col, text_col).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    files = settle(dealt.mapInArrow(run, "file string, place int, n_docs long, n_ids long"), "manifest")
    # the ids of all ranges before: a row a range reaches the driver; within a range a sum over its own files
    total, firsts = 0, []
    for r in sorted(files.groupBy("place").agg(F.sum("n_ids").alias("n")).collect()):
        firsts.append((r["place"], total))
        total += r["n"]
    first = spark.createDataFrame(firsts, "place int, first long")
    before = Window.partitionBy("place").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.join(F.broadcast(first), "place")
    return files.select("file", "n_docs", "n_ids", (F.col("first") + F.coalesce(F.sum("n_ids").over(before), F.lit(0))).alias("start"))


def read_tokens(files: DataFrame, keep_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids array<int> (null unless kept) of every document, read from the files of a manifest."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[dict] = []
                for key, ids in load(read_file(name)):
                    rows.append({"doc_id": key, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes()), "ids": ids.tolist() if keep_ids else None})
                    start += len(ids)
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spark = files.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.select("file", "start").repartition(parts, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def op5_token_files(spark, sf_dir) -> DataFrame:
    """Contract query: every document written in bit planes and read back."""
    import public_tokenizers

    files = write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), fresh_dir(spark, "tokens"))
    return read_tokens(files, keep_ids=False).drop("ids")
