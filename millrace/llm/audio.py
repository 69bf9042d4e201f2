"""Media columns: audio features over 8-bit samples.

A payload is stored as 8-bit unsigned mono PCM in a RIFF/WAVE container and read back without loss. Features of the samples: polyphase
resampling, overlapped log-mel filterbanks and hysteresis energy segmentation. The features of each segment are cut or padded to fixed-shape
tensors, kept as an Arrow IPC stream of the canonical fixed_shape_tensor type, with one time span for each. Null and empty payloads become
one block of zeros. Equal payloads give equal values, wherever they stand. Rows that repeat a doc_id, or have none, each give a row; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, table, texts

BLOCK = 64
RATE, TARGET = 16_000, 12_000  # three phases of the filter, every fourth output
FRAME, HOP, MELS, FFT = 300, 120, 16, 512  # 25 ms, 10 ms at TARGET
TAPS = 8  # half the filter's length in samples of the slower rate
HIGH_DB, LOW_DB = -2.0, -6.0  # a segment starts above the mean level plus HIGH_DB and ends below the mean plus LOW_DB
TENSOR_FRAMES = 64
#: Samples are taken in pieces of this many output frames, so that memory does not follow a text's length.
PIECE = 8192


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % BLOCK or (0 if data else BLOCK))


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """RIFF/WAVE, PCM, one channel of unsigned 8-bit samples."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + b"\0" * (len(payload) & 1)


def from_wav(media: bytes) -> tuple[int, bytes]:
    """Rate and samples, found by walking the chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            form, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (form, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono PCM")
        elif name == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


@cache
def kernel(up: int, down: int) -> np.ndarray:
    """Windowed-sinc low-pass, one row for each of the `up` phases."""
    half = TAPS * max(up, down)
    t = np.arange(-half, half + 1)
    h = np.sinc(t / max(up, down)) * np.hanning(len(t) + 2)[1:-1]
    h *= up / h.sum()
    h = np.concatenate((h, np.zeros(-len(h) % up)))
    return h.reshape(-1, up).T.astype(np.float32)


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Polyphase: each output sample takes the one phase of the filter that meets true samples; no zero-stuffed signal is made."""
    g = gcd(rate, target)
    up, down = target // g, rate // g
    if up == down:
        return x
    h = kernel(up, down)
    taps, half = h.shape[1], TAPS * max(up, down)
    n = -(-len(x) * up // down)
    ext = np.concatenate((np.zeros(taps, np.float32), x, np.zeros(taps + 1, np.float32)))
    view = np.lib.stride_tricks.sliding_window_view(ext, taps)
    out = np.empty(n, np.float32)
    for p in range(up):  # outputs by phase: (k * down + half) % up is the same for all of them
        ks = np.array([k for k in range(up) if (k * down + half) % up == p])
        for k0 in ks:
            k = np.arange(k0, n, up)
            at = (k * down + half) // up - taps + 1 + taps
            step = (at[1] - at[0]) if len(at) > 1 else 1
            if len(at):
                out[k] = view[at[0] : at[-1] + 1 : step] @ h[p][::-1]
    return out


@cache
def mel_bank(rate: int, size: int, mels: int) -> np.ndarray:
    """Triangles, evenly spaced on the mel scale."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), mels + 2) / 2595) - 1)
    freq = np.fft.rfftfreq(size, 1 / rate)
    rise = (freq[:, None] - edges[:-2]) / np.diff(edges)[:-1]
    fall = (edges[2:] - freq[:, None]) / np.diff(edges)[1:]
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def log_mel(x: np.ndarray, rate: int = TARGET) -> tuple[np.ndarray, np.ndarray]:
    """(log-mel matrix of frames by MELS, level in dB of each frame). The last frame is padded with silence."""
    n = max(1, -(-max(0, len(x) - FRAME) // HOP) + 1)
    x = np.concatenate((x, np.zeros((n - 1) * HOP + FRAME - len(x), np.float32)))
    view = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    window, bank = np.hanning(FRAME).astype(np.float32), mel_bank(rate, FFT, MELS)
    out, level = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for a in range(0, n, PIECE):
        part = view[a : a + PIECE]
        out[a : a + PIECE] = np.log((np.abs(np.fft.rfft(part * window, FFT)) ** 2).astype(np.float32) @ bank + 1e-6)
        level[a : a + PIECE] = 10 * np.log10(np.einsum("ij,ij->i", part, part) / FRAME + 1e-9)
    return out, level


def segments(level: np.ndarray) -> list[tuple[int, int]]:
    """Frames [start, end) of each segment: it opens at or above the high level and closes below the low level."""
    mean = level.mean()
    state = np.where(level >= mean + HIGH_DB, 1, np.where(level < mean + LOW_DB, -1, 0))
    last = np.maximum.accumulate(np.where(state != 0, np.arange(len(state)), -1))
    on = (last >= 0) & (state[np.maximum(last, 0)] == 1)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], on, [False])).astype(np.int8)))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def tensors(mel: np.ndarray, parts: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Blocks of TENSOR_FRAMES by MELS over the segments (the last of each padded with zeros), and their times in seconds."""
    cuts = [(a, min(a + TENSOR_FRAMES, e)) for s, e in parts for a in range(s, e, TENSOR_FRAMES)]
    out = np.zeros((len(cuts), TENSOR_FRAMES, MELS), np.float32)
    for i, (a, e) in enumerate(cuts):
        out[i, : e - a] = mel[a:e]
    return out, [(a * HOP / TARGET, (e * HOP + FRAME - HOP) / TARGET) for a, e in cuts]


def as_ipc(blocks: np.ndarray) -> bytes:
    kind = pa.fixed_shape_tensor(pa.float32(), blocks.shape[1:])
    values = pa.FixedSizeListArray.from_arrays(pa.array(blocks.reshape(-1)), int(np.prod(blocks.shape[1:])))
    batch = pa.record_batch([pa.ExtensionArray.from_storage(kind, values)], names=["log_mel"])
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue()


def from_ipc(data: bytes) -> np.ndarray:
    column = pa.ipc.open_stream(data).read_next_batch().column(0)
    return column.storage.flatten().to_numpy().reshape(len(column), *column.type.shape)


def feature(blocks: np.ndarray, times: list[tuple[float, float]]) -> str:
    digest = hashlib.sha256(np.round(blocks * 16).astype("<i2").tobytes() + np.round(np.array(times) * 1000).astype("<i8").tobytes())
    return f"{len(blocks)}:{sum(e - s for s, e in times):.3f}:{digest.hexdigest()[:16]}"


def analyse(media: bytes) -> tuple[bytes, np.ndarray, list[tuple[float, float]]]:
    rate, payload = from_wav(media)
    x = (np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128
    mel, level = log_mel(resample(x, rate, TARGET))
    blocks, times = tensors(mel, segments(level))
    return payload, blocks, times


def media_column(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes of the text, media (the WAVE file). One row per input row, no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, docs in slices(batches):
            yield table(schema, doc_id=ids, n_bytes=[len(d) for d in docs], media=[to_wav(padded(d)) for d in docs])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


COLUMNS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tensors binary, spans array<struct<start:double,end:double>>"


def audio_features(df: DataFrame, keep_tensors: bool = True) -> DataFrame:
    """Of doc_id, n_bytes and media: digests of what is stored, `tensors` (Arrow IPC; null if not returned), `spans` in seconds, and a short `feature`, taken from the tensor column as it is read back: number of tensors, seconds in segments, and a digest of tensors and spans (values rounded to 1/16)."""
    span = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("tensors", pa.binary()), ("spans", span)])

    def one(media: bytes) -> dict:
        payload, blocks, times = analyse(media)
        return {
            "payload_bytes": len(payload),
            "payload_sha256": hashlib.sha256(payload).hexdigest(),
            "tail_crc32": zlib.crc32(payload[-BLOCK:]),
            "media_bytes": len(media),
            "media_sha256": hashlib.sha256(media).hexdigest(),
            "feature": None,
            "tensors": as_ipc(blocks),
            "spans": [{"start": s, "end": e} for s, e in times],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = iter(batch.column(2).to_pylist())
            for ids, docs in slices([batch]):
                yield pa.RecordBatch.from_pylist([{"doc_id": k, "n_bytes": next(sizes)} | one(d) for k, d in zip(ids, docs)], schema=schema)

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            found = [feature(from_ipc(t.as_py()), [(s["start"], s["end"]) for s in own]) for t, own in zip(batch.column("tensors"), spans)]
            columns = dict(zip(schema.names, batch.columns)) | {"feature": pa.array(found, pa.string())}
            if not keep_tensors:
                columns["tensors"] = pa.nulls(len(batch), pa.binary())
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], names=schema.names)

    return df.select("doc_id", "media", "n_bytes").mapInArrow(run, COLUMNS).mapInArrow(read_back, COLUMNS)


def op2_audio_features(spark, sf_dir) -> DataFrame:
    """Contract query: every document as a WAVE file, read back and analysed, its tensors stored in a column and read back for the feature."""
    return audio_features(media_column(read(spark, sf_dir, "documents")), keep_tensors=False).drop("tensors", "spans")
