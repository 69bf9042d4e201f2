"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The texts that a task holds are one corpus: its distinct pieces (matches of the pattern) are gathered, an inverted index from a pair's rank to
the places where that pair stands is built over all of them, and the merges are replayed in rank order, each touching only the neighbours of
its places: those with many places as arrays, the long tail one by one. Results stay in a table of bounded size (PIECES_HELD, BYTES_HELD) for later batches, in two halves: when the newer one is full, the older one
goes, but for pieces met since; only speed depends on it. Null and empty texts have no ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import HELD, read, release, slices, table, texts, trim

PIECES_HELD, BYTES_HELD = 400_000, 24 << 20
#: Texts whose new pieces are replayed together, and new pieces beyond which a replay does not wait for further texts.
REPLAY_BYTES, NEW_PIECES = 4 << 20, 50_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as src:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, src)}


def load_tokens(path: str) -> dict[int, bytes]:
    return {i: b for b, i in load_ranks(path).items()}


class Merges:
    """Ranks of pairs of token ids: every way to cut a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.rank = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.first = np.full((256, 256), -1, np.int64)
        for t, r in ranks.items():
            if len(t) == 2:
                self.first[t[0], t[1]] = r
        n = max(ranks.values(), default=0) + 2
        pair = np.fromiter(self.rank, np.int64, len(self.rank))
        rank = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        left, right = pair >> 32, pair & 0xFFFFFFFF
        # pairs by what they make, by their left and by their right id
        order = np.argsort(rank, kind="stable")
        self.made = pair[order], np.searchsorted(rank[order], np.arange(n))
        order = np.lexsort((right, left))
        self.lefts = right[order], rank[order], np.searchsorted(left[order], np.arange(n))
        order = np.lexsort((left, right))
        self.rights = left[order], rank[order], np.searchsorted(right[order], np.arange(n))

    def cuts(self, token: int) -> np.ndarray:
        """Pairs that make the token."""
        pair, cut = self.made
        return pair[cut[token] : cut[token + 1]]

    @staticmethod
    def find(side: tuple[np.ndarray, np.ndarray, np.ndarray], token: int, other: np.ndarray) -> np.ndarray:
        """Ranks of the token's pairs with the other ids; NONE where they make no token."""
        ids, rank, cut = side
        a, e = cut[token], cut[token + 1]
        if a == e:
            return np.full(len(other), NONE)
        at = np.minimum(np.searchsorted(ids[a:e], other), e - a - 1)
        return np.where(ids[a:e][at] == other, rank[a:e][at], NONE)


NONE = 1 << 40
#: Merges with many places are replayed as arrays; after LULL merges in a row with fewer than FEW places, the rest go one by one.
FEW, LULL = 64, 50


def merge_all(now: int, at: np.ndarray, ids: np.ndarray, follow: np.ndarray, before: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray] | None:
    """One merge at all its places at once: (ranks, places) of the pairs that its neighbours now form. None, and nothing done, where such a pair
    has an earlier rank and so goes before the next place of this merge."""
    at = np.unique(at)
    j = follow[at]
    pair = np.where((ids[at] >= 0) & (j >= 0), ids[at] << 32 | ids[j], -1)
    good = np.zeros(len(at), bool)
    for cut in merges.cuts(now):
        good |= pair == cut
    at, j = at[good], j[good]
    clash = np.flatnonzero(at[1:] == j[:-1])
    if len(clash):  # a symbol of two places goes to the left one
        keep = np.ones(len(at), bool)
        for k in clash.tolist():
            if keep[k]:
                keep[k + 1] = False
        at, j = at[keep], j[keep]
    n, b = follow[j], before[at]
    touch = n[:-1] == at[1:]  # the next place follows at once
    touched = np.concatenate(([False], touch))[: len(at)]
    b[1:][touch] = at[:-1][touch]
    on_right = np.where(n >= 0, merges.find(merges.lefts, now, ids[n]), NONE)
    on_left = np.where(b >= 0, merges.find(merges.rights, now, np.where(touched, now, ids[b])), NONE)
    if len(at) and min(on_right.min(), on_left.min()) < now:
        return None
    ids[at], ids[j], follow[at] = now, -1, n
    before[n[n >= 0]] = at[n >= 0]
    r = on_right < NONE
    r[:-1] &= ~touch
    l = on_left < NONE  # noqa: E741
    return np.concatenate((on_right[r], on_left[l])), np.concatenate((at[r], b[l]))


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after another, and how many each has. Symbols of all pieces lie in one sequence, linked to their neighbours; pieces never touch."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    n = len(data)
    after, prior = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    filled = sizes > 0
    after[ends[filled] - 1] = prior[(ends - sizes)[filled]] = -1
    symbols = merges.single[data]
    # the inverted index: places of each pair by its rank
    places: dict[int, list] = {}
    heap: list[int] = []

    def note(rank: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(rank, kind="stable")
        found, cut = np.unique(rank[order], return_index=True)
        for r, part in zip(found.tolist(), np.split(at[order], cut[1:])):
            if r in places:
                places[r].append(part)
            else:
                places[r] = [part]
                heapq.heappush(heap, r)

    start = np.flatnonzero(after >= 0)
    rank = merges.first[data[start], data[start + 1]] if n else np.empty(0, np.int64)
    note(rank[rank >= 0], start[rank >= 0])
    quiet = 0
    while heap and quiet < LULL:
        now = heap[0]
        at = np.concatenate(places[now])
        quiet = quiet + 1 if len(at) < FEW else 0
        new = merge_all(now, at, symbols, after, prior, merges)
        if new is None:
            break
        heapq.heappop(heap)
        del places[now]
        if len(new[0]):
            note(*new)
    out = symbols
    if places:  # what is left goes singly, over the symbols that are alive
        live = np.flatnonzero(symbols >= 0)
        short = np.full(n + 1, -1, np.int32)  # the last one stands for no neighbour
        short[live] = np.arange(len(live), dtype=np.int32)
        ids, follow, before = symbols[live].tolist(), short[after[live]].tolist(), short[prior[live]].tolist()
        left = {}
        while places:
            r, x = places.popitem()
            x = short[np.unique(np.concatenate(x))]
            left[r] = x[x >= 0].tolist()
        del after, prior, short
        out[live] = replay_singly(ids, follow, before, heap, left, merges)
    alive = out >= 0
    count = np.concatenate(([0], np.cumsum(alive)))
    return out[alive], count[ends] - count[ends - sizes]


def replay_singly(ids: list[int], follow: list[int], before: list[int], heap: list[int], places: dict[int, list[int]], merges: Merges) -> list[int]:
    """The merges that are left, place by place."""
    get = merges.rank.get
    while heap:
        now = heapq.heappop(heap)
        at = places.pop(now, None)
        if at is None:
            continue
        at.sort()
        for k, i in enumerate(at):
            left = ids[i]
            if left < 0 or (j := follow[i]) < 0 or get(left << 32 | ids[j]) != now:  # a neighbour changed since the place was noted
                continue
            ids[i], ids[j] = now, -1
            low = now
            n = follow[i] = follow[j]
            if n >= 0:
                before[n] = i
                if (r := get(now << 32 | ids[n])) is not None:
                    if r in places:
                        places[r].append(i)
                    else:
                        places[r] = [i]
                        heapq.heappush(heap, r)
                    if r < low:
                        low = r
            if (b := before[i]) >= 0 and (r := get(ids[b] << 32 | now)) is not None:
                if r in places:
                    places[r].append(b)
                else:
                    places[r] = [b]
                    heapq.heappush(heap, r)
                if r < low:
                    low = r
            if low < now and k + 1 < len(at):  # an earlier merge became possible: it goes first, the rest of this one waits
                if now not in places:
                    places[now] = []
                    heapq.heappush(heap, now)
                places[now].extend(at[k + 1 :])
                break
    return ids


class Encoder:
    """Of a task or worker: the ids of pieces that it met."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = load_ranks(path)
        self.merges, self.find = Merges(ranks), regex.compile(pattern).findall
        self.kind = np.dtype("<u2" if len(ranks) <= 1 << 16 else "<u4")
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def encode(self, docs: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        rows: list[tuple] = []  # of each text its pieces' ids, where they are not known yet and which pieces these are (one object for equal ones)
        new: dict[str, str] = {}
        for d in docs:
            pieces = self.find(d)
            codes = list(map(self.held.get, pieces))
            gaps = [i for i, c in enumerate(codes) if c is None] if None in codes else []
            one = new.setdefault
            rows.append((codes, gaps, [one(p, p) for p in map(pieces.__getitem__, gaps)]))
            if len(new) > NEW_PIECES:
                out += self.settled(rows, new)
                rows, new = [], {}
        return out + self.settled(rows, new)

    def settled(self, rows: list[tuple], new: dict[str, str]) -> list[np.ndarray]:
        """Ids of the texts, once their new pieces are replayed or found in the older half."""
        known = {p: self.older[p] for p in new if p in self.older}
        fresh = [p for p in new if p not in known]
        ids, counts = replay([p.encode() for p in fresh], self.merges)
        code, at = ids.astype(self.kind).tobytes(), 0
        for piece, end in zip(fresh, (np.cumsum(counts) * self.kind.itemsize).tolist()):
            known[piece] = code[at:end]
            at = end
        out = []
        for codes, gaps, names in rows:
            for i, piece in zip(gaps, names):
                codes[i] = known[piece]
            out.append(np.frombuffer(b"".join(codes), self.kind))
        if self.size > BYTES_HELD // 2 or len(self.held) > PIECES_HELD // 2:
            self.held, self.older, self.size = {}, self.held, 0
        self.held.update(known)
        self.size += sum(map(len, known))
        return out


def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker: a worker's later tasks find the pieces of earlier ones."""
    held = HELD.setdefault("bpe", {})
    if (path, pattern) not in held:
        held[path, pattern] = Encoder(path, pattern)
    return held[path, pattern]


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DECODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded", pa.binary()), ("ids", pa.list_(pa.int32()))])
DECODED_SQL = "doc_id long, n_tokens long, ids_sha256 string, decoded binary, ids array<int>"


def encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    release("bpe")
    enc = encoder(path, pattern)
    for keys, docs in slices(batches, REPLAY_BYTES, "bpe"):
        got = enc.encode([d.decode() for d in docs])
        trim()
        ends = np.cumsum([0, *map(len, got)])
        values = np.concatenate(got).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))], schema=ENCODED)


class Decoder:
    """Tokens, and their ids in decimal with a space after each, as arrays that all ids of a batch are looked up in at once."""

    def __init__(self, path: str) -> None:
        tokens = load_tokens(path)
        every = range(max(tokens, default=-1) + 1)
        self.tokens = pa.array([tokens.get(i) for i in every], pa.large_binary())
        self.decimals = pa.array([b"%d " % i if i in tokens else None for i in every], pa.large_binary())

    @staticmethod
    def joined(parts: pa.Array, ids: pa.Array, ends: np.ndarray) -> tuple[memoryview, list[int]]:
        """What the ids stand for, one after another, and where each row's part of that ends (0 first)."""
        found = parts.take(ids)
        if found.null_count:
            raise KeyError("an id is no token")
        data = found.buffers()[2]
        return memoryview(data) if data else memoryview(b""), np.frombuffer(found.buffers()[1], np.int64)[found.offset :][ends].tolist()

    def rows(self, lists: pa.ListArray) -> tuple[list[int], list[str], list[bytes]]:
        """Of each list: its length, the SHA-256 of its decimal ids joined by one space, its bytes."""
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        ids = lists.flatten()
        data, at = self.joined(self.decimals, ids, ends)
        digests = [hashlib.sha256(data[a : max(a, e - 1)]).hexdigest() for a, e in zip(at, at[1:])]
        data, at = self.joined(self.tokens, ids, ends)
        return np.diff(ends).tolist(), digests, [bytes(data[a:e]) for a, e in zip(at, at[1:])]


def decoded(batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    release("bpe")
    held = HELD.setdefault("bpe", {})
    if path not in held:
        held[path] = Decoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sizes, digests, data = held[path].rows(part.column(1))
            yield table(DECODED, doc_id=part.column(0), n_tokens=sizes, ids_sha256=digests, decoded=data, ids=part.column(1) if keep_ids else [None] * len(sizes))


def bpe_encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: one row per input row, no shuffle."""
    return texts(df, id_col, text_col).mapInArrow(lambda batches: encoded(batches, path, pattern), "doc_id long, ids array<int>")


def bpe_decode(df: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Of doc_id and ids: n_tokens, ids_sha256 (of decimal ids joined by a space), decoded (the bytes), ids (null unless kept)."""
    return df.select("doc_id", "ids").mapInArrow(lambda batches: decoded(batches, path, keep_ids), DECODED_SQL)


def bpe_round_trip(df: DataFrame, path: str, pattern: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bpe_decode of bpe_encode in one Python worker: ids don't pass through the JVM between."""
    return texts(df, id_col, text_col).mapInArrow(lambda batches: decoded(encoded(batches, path, pattern), path, keep_ids), DECODED_SQL)


def op9_bpe_round_trip(spark, sf_dir) -> DataFrame:
    """Contract query: every document encoded, and decoded from its ids."""
    import public_tokenizers
    from pyspark.sql import functions as F

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
