"""Spelling variant grouping: words of a corpus that differ by one edit, found by Aho-Corasick automata over their halves.

1. Words are counted in each task first. A text's words are its maximal runs of ASCII letters and of U+00C0 to U+00FF, A-Z in lower case; one place in
   97 loses a code point (`thinned`), by the CRC-32 of the id and the word. That CRC is put together from the CRC of the id and that of the word, so that
   each distinct word of a slice is hashed once. Kept are words of at least LEAST code points and MIN_COUNT places.
2. A word of L code points is cut into its first L // 2 and the others. One edit leaves one of the halves whole: as a prefix of the other word if it is
   the first half, as a suffix if it is the second. Shards hold halves of one kind, of words of one length that share the half's outer ANCHOR code
   points, at most about SHARD of them; an automaton is built over each. Every word is scanned by the automata of all lengths that one edit
   reaches and of its own outer code points; a hit counts at the half's own end of the word only, and what is left beside it is verified: directly, or by
   an index of what each word's rest is without one code point, where many words share a half. Pairs never leave the task: each word gets a number of
   near words and the best of them, from each shard, and these are summed. A word that both halves find is taken from the first.
3. Roots follow forms by pointer jumping; a form has at least twice the places, so chains are short.

Null and empty texts have no words. Rows that repeat count each by itself; a null id counts as an empty one in the CRC. Of near words with equal counts
the smallest in code-point order is the form. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, settle, slices, table, texts

LEAST, MIN_COUNT, EVERY = 5, 3, 97
#: Words that an automaton holds, about, and outer code points that all words of a shard share.
SHARD, ANCHOR = 100_000, 2
#: Words that share a half and are compared one by one; beyond that their rests are indexed.
FEW = 12
#: Distinct words that a task counts before it gives them on.
HELD = 300_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def runs_of(docs: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All runs of the texts, A-Z in lower case, and the index of each one's text. (U+00C0 to U+00FF are the byte 0xC3 and any other in UTF-8.)"""
    data = np.frombuffer((b" ".join(docs) + b" ").translate(_LOWER), np.uint8)
    lead = data == 0xC3
    inside = ((data >= 97) & (data <= 122)) | lead
    inside[1:] |= lead[:-1]
    start = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    first = np.cumsum([0, *(len(d) + 1 for d in docs)])
    return np.where(inside, data, 32).astype(np.uint8).tobytes().split(), np.searchsorted(first, start, side="right") - 1


def thinned(word: str, h: int) -> str:
    """The word, without the code point at h % length if EVERY divides h."""
    at = h % len(word)
    return word if h % EVERY else word[:at] + word[at + 1 :]


def counted(ids: list, docs: list[bytes]) -> Iterator[tuple[bytes, int]]:
    """Words with at least LEAST bytes and how often they stand in the texts; a word may come twice."""
    tokens, doc = runs_of(docs)
    if not tokens:
        return
    held = np.empty(len(tokens), object)
    held[:] = tokens
    code, words = pd.factorize(held)
    size = np.array([len(w) for w in words])
    long = size[code] >= LEAST
    code, doc = code[long], doc[long]
    if not len(code):
        return
    crc = np.array([zlib.crc32(w) for w in words], np.uint32)
    # crc32(a + b) is crc32(b) and what crc32(a) becomes over as many zeros as b has bytes
    begun = [zlib.crc32(b":" if k is None else b"%d:" % k) for k in ids]
    wide = int(size.max()) + 1
    pairs, which = np.unique(doc * wide + size[code], return_inverse=True)
    over = np.array([zlib.crc32(bytes(p % wide), begun[p // wide]) ^ zlib.crc32(bytes(p % wide)) for p in pairs.tolist()], np.uint32)
    h = over[which] ^ crc[code]
    cut = h % EVERY == 0
    times = np.bincount(code[~cut], minlength=len(words))
    for k in np.flatnonzero(times).tolist():
        yield words[k], int(times[k])
    for (k, x), n in Counter(zip(code[cut].tolist(), h[cut].tolist())).items():
        yield thinned(words[k].decode(), x).encode(), n


def word_counts(df: DataFrame) -> DataFrame:
    """word, n of all words (doc_id, text)."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)

        def flush() -> Iterator[pa.RecordBatch]:
            names, counts = list(total), list(total.values())
            total.clear()
            for i in range(0, len(names), 20_000):
                yield table(schema, word=names[i : i + 20_000], n=counts[i : i + 20_000])

        for ids, docs in slices(batches, keep=""):
            for word, n in counted(ids, docs):
                total[word] += n
            if len(total) > HELD:
                yield from flush()
        yield from flush()

    found = df.mapInArrow(run, "word binary, n long").select(F.col("word").cast("string").alias("word"), "n").filter(F.length("word") >= LEAST)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == b[at + (len(a) == len(b)) :]


class Shared:
    """Words of equal length that share a half: their rests."""

    def __init__(self) -> None:
        self.rests: list[str] = []
        self.words: list[tuple[int, str]] = []
        self.whole: dict[str, int] | None = None
        self.less: dict[tuple[int, str], list[int]] | None = None
        self.shorter: dict[str, list[int]] | None = None

    def near(self, rest: str) -> list[tuple[int, str]]:
        """Words (n, word) whose rest is one edit from this one."""
        if len(self.rests) <= FEW:
            return [w for r, w in zip(self.rests, self.words) if one_edit(rest, r)]
        more = len(rest) - len(self.rests[0])
        without = [rest[:i] + rest[i + 1 :] for i in range(len(rest))]
        if more == 1:  # this one has an extra code point
            if self.whole is None:
                self.whole = {r: k for k, r in enumerate(self.rests)}
            return [self.words[k] for r in set(without) if (k := self.whole.get(r)) is not None]
        if more == -1:  # the others have
            if self.shorter is None:
                self.shorter = defaultdict(list)
                for k, r in enumerate(self.rests):
                    for x in {r[:i] + r[i + 1 :] for i in range(len(r))}:
                        self.shorter[x].append(k)
            return [self.words[k] for k in self.shorter.get(rest, ())]
        if self.less is None:
            self.less = defaultdict(list)
            for k, r in enumerate(self.rests):
                for i in range(len(r)):
                    self.less[i, r[:i] + r[i + 1 :]].append(k)
        return [self.words[k] for i, x in enumerate(without) for k in self.less.get((i, x), ()) if self.rests[k] != rest]


class Shard:
    """Halves of words of one length: the first (at the start of a word) or the second (at its end)."""

    def __init__(self, first: bool, size: int) -> None:
        self.first, self.size, self.half = first, size, size // 2
        self.groups: dict[str, Shared] = {}
        self.automaton = None

    def add(self, word: str, n: int) -> None:
        half, rest = (word[: self.half], word[self.half :]) if self.first else (word[self.half :], word[: self.half])
        group = self.groups.get(half)
        if group is None:
            group = self.groups[half] = Shared()
        group.rests.append(rest)
        group.words.append((n, word))

    def near(self, word: str) -> list[tuple[int, str]]:
        """Words of the shard one edit from this one. Those that share the first half are left to the shard of the first halves."""
        if not self.groups:
            return []
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for half, group in self.groups.items():
                self.automaton.add_word(half, group)
            self.automaton.make_automaton()
        want = self.half - 1 if self.first else len(word) - 1
        for end, group in self.automaton.iter(word):
            if end == want and self.first:
                return group.near(word[self.half :])
            if end == want:
                head = word[: self.half]
                return [x for x in group.near(word[: len(word) - self.size + self.half]) if x[1][: self.half] != head]
        return []


def near_words(words: DataFrame, parts: int, shard: int = SHARD) -> DataFrame:
    """word, n_near, near_n, near: of each word (word, n) that has any, the number of near words and the best of them."""
    size, kinds = F.length("word"), (("p", F.substring("word", 1, ANCHOR)), ("s", F.expr(f"substring(word, -{ANCHOR})")))
    place = lambda kind, d, anchor, role: F.struct(F.lit(kind).alias("kind"), (size + d).alias("size"), anchor.alias("anchor"), F.lit(role).alias("role"))
    key = ["kind", "size", "anchor"]
    held = words.select("word", "n", F.explode(F.array(*(place(k, 0, a, 0) for k, a in kinds))).alias("at")).select("at.*", "word", "n")
    scan = words.select("word", "n", F.explode(F.array(*(place(k, d, a, 1) for k, a in kinds for d in (-1, 0, 1)))).alias("at")).select("at.*", "word", "n").filter(F.col("size") >= LEAST)
    # shards that would be too large are cut by hash; the words that they scan go to each piece
    large = held.groupBy(key).agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > shard).select(*key, F.ceil(F.col("held") / shard).cast("int").alias("pieces"))
    large = settle(large, "large", narrow=True)
    if large.isEmpty():
        held, scan = (rows.withColumn("piece", F.lit(0)) for rows in (held, scan))
    else:
        pieces = F.coalesce("pieces", F.lit(1))
        held = held.join(large, key, "left").withColumn("piece", F.pmod(F.xxhash64("word"), pieces).cast("int"))
        scan = scan.join(large, key, "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    rows = held.select(*key, "piece", "role", "word", "n").unionByName(scan.select(*key, "piece", "role", "word", "n"))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, one, out = None, None, []
        for batch in batches:
            for kind, size, anchor, piece, role, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (kind, size, anchor, piece):
                    now, one = (kind, size, anchor, piece), Shard(kind == "p", size)
                if not role:
                    one.add(word, n)
                elif got := one.near(word):
                    best = min(got, key=lambda x: (-x[0], x[1]))
                    out.append((word, len(got), *best))
                    if len(out) == 20_000:
                        yield table(schema, **{f.name: [r[i] for r in out] for i, f in enumerate(schema)})
                        out = []
        yield table(schema, **{f.name: [r[i] for r in out] for i, f in enumerate(schema)})

    found = rows.repartition(parts, *key, "piece").sortWithinPartitions(*key, "piece", "role").mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.k")).alias("near_n"), "b.near")


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root of each row (word, form), forms followed to the last; each round doubles the way."""
    at = settle(forms.select("word", F.col("form").alias("root")), "roots", narrow=True)
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = settle(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots", narrow=True)
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of all kept words."""
    spark = df.sparkSession
    words = settle(word_counts(texts(df, id_col, text_col)), "words", narrow=True)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    told = F.col("near_n") >= 2 * F.col("n")
    rows = words.join(near_words(words, parts), "word", "left")
    rows = settle(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(told, F.col("near")).alias("form"), F.when(told, F.col("near_n")).alias("form_n")), "forms", narrow=True)
    roots = last_forms(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark, sf_dir) -> DataFrame:
    """Contract query."""
    return spelling_variants(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
