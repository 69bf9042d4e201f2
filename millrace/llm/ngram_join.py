"""N-gram Jaccard join: exact similarity join of n-gram sets, as connected components.

1. Each text's set of n-grams, as pairs of keyed 64-bit hashes (the keys are drawn anew for each call); texts of equal sets, by two digests of the
   two hashes, form a class, whose smallest doc_id stands for it.
2. A sketch of SKETCH counters holds how many texts have an n-gram (or more, where n-grams share a counter). Counter, then hash is the global
   order, rarest first. Its size is fixed; any order gives right results, a rarer beginning gives fewer candidates.
3. A set of n members can only meet the threshold with one that shares one of its first n - ceil(t n) + 1 members (prefix). Only these are
   shuffled; they meet in groups of one n-gram, sorted by set size. Length and position rule out pairs.
4. Groups of up to SMALL members give their pairs; of larger groups each member is paired with a leader of like size only. Members of a prefix
   that no other prefix holds count as differences, which rules out most pairs of edited copies that are no links. Groups over HOT members are
   dealt out to many tasks, whose leaders meet afterwards.
5. Pairs are verified: the sets of a text's partners, in the global order, form a trie (sorted, each with the depth shared with the one before),
   which is walked once; partial overlaps are shared and subtrees that can't reach the threshold by remaining lengths are left. Members are equal
   if both their hashes are. The partners of a text with many are dealt out to tasks of SPLIT partners.
6. In large groups whose members are not all in one component, further leaders are compared with all members of other components, eight times
   as many each round, until every pair of different components has been compared or ruled out: no link is lost. Most are ruled out by parity
   bits: BITS bits a set, of which each member flips one; two sets differ in at least as many members as their bits do.

Null and empty texts have the empty set and link with nothing. Rows that repeat a doc_id count as one document. A null doc_id keeps its row with
a null component. Ties: the smallest doc_id names a component. Extra columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNKS, hashes, maybe_among, mix, parts_of, places, read, settle, shingles, slices, table, texts
from .components import components

SKETCH = 1 << 22
SLICE = 1 << 19  # bytes of text whose sets are built together
ADDED = 1 << 18  # members that are added to it at once
SMALL = 16
STEP = 64
HOT, SPLIT = 1 << 16, 1 << 11
BITS = 512
WORDS = [f"b{k}" for k in range(BITS // 64)]
#: Rows of ids that a task takes, about.
ROWS = 500_000

Keys = tuple[int, int]


def sets_of(docs: list[bytes], n: int, keys: Keys) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text its distinct n-grams, sorted by their first hash, and their second hashes; fewer than n words are one n-gram."""
    doc, start, end, data = places(docs, "space")
    one, two = hashes(data, start, end, keys[0]), hashes(data, start, end, keys[1])
    edge = np.searchsorted(doc, np.arange(len(docs) + 1))
    out = []
    for a, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
        size = max(1, min(n, e - a))
        first, at = np.unique(shingles(one[a:e], size), return_index=True)
        out.append((first, shingles(two[a:e], size)[at]))
    return out


def slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(40)).astype(np.int64) & (SKETCH - 1)


def needed(na, nb, num: int, den: int):
    """Least common members for a Jaccard similarity of num / den."""
    return -(-num * (na + nb) // (num + den))


FIRST = f"doc_id long, n long, s1 long, s2 long, {' long, '.join(WORDS)} long, chunk int, counts binary"


def first_pass(df: DataFrame, n: int, keys: Keys) -> DataFrame:
    """A row for each text (set size, two digests and the parity bits of the set), and each task's part of the sketch."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n", "s1", "s2", *WORDS)] + [("chunk", pa.int32()), ("counts", pa.binary())])

    def parity(two: np.ndarray) -> bytes:
        return np.packbits(np.bincount((two & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint32)
        held, size = [], 0
        for ids, docs in slices(batches, SLICE):
            sets = sets_of(docs, n, keys)
            held += [slot(s) for s, _ in sets]
            size += sum(len(s) for s, _ in sets)
            if size > ADDED:
                np.add.at(counts, np.concatenate(held), np.uint32(1))
                held, size = [], 0
            bits = np.frombuffer(b"".join(parity(two) for _, two in sets), np.int64).reshape(len(sets), len(WORDS))
            yield table(
                schema,
                **dict(zip(WORDS, bits.T)),
                doc_id=ids,
                n=[len(s) for s, _ in sets],
                s1=np.array([mix(s).sum() for s, _ in sets], np.uint64).view(np.int64),
                s2=np.array([mix(s).sum() for _, s in sets], np.uint64).view(np.int64),
                chunk=[None] * len(ids),
                counts=[None] * len(ids),
            )
        if size:
            np.add.at(counts, np.concatenate(held), np.uint32(1))
        if counts.any():
            pack, wide = zstandard.ZstdCompressor(level=1), SKETCH // CHUNKS
            blobs = [pack.compress(np.minimum(counts[k * wide : (k + 1) * wide], 65535).astype("<u2").tobytes()) for k in range(CHUNKS)]
            none = [None] * CHUNKS
            yield table(schema, **dict.fromkeys(("doc_id", "n", "s1", "s2", *WORDS), none), chunk=list(range(CHUNKS)), counts=blobs)

    return df.mapInArrow(run, FIRST)


def whole_sketch(parts: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches, up to 65535: CHUNKS rows of fixed size reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), "<u2").astype(np.uint32)
                total[k] = np.minimum(total[k] + part, 65535) if k in total else part
        for k, v in total.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "counts": pa.array([v.astype("<u2").tobytes()], pa.binary())})

    out, wide = np.zeros(SKETCH, np.uint16), SKETCH // CHUNKS
    for r in parts.filter("chunk is not null").select("chunk", "counts").repartition(12, "chunk").mapInArrow(run, "chunk int, counts binary").collect():
        out[r["chunk"] * wide : (r["chunk"] + 1) * wide] = np.frombuffer(r["counts"], "<u2")
    return out


def prefixes(df: DataFrame, n: int, keys: Keys, num: int, den: int, sketch) -> DataFrame:
    """doc_id, n, prefix (hashes in the global order) of every text that is not empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("prefix", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for ids, docs in slices(batches, SLICE):
            named, sizes, out = [], [], []
            for key, (s, _) in zip(ids, sets_of(docs, n, keys)):
                if len(s) and key is not None:
                    p = len(s) + num * len(s) // -den + 1
                    named.append(key)
                    sizes.append(len(s))
                    out.append(s[np.lexsort((s, counts[slot(s)]))[:p]].tobytes())
            yield table(schema, doc_id=named, n=sizes, prefix=out)

    return df.mapInArrow(run, "doc_id long, n long, prefix binary")


def postings(rows: DataFrame) -> DataFrame:
    """token, doc, n, pos: a row for each member of a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            docs, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            each = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(2)]
            times = [len(x) for x in each]
            if each:
                pos = np.concatenate([np.arange(k) for k in times])
                yield pa.RecordBatch.from_pydict({"token": np.concatenate(each), "doc": np.repeat(docs, times), "n": np.repeat(sizes, times).astype(np.int32), "pos": pos.astype(np.int32)})

    return rows.select("doc_id", "n", "prefix").mapInArrow(run, "token long, doc long, n int, pos int")


POSTING = "token long, doc long, n int, pos int"


def shared_only(rows: DataFrame, parts: int) -> DataFrame:
    """Postings of n-grams that stand in the prefixes of two sets or more. Sorted rows stream by; nothing of a group is kept but its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[pa.RecordBatch, bool] | None = None  # the row before, and whether it has met another of its n-gram
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last[0], batch]).combine_chunks().to_batches()[0]
            token = batch.column(0).to_numpy()
            same = token[1:] == token[:-1]
            keep = np.concatenate(([last is not None and last[1]], same))
            keep[:-1] |= same
            yield batch.slice(0, len(token) - 1).filter(pa.array(keep[:-1]))
            last = (batch.slice(len(token) - 1), bool(keep[-1]))
        if last is not None and last[1]:
            yield last[0]

    return rows.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, POSTING)


def paired(rows: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """Pairs (a < b) that may meet the threshold, of groups (token, salt): all of groups of up to SMALL members, of larger ones each member with a
    leader of like size; and the leaders of groups that are dealt out (a is null).

    u: members of the prefix before the n-gram that no other prefix holds. For two sets that share the n-gram these are in one of them only,
    since a set's prefix holds all that it has up to there: they differ in u + u members at least. Leaders have the smallest u."""

    def possible(na, pa_, ua, nb, pb, ub):
        need, most = needed(na, nb, num, den), min(pa_ - ua, pb - ub) + 1 + min(na - pa_ - 1, nb - pb - 1)
        return min(na, nb) * den >= max(na, nb) * num and most >= need and ua + ub <= na + nb - 2 * need

    names = ("a", "b", "token", "doc", "n", "pos", "u")
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, first, leaders = None, 0, [], []
        out: list[tuple] = []

        def end() -> None:
            for i, x in enumerate(first if seen <= SMALL else ()):
                for y in first[:i]:
                    if x[0] != y[0] and possible(*x[1:], *y[1:]):
                        out.append((min(x[0], y[0]), max(x[0], y[0]), None, None, None, None, None))
            if now and now[1] is not None:  # one of several parts of a group
                out.extend((None, None, now[0], *x) for x in (leaders if seen > SMALL else first))

        def lead(row) -> None:
            for x in leaders:
                if min(x[1], row[1]) * den >= max(x[1], row[1]) * num:
                    if x[0] != row[0] and possible(*x[1:], *row[1:]):
                        out.append((min(x[0], row[0]), max(x[0], row[0]), None, None, None, None, None))
                    return
            leaders.append(row)

        def told() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            for token, salt, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (token, salt) != now:
                    end()
                    now, seen, first, leaders = (token, salt), 0, [], []
                seen += 1
                if seen <= SMALL:
                    first.append(row)
                else:
                    for r in first:
                        lead(r)
                    first = []
                    lead(row)
            yield told()
        end()
        yield told()

    dealt = rows.select("token", "salt", "doc", "n", "pos", "u").repartition(parts, "token", "salt").sortWithinPartitions("token", "salt", "u", "n", "doc")
    return dealt.mapInArrow(run, "a long, b long, token long, doc long, n int, pos int, u int")


def candidates(rows: DataFrame, sizes: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """Pairs (a < b). Groups over HOT members (sizes: token, size of the large ones) are dealt out; the leaders of their parts meet in one group."""
    hot = sizes.filter(F.col("size") > HOT).select("token", F.ceil(F.col("size") / HOT).alias("of"))
    salted = rows.join(hot, "token", "left").withColumn("salt", F.expr("case when of is not null then cast(pmod(xxhash64(doc), of) as int) end"))
    found = settle(paired(salted, num, den, parts), "met", narrow=True)
    pairs = found.filter("a is not null").select("a", "b")
    led = found.filter("a is null").select("token", F.lit(None).cast("int").alias("salt"), "doc", "n", "pos", "u")
    return pairs.union(paired(led, num, den, parts_of(0, rows.sparkSession, ROWS)).filter("a is not null").select("a", "b")).distinct()


class Ordered:
    """A set in the global order."""

    def __init__(self, own: tuple[np.ndarray, np.ndarray], counts: np.ndarray) -> None:
        self.by_hash = own
        count = counts[slot(own[0])]
        order = np.lexsort((own[0], count))
        self.one, self.two, self.count = own[0][order], own[1][order], count[order]

    def __len__(self) -> int:
        return len(self.one)

    def key(self) -> bytes:
        """Sorts as the sequence of its members does."""
        out = np.empty(len(self), [("c", ">u4"), ("h", ">u8")])
        out["c"], out["h"] = self.count, self.one
        return out.tobytes()

    def after(self, count, one) -> int:
        """How many members come after one in the global order."""
        a, e = np.searchsorted(self.count, count, "left"), np.searchsorted(self.count, count, "right")
        return len(self) - int(a) - int(np.searchsorted(self.one[a:e], one, "right"))

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.by_hash[0], one), len(self) - 1)
        return (self.by_hash[0][at] == one) & (self.by_hash[1][at] == two)


def tree_links(own: Ordered, others: list[Ordered], num: int, den: int) -> list[bool]:
    """Which of the others meet the threshold with own. In lexicographic order each shares its beginning with the one before: the path of a trie,
    whose overlaps with own are kept and not counted again."""
    order = sorted(range(len(others)), key=[x.key() for x in others].__getitem__)
    out = [False] * len(others)
    path = np.zeros(1, np.int64)  # overlap of the first d members
    before, known = None, 0
    for i in order:
        x, d = others[i], 0
        if before is not None:
            m = min(known, len(x))
            differ = np.flatnonzero((before.one[:m] != x.one[:m]) | (before.two[:m] != x.two[:m]))
            d = int(differ[0]) if len(differ) else m
        path, need = path[: d + 1], needed(len(own), len(x), num, den)
        while True:
            rest = own.after(x.count[d - 1], x.one[d - 1]) if d else len(own)
            if path[d] + min(len(x) - d, rest) < need:
                break
            if d == len(x):
                out[i] = True
                break
            path = np.concatenate((path, path[d] + np.cumsum(own.holds(x.one[d : d + STEP], x.two[d : d + STEP]))))
            d = min(len(x), d + STEP)
        before, known = x, d
    return out


def verified(pairs: DataFrame, df: DataFrame, n: int, keys: Keys, num: int, den: int, sketch) -> DataFrame:
    """Links (u, v): those of the pairs (a, b) that meet the threshold. Of a pair, the text with more partners is the hub: its text is sent once to
    each task that takes up to SPLIT of its partners. Texts that no pair names are left out before the shuffle."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    some = df.filter(F.col("doc_id").isNotNull()).filter(maybe_among(F.col("doc_id"), ids)).select("doc_id", "text")
    degree = ids.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    of = lambda c: degree.select(F.col("id").alias(c), F.col("k").alias(f"k_{c}"))
    hub = F.col("k_a") >= F.col("k_b")
    edges = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    edges = edges.select(F.when(hub, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(hub, F.col("b")).otherwise(F.col("a")).alias("leaf"), F.ceil(F.greatest("k_a", "k_b") / SPLIT).alias("of"))
    edges = settle(edges.withColumn("salt", F.expr("pmod(xxhash64(leaf), of)")), "edges", narrow=True)
    leaves = edges.join(some.withColumnRenamed("doc_id", "leaf"), "leaf").select("hub", "salt", F.lit(1).alias("kind"), "leaf", "text")
    hubs = edges.select("hub", "salt").distinct().join(some.withColumnRenamed("doc_id", "hub"), "hub").select("hub", "salt", F.lit(0).alias("kind"), F.col("hub").alias("leaf"), "text")
    parts = parts_of(edges.count(), df.sparkSession, 10_000)
    rows = hubs.unionByName(leaves).repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", "kind", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        own, hub_id, names, sets = None, None, [], []

        def links() -> pa.RecordBatch:
            hits = [v for v, ok in zip(names, tree_links(own, sets, num, den)) if ok] if sets and len(own) else []
            hub_ids = [hub_id] * len(hits)
            names.clear()
            sets.clear()
            return pa.RecordBatch.from_pydict({"u": pa.array(hub_ids, pa.int64()), "v": pa.array(hits, pa.int64())})

        for batch in batches:
            kinds, at = batch.column(2).to_pylist(), 0
            for ids_, docs in slices([batch.select([3, 4])], SLICE):
                for key, one, kind in zip(ids_, sets_of(docs, n, keys), kinds[at : at + len(ids_)]):
                    if kind == 0:
                        yield links()
                        own, hub_id = Ordered(one, counts), key
                    elif len(one[0]):
                        names.append(key)
                        sets.append(Ordered(one, counts))
                at += len(ids_)
                yield links()

    return rows.mapInArrow(run, "u long, v long")


def ngram_components(df: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row: documents link at a Jaccard similarity of num / den or more."""
    spark = df.sparkSession
    df = texts(df, id_col, text_col)
    keys = (random.SystemRandom().getrandbits(64), random.SystemRandom().getrandbits(64))
    first = settle(first_pass(df, n, keys), "sets")
    rows = first.filter("chunk is null").drop("chunk", "counts")
    full = rows.filter("n > 0 and doc_id is not null")
    classes = settle(full.groupBy("s1", "s2", F.col("n").alias("m")).agg(F.min("doc_id").alias("rep")), "classes", narrow=True)
    sketch = spark.sparkContext.broadcast(whole_sketch(first))
    own = prefixes(df, n, keys, num, den, sketch).join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    shared = settle(shared_only(postings(own), parts), "postings", narrow=True)
    met_before = F.row_number().over(Window.partitionBy("doc").orderBy("pos")) - 1  # of one prefix
    shared = settle(shared.withColumn("u", F.col("pos") - met_before), "shared", narrow=True)
    of_token = settle(shared.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("u").alias("least")).filter(f"size > {SMALL}"), "sizes", narrow=True)
    pairs = settle(candidates(shared, of_token, num, den, parts_of(shared.count(), spark, ROWS)), "pairs", narrow=True)
    links = settle(verified(pairs, df, n, keys, num, den, sketch), "verified", narrow=True)
    labels = settle(components(links), "labels", narrow=True)
    # members that differ too much from any partner, by what only they hold, are done
    large = shared.join(of_token, "token").filter(f"(u + least) * {num} <= n * {den - num}").drop("size", "least")
    large = settle(large.join(full.select(F.col("doc_id").alias("doc"), *WORDS).groupBy("doc").agg(*(F.first(c).alias(c) for c in WORDS)), "doc"), "large", narrow=True)
    differ = " + ".join(f"bit_count({c} ^ {c}_)" for c in WORDS)

    done, more = 0, 8
    order = Window.partitionBy("token").orderBy("u", "n", "doc")
    place = lambda tail: F.struct(*(F.col(c + tail) for c in ("u", "n", "doc")))
    while True:
        named = large.join(labels.select(F.col("node").alias("doc"), "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
        mixed = named.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size")).filter(f"x <> y and size > {done + 1}").select("token")
        left = settle(named.join(mixed, "token", "left_semi"), "mixed", narrow=True)
        if left.isEmpty():
            break
        leaders = left.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= done + more).filter(F.col("k") > done)
        leaders = leaders.select("token", *(F.col(c).alias(f"{c}_") for c in ("doc", "n", "pos", "u", "label", *WORDS)))
        met = left.join(leaders, "token").filter("label <> label_").filter(place("") > place("_"))
        met = met.filter(f"least(n, n_) * {den} >= greatest(n, n_) * {num} and (u + u_) * {num + den} <= (n + n_) * {den - num}")
        met = met.filter(f"(least(pos - u, pos_ - u_) + 1 + least(n - pos - 1, n_ - pos_ - 1)) * {num + den} >= {num} * (n + n_)")
        met = met.filter(f"({differ}) * {num + den} <= (n + n_) * {den - num}")
        new = settle(met.select(F.least("doc", "doc_").alias("a"), F.greatest("doc", "doc_").alias("b")).distinct(), "pairs", narrow=True)
        links = links.union(settle(verified(new, df, n, keys, num, den, sketch), "verified", narrow=True))
        labels = settle(components(links), "labels", narrow=True)
        done, more = done + more, 8 * more
    sketch.unpersist()

    named = full.join(classes, (full.s1 == classes.s1) & (full.s2 == classes.s2) & (full.n == classes.m)).select("doc_id", "n", "rep")
    named = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))
    alone = rows.filter("not (n > 0 and doc_id is not null)").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.unionByName(alone)


def op7_ngram_jaccard(spark, sf_dir) -> DataFrame:
    """Contract query: 3-word shingles, similarity 0.9."""
    return ngram_components(read(spark, sf_dir, "documents"), n=3, num=90, den=100)
