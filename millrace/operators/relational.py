"""Joins, keyed choices and set aggregates that the plans share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.urls import suffixes


def last_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the last by a unique order. Aggregates before the shuffle, so a hot key sends one row from each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, *(F.col("__row")[c].alias(c) for c in rest))


def first_n(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The n first distinct keys by their first row, that row each."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    rows = first.select(*keys, *(F.col("__row")[c].alias(c) for c in rest))
    return rows.orderBy(*order).limit(n)


def matches_suffix(df: DataFrame, host: str, hosts: DataFrame, how: str) -> DataFrame:
    """left_semi: rows whose host equals or is below one of the hosts (column `host`); left_anti: the others. An equi-join on exploded suffixes."""
    keyed = df.withColumn("__row", F.monotonically_increasing_id())
    found = keyed.select("__row", F.explode(suffixes(F.col(host))).alias("__suffix")).join(hosts.select(F.col("host").alias("__suffix")).distinct(), "__suffix", "left_semi")
    return keyed.join(found.select("__row").distinct(), "__row", how).drop("__row")


def hosts_within(hosts: DataFrame, allow: DataFrame | None, deny: DataFrame) -> DataFrame:
    """Distinct hosts (column `host`) that may be crawled: not denied, and allowed if there is an allow list. Hosts are unique, so no row key is needed."""
    below = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("s"))
    denied = below.join(deny.select(F.col("host").alias("s")).distinct(), "s", "left_semi").select("host").distinct()
    out = hosts.filter("host <> ''").join(denied, "host", "left_anti")
    if allow is None:
        return out
    allowed = below.join(allow.select(F.col("host").alias("s")).distinct(), "s", "left_semi").select("host").distinct()
    return out.join(allowed, "host", "left_semi")


def bridge(discovered: DataFrame, known: DataFrame) -> DataFrame:
    """domain, bridge_status, matched: equal to a known domain, else the smallest known domain above or below it, else new (or a rebrand, for http redirects)."""
    known = known.select("host").distinct()
    up = discovered.select("domain", F.explode(suffixes(F.col("domain"))).alias("host")).filter("host <> domain").join(known, "host").select("domain", F.col("host").alias("other"))
    down = known.select(F.col("host").alias("other"), F.explode(suffixes(F.col("host"))).alias("domain")).filter("other <> domain").join(discovered.select("domain"), "domain").select("domain", "other")
    near = up.unionByName(down).groupBy("domain").agg(F.min("other").alias("matched"))
    same = known.select(F.col("host").alias("domain"), F.lit(True).alias("same"))
    status = F.when(F.col("same"), "already_known").when(F.col("matched").isNotNull(), "possible_same_cluster").when(F.col("discovery_type") == "http_redirect", "possible_rebrand").otherwise("net_new")
    return discovered.join(same, "domain", "left").join(near, "domain", "left").select("domain", status.alias("bridge_status"), F.when(F.col("same").isNull(), F.col("matched")).alias("matched"))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The k first rows by a unique order."""
    return df.orderBy(*order).limit(k)


#: Links that one task unites in memory, at most.
LINKS = 400_000


def contracted(links: DataFrame) -> DataFrame:
    """u, v: each vertex of the links (u, v) that a task sees, and the smallest one that the task finds linked to it. Every LINKS links are united for themselves."""
    schema = pa.schema([("u", pa.string()), ("v", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[str, str] = {}

        def root(x: str) -> str:
            top = x
            while (t := up.get(top, top)) != top:
                top = t
            while (t := up.get(x, x)) != top:
                up[x], x = top, t
            return top

        def flush() -> Iterator[pa.RecordBatch]:
            below = [x for x in up if root(x) != x]
            for i in range(0, len(below), 50_000):
                part = below[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([root(x) for x in part], pa.string())], schema=schema)
            up.clear()

        n = 0
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
            n += batch.num_rows
            if n >= LINKS:
                yield from flush()
                n = 0
        yield from flush()

    return links.select("u", "v").mapInArrow(run, "u string, v string")


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links u > v."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.u", "e.v").filter("u <> v").distinct()


def components_by_key(rows: DataFrame, node: str, keys: list[Column]) -> DataFrame:
    """node, label of each node (a string) that isn't the smallest of its group: rows that share a value of any key column (null: none) are one group.

    Nodes and keys are the vertices, at most one link a row and key: never pairs within a group. Each task unites the links that it reads, so that a hot key sends one link
    from each; what is left is united in one task if it is at most LINKS links, else by rounds of stars, each written, until it is. Nodes sort before keys."""
    links = rows.select(F.concat(F.lit("0"), F.col(node)).alias("v"), F.explode(F.array_compact(F.array(*keys))).alias("k")).select(F.concat(F.lit("1"), "k").alias("u"), "v")
    left = settled(contracted(links), "links")
    while left.count() > LINKS:
        new = settled(_stars(left), "links")
        if new.groupBy("u").count().filter("count > 1").isEmpty() and new.select("v").join(new.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            left = new
            break
        left = settled(contracted(new.repartition("u")), "links")
    else:
        left = contracted(left.coalesce(1))
    return left.filter(F.col("u").startswith("0")).select(F.substring("u", 2, 1 << 30).alias(node), F.substring("v", 2, 1 << 30).alias("label"))


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Rows with their place (from 0) in a unique order: sorted by ranges, counted by range, so that no task sees all rows. The driver gets one count a range."""
    rows = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__id", 33)
    before, offsets = 0, []
    for p, n in sorted((r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
        offsets.append((p, before))
        before += n
    first = df.sparkSession.createDataFrame(offsets, "__part long, __first long")
    rows = rows.join(F.broadcast(first), part == F.col("__part"))  # a row a range
    return rows.withColumn(name, F.col("__first") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id", "__part", "__first")


def pick(df: DataFrame, *names: str) -> Column:
    """The first of these columns that there is, whatever its case, stripped; '' if there is none or it is null."""
    have = {c.lower(): c for c in reversed(df.columns)}
    for n in names:
        if n.lower() in have:
            return F.coalesce(strip(F.col(f"`{have[n.lower()]}`").cast("string")), F.lit(""))
    return F.lit("")


def shared_root(spark) -> str:
    """The folder that the driver and all executors see; one of our own on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """Written to the shared folder and read back: the plan runs once, its lineage is cut, and it survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
