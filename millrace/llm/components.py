"""Connected components of links, for any number of links.

Links are first contracted in tasks of at most CHUNK links each (union-find in memory), then by rounds of large-star and small-star joins
until nothing changes. Every round is written to the shared folder, which cuts lineage. A node's label is the smallest node it can reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, table

CHUNK = 1_000_000


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (t := up.get(top, top)) != top:
            top = t
        while (t := up.get(x, x)) != top:
            up[x], x = top, t
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = sorted((self.root(a), self.root(b)))
        if a == b:
            return False
        self.up.setdefault(a, a)
        self.up[b] = a
        return True


def _contracted(links: DataFrame, parts: int, key: str) -> DataFrame:
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.join(a, b)
        nodes = [x for x in forest.up if forest.root(x) != x]
        for i in range(0, len(nodes), 100_000):
            part = nodes[i : i + 100_000]
            yield table(schema, u=part, v=[forest.root(x) for x in part])

    return links.select("u", "v").repartition(parts, key).mapInArrow(run, "u long, v long")


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star; edges u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.u", "e.v").filter("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one root and no root has another."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return edges.select("v").join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, label for every node that is not its own label. links: columns u, v."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    n = links.count()
    edges = settle(_contracted(links, n // CHUNK + 1, "u"), "links", narrow=True)
    while not _settled(edges):
        edges = settle(_stars(edges), "links", narrow=True)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
