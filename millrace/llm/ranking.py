"""Quality classifier: a Bradley-Terry score learned from preference pairs, cut at a quantile of the scores.

A text is described by features of its whole bytes (`features`): shares of pairs of byte classes and of single symbols, repeated and distinct words,
lengths. A pair prefers a text of label 1 to one of label 0; the probability of that is the logistic function of the difference of their
scores, which are linear in the features, so the weights are those of a logistic regression without intercept on feature differences (fitted by Spark
over the pairs, each in one of both directions by turns).

Pairs come from all labelled rows (`most` bounds them, by hash of id and text, only where a caller asks for it). Each row of the larger class
is dealt PARTNERS slots by hash, rows of the smaller class one; rows that meet in a slot are a pair. As there are as many slots as rows of the smaller
class, pairs are about PARTNERS a row. The threshold is the quantile of the labelled rows' scores at which the shares of wrongly cut rows of both classes
have the least sum, in the middle of the gap there, found over ranges of sorted scores; a text at that quantile has the score CUT (0.3), and scores
follow as the logistic function of the distance to it, rounded to 9 decimals.

Null texts are empty, empty texts have a score like all others. Training rows that are repeated (id, text and label) count once, labels but 0 and 1 not at
all; an id with both labels counts in both classes. Without rows of both classes every score is 0.5. Rows that repeat an id, or have none, are scored
each by itself. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hashes, places, read, settle, slices, table, texts

#: Pairs of each row of the larger class.
PARTNERS = 4
CUT = 0.3
L2 = 1e-4

_SYMBOLS = [c for c in range(33, 127) if not chr(c).isalnum()]
_KIND = np.full(256, 7, np.uint8)  # 0 lower, 1 upper case, 2 digits, 3 space, 4 control, 5 beyond ASCII, 6 marks of a sentence, 7 other symbols
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[32], _KIND[:32], _KIND[128:] = 0, 1, 2, 3, 4, 5
_KIND[[ord(c) for c in ".,;:?'\"()-"]] = 6
_SLOT = np.full(256, len(_SYMBOLS), np.int64)
_SLOT[_SYMBOLS] = np.arange(len(_SYMBOLS))
N_FEATURES = 64 + len(_SYMBOLS) + 5


def features(docs: list[bytes]) -> np.ndarray:
    """A row of N_FEATURES numbers for each text; zeros if it is empty."""
    n, sizes = len(docs), np.array([len(d) for d in docs])
    out, some = np.zeros((n, N_FEATURES)), np.maximum(sizes, 1)
    data = np.frombuffer(b"".join(docs), np.uint8)
    doc = np.repeat(np.arange(n), sizes)
    if len(data):
        kind, inside = _KIND[data].astype(np.int64), doc[1:] == doc[:-1]
        pair = (doc[1:] * 64 + kind[:-1] * 8 + kind[1:])[inside]
        out[:, :64] = np.sqrt(np.bincount(pair, minlength=64 * n).reshape(n, 64) / some[:, None])
        wide = len(_SYMBOLS) + 1
        out[:, 64 : 63 + wide] = np.sqrt(np.bincount(doc * wide + _SLOT[data], minlength=wide * n).reshape(n, wide)[:, :-1] / some[:, None])
    who, start, end, lower = places(docs, "space")
    if len(who):
        word = hashes(lower, start, end)
        words = np.bincount(who, minlength=n)
        again = (word[1:] == word[:-1]) & (who[1:] == who[:-1])
        order = np.lexsort((word, who))
        fresh = np.concatenate(([True], (word[order][1:] != word[order][:-1]) | (who[order][1:] != who[order][:-1])))
        each = np.maximum(words, 1)
        out[:, -5] = np.bincount(who[1:][again], minlength=n) / each
        out[:, -4] = np.bincount(who[order][fresh], minlength=n) / each
        out[:, -3] = np.log1p(words)
        out[:, -2] = np.log1p(np.bincount(who, weights=end - start, minlength=n) / each)
        same = np.concatenate(([False], (data[1:] == data[:-1]) & (doc[1:] == doc[:-1])))
        out[:, -1] = np.bincount(doc[same], minlength=n) / some
    return out


def described(df: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), f (features) of each row (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("f", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, docs in slices([batch.select([0, 1])], keep=""):
                f = features(docs).astype(np.float32)
                offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * N_FEATURES)
                yield table(schema, doc_id=ids, h=batch.column(2).slice(done, len(ids)), f=pa.ListArray.from_arrays(offsets, pa.array(f.ravel())))
                done += len(ids)

    return df.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(run, "doc_id long, h long, f array<float>")


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About `most` of the rows (doc_id, h, y), all if there are no more, by hash."""
    n = rows.count()
    return rows if n <= most else rows.filter(F.pmod(F.xxhash64("doc_id", "h", F.lit(0)), F.lit(1 << 30)) < int((1 << 30) * most / n))


def preference_pairs(sample: DataFrame, ones: int, zeros: int, partners: int = PARTNERS) -> DataFrame:
    """y, x: differences of features, half of them of the better text to the worse (1), half the other way round (0)."""
    larger = int(ones >= zeros)
    slots = F.lit(min(ones, zeros))
    many = sample.filter(F.col("y") == larger).select("f", F.explode(F.array(*(F.struct(F.lit(r).alias("turn"), F.pmod(F.xxhash64("doc_id", "h", F.lit(r + 1)), slots).alias("slot")) for r in range(partners)))).alias("s"))
    few = sample.filter(F.col("y") == 1 - larger).select(F.col("f").alias("g"), F.pmod(F.xxhash64("doc_id", "h"), slots).alias("slot"))
    # the same text with both labels says nothing, but neither does it harm: its difference is zero
    pairs = many.select("f", "s.turn", "s.slot").join(few, "slot")
    sign = F.when(F.col("turn") % 2 == larger, 1.0).otherwise(-1.0)
    difference = F.zip_with("f", "g", lambda a, b: (a - b).cast("double") * sign)
    return pairs.select(F.when(F.col("turn") % 2 == 1, 1.0).otherwise(0.0).alias("y"), array_to_vector(difference).alias("x"))


def best_cut(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(threshold, quantile): where the share of ones below and that of zeros at or above it have the least sum; of several such places, the widest gap."""
    order = np.argsort(score, kind="stable")
    score, y = score[order], y[order]
    lost = np.concatenate(([0], np.cumsum(y == 1))) / max(1, (y == 1).sum())
    left = 1 - np.concatenate(([0], np.cumsum(y == 0))) / max(1, (y == 0).sum())
    edges = np.concatenate(([score[0] - 1], score, [score[-1] + 1]))
    gap = edges[1:] - edges[:-1]
    cost = np.where(gap > 0, lost + left, np.inf)
    k = int(np.lexsort((-gap, np.round(cost, 12)))[0])
    return float((edges[k] + edges[k + 1]) / 2), k / len(score)


def best_cut_by_ranges(scores: DataFrame) -> tuple[float, float]:
    """best_cut of a table (s, y; y 0 or 1, one row at least): scores are sorted by ranges, the driver gets one row a range."""
    marks = scores.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("ones"), F.count_if(F.col("y") == 0).alias("zeros"))
    rows = settle(marks.repartitionByRange("s").sortWithinPartitions("s").withColumn("part", F.spark_partition_id()), "scores", narrow=True)
    parts = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("s"), F.max("s"), F.sum("ones"), F.sum("zeros")).collect())
    ones, zeros = sum(p[3] for p in parts), sum(p[4] for p in parts)
    before, last, n1, n0 = [], parts[0][1] - 1, 0, 0  # of each range: the score, the ones and the zeros before it
    for part, _, high, more1, more0 in parts:
        before.append((part, last, n1, n0))
        last, n1, n0 = high, n1 + more1, n0 + more0
    w = Window.partitionBy("part").orderBy("s")
    up_to = lambda c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = rows.select("part", "s", F.lag("s").over(w).alias("low"), up_to("ones").alias("n1"), up_to("zeros").alias("n0"))
    first = scores.sparkSession.createDataFrame(before, "part int, last double, b1 long, b0 long")  # a row a range
    cuts = cuts.join(F.broadcast(first), "part").select("s", F.coalesce("low", "last").alias("low"), (F.col("n1") + F.col("b1")).alias("n1"), (F.col("n0") + F.col("b0")).alias("n0"))
    cost = F.round(F.col("n1") / float(max(1, ones)) + (1 - F.col("n0") / float(max(1, zeros))), 12)
    # right below a score, or above all
    best = cuts.agg(F.min(F.struct(cost.alias("cost"), (F.col("low") - F.col("s")).alias("gap"), (F.col("n1") + F.col("n0")).alias("k"), ((F.col("low") + F.col("s")) / 2).alias("at"))).alias("b")).first()["b"]
    above = (round(ones / max(1, ones) + (1 - zeros / max(1, zeros)), 12), -1.0, ones + zeros, last + 0.5)
    _, _, k, at = min(tuple(best), above)
    return float(at), k / (ones + zeros)


class Ranking:
    """Weights, threshold and its quantile; weights are None if there was nothing to learn from."""

    def __init__(self, weights: np.ndarray | None = None, threshold: float = 0.0, quantile: float = 0.0) -> None:
        self.weights, self.threshold, self.quantile = weights, threshold, quantile

    def raw(self, f: Column) -> Column:
        """The Bradley-Terry score."""
        w = F.array(*(F.lit(float(x)) for x in self.weights))
        return F.aggregate(F.zip_with(f, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)

    def score(self, f: Column) -> Column:
        if self.weights is None:
            return F.lit(0.5)
        at = self.raw(f) - self.threshold + float(np.log(CUT / (1 - CUT)))
        return F.round(1 / (1 + F.exp(-at)), 9)


def fit(rows: DataFrame, labels: DataFrame, most: int | None = None) -> Ranking:
    """rows: doc_id, h, f of the texts that may be learned from; labels: doc_id, y. Learned from all rows, from about `most` only if that is given."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y")).filter("y in (0, 1)").distinct()
    taught = rows.join(marked, "doc_id").dropDuplicates(["doc_id", "h", "y"])
    taught = settle(taught if most is None else sampled(taught, most), "taught")
    count = {r["y"]: r["n"] for r in taught.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return Ranking()
    pairs = settle(preference_pairs(taught, count[1], count[0]), "pairs")
    if pairs.isEmpty():
        return Ranking()
    model = LogisticRegression(featuresCol="x", labelCol="y", fitIntercept=False, regParam=L2, maxIter=60, tol=1e-7).fit(pairs)
    out = Ranking(model.coefficients.toArray())
    out.threshold, out.quantile = best_cut_by_ranges(taught.select(out.raw(F.col("f")).alias("s"), "y"))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(df: DataFrame, labels: DataFrame, teach: Column, most: int | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, score, predicted, quantile (that of the threshold) of every row; learned from rows where `teach` (a condition on doc_id) holds."""
    rows = settle(described(texts(df, id_col, text_col)), "features")
    ranking = fit(rows.filter(teach), labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")), most)
    score = ranking.score(F.col("f"))
    return rows.select("doc_id", score.alias("score"), (score >= CUT).cast("int").alias("predicted"), F.lit(ranking.quantile).alias("quantile"))


def op12_quality_ranking(spark, sf_dir) -> DataFrame:
    """Contract query: learned from the rows that are not held out, scored for all."""
    out = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
