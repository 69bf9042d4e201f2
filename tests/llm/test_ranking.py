"""Quality ranking: accuracy on held-out rows, features and thresholds against plain computations, odd tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ranking
from millrace.llm.common import read
from millrace.llm.queries import QUERIES


def rows(df):
    return [r.asDict(True) for r in df.collect()]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    out = rows(QUERIES["op12_quality_ranking"](spark, sf))
    docs = read(spark, sf, "documents")
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    label = {r["doc_id"]: r["quality"] for r in read(spark, sf, "labels").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    test = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, _, y in test if y], [s for s, _, y in test if not y]
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([p == y for _, p, y in test]) > 0.97
    assert min(np.mean([p == y for _, p, y in test if y == v]) for v in (0, 1)) > 0.9


def test_held_out_rows_teach_nothing(spark):
    """Other labels of the rows that are held out change no score."""
    sf = "/root/testdata/sf0.001"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    teach = ~ranking.held_out(F.col("doc_id"))
    other = labels.withColumn("quality", F.when(teach, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (sorted((r["doc_id"], round(r["score"], 6)) for r in rows(ranking.quality_scores(docs, x, teach))) for x in (labels, other))
    assert a == b


def test_features():
    docs = [b"", b"ab AB 12!!", "é é x\n".encode(), b"same same same other", b" \n\t"]
    f = ranking.features(docs)
    assert f.shape == (5, ranking.N_FEATURES) and not f[0].any() and np.isfinite(f).all()
    kind = lambda c: 0 if 97 <= c < 123 else 1 if 65 <= c < 91 else 2 if 48 <= c < 58 else 3 if c == 32 else 4 if c < 32 else 5 if c >= 128 else 6 if chr(c) in ".,;:?'\"()-" else 7
    for d, x in zip(docs, f):
        pairs = Counter(kind(a) * 8 + kind(b) for a, b in zip(d, d[1:]))
        assert np.allclose(x[:64], [np.sqrt(pairs[k] / max(1, len(d))) for k in range(64)])
        words = d.lower().split()
        assert np.isclose(x[-5], sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)))
        assert np.isclose(x[-4], len(set(words)) / max(1, len(words))) and np.isclose(x[-3], np.log1p(len(words)))
        assert np.isclose(x[-1], sum(a == b for a, b in zip(d, d[1:])) / max(1, len(d)))
    whole = ranking.features(docs[::-1])[::-1]
    assert np.array_equal(whole, f)  # a text's features don't depend on its slice


def test_best_cut():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 50):
        for _ in range(40):
            score, y = rng.integers(0, 12, n) / 2, rng.integers(0, 2, n)
            t, q = ranking.best_cut(score, y)
            cost = lambda t: np.mean(score[y == 1] < t) * (y == 1).any() + (np.mean(score[y == 0] >= t) if (y == 0).any() else 0)
            with np.errstate(all="ignore"):
                assert np.isclose(np.nan_to_num(cost(t)), min(np.nan_to_num(cost(u)) for u in np.arange(-0.75, 7.5, 0.5)))
            assert q == np.mean(score < t)


def test_pairs(spark):
    f = lambda k: [float(k)] * 3
    sample = spark.createDataFrame([(k, k * 7, int(k % 5 > 0), f(k)) for k in range(500)], "doc_id long, h long, y int, f array<float>")
    for flip in (0, 1):
        side = sample.withColumn("y", F.col("y") if flip else 1 - F.col("y"))
        ones = side.filter("y = 1").count()
        pairs = [(r["y"], r["x"].toArray()) for r in ranking.preference_pairs(side, ones, 500 - ones).collect()]
        assert 1200 < len(pairs) < 2100 and 0.4 < np.mean([y for y, _ in pairs]) < 0.6
        for y, x in pairs:  # ids of the class that k % 5 = 0 marks differ from the others by no multiple of five
            assert int(x[0]) % 5 and len(set(x)) == 1


def test_direction(spark):
    docs = spark.createDataFrame([(k, "good words stand here. " * (1 + k % 4) if k % 2 else "#### $$ " * (1 + k % 4)) for k in range(200)], "doc_id long, text string")
    for good in (1, 0):
        labels = spark.createDataFrame([(k, k % 2 if good else 1 - k % 2) for k in range(0, 200, 3)], "doc_id long, quality int")
        got = {r["doc_id"]: r for r in rows(ranking.quality_scores(docs, labels, F.lit(True)))}
        assert all(got[k]["predicted"] == (k % 2 if good else 1 - k % 2) for k in range(200))
        assert all(0 < r["quantile"] < 1 for r in got.values())


def test_odd_tables(spark):
    long = "A word. " * 400_000  # above 2 MiB
    docs = [(1, None), (2, ""), (3, " "), (4, "x y z"), (4, "x y z"), (4, "x y z"), (4, "other"), (None, "x y z"), (5, long), (6, "$$$ ###")]
    df = spark.createDataFrame([(k, t, 7, "q", 1.0) for k, t in docs], "doc_id long, text string, h int, f string, score double")
    marks = lambda x: spark.createDataFrame([(k, y, 0) for k, y in x], "doc_id long, quality int, y int")
    for x in ([], [(4, 1)], [(6, 0)], [(4, None), (6, 5)]):
        assert [r["score"] for r in rows(ranking.quality_scores(df, marks(x), F.lit(True)))] == [0.5] * len(docs)
    both = marks([(4, 1), (4, 1), (4, 0), (6, 0), (5, 1), (None, 0), (99, 1), (2, 0)])
    out = rows(ranking.quality_scores(df, both, F.lit(True)))
    assert Counter(r["doc_id"] for r in out) == Counter(k for k, _ in docs)
    assert len({r["score"] for r in out if r["doc_id"] == 4}) == 2 and all(0 <= r["score"] <= 1 for r in out)
    assert next(r["score"] for r in out if r["doc_id"] is None) in {r["score"] for r in out if r["doc_id"] == 4}


@pytest.mark.parametrize("most", [60, 200])
def test_bounded_sample(spark, most):
    marked = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") * 3).alias("h"), (F.col("id") % 2).cast("int").alias("y"))
    got = ranking.sampled(marked, most)
    assert most / 2 < got.count() < 2 * most
    assert got.repartition(3).orderBy("doc_id").collect() == ranking.sampled(marked.repartition(11), most).orderBy("doc_id").collect()


def test_empty(spark, data, tmp_path):
    for t in ("documents", "labels"):
        read(spark, data, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES["op12_quality_ranking"](spark, str(tmp_path)).count() == 0


def test_words_of_a_hot_source(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs = [(k, " ".join(word() for _ in range(40))) for k in range(60)] + [(k, word() + (" again" * 40)) for k in range(60, 80)]
    docs += [(100 + k, docs[3][1]) for k in range(300)]  # copies
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 60 or k >= 100)) for k, _ in docs if k % 3], "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in rows(ranking.quality_scores(df, labels, F.lit(True)))}
    assert all(p == int(k < 60 or k >= 100) for k, p in got.items())


def test_best_cut_by_ranges(spark):
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 300):
        for _ in range(3):
            score, y = rng.integers(0, 40, n) / 4, rng.integers(0, 2, n)
            said = spark.createDataFrame([(float(a), int(b)) for a, b in zip(score, y)], "s double, y int").repartition(5)
            assert np.allclose(ranking.best_cut_by_ranges(said), ranking.best_cut(score, y))


def test_all_labelled_rows_teach(spark):
    """More rows than any bound on a sample: the threshold's quantile is that of all of them."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") * 3).alias("h"), F.array((F.col("id") >= 7001).cast("float"), (F.col("id") % 11).cast("float")).alias("f"))
    labels = rows.select("doc_id", (F.col("doc_id") >= 7001).cast("int").alias("y"))
    assert ranking.fit(rows, labels).quantile == 7001 / 60_000
