"""Stages against brute force on their own inputs."""

import re

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.common import read
from tests.llm.test_operators import brute_components, brute_secrets


def test_stages(spark, data):
    docs = read(spark, data, "documents")
    columns = docs.columns
    extra = spark.createDataFrame([(9001, "!! 123", "en", "s", 6), (9002, None, None, "s", 0), (9003, None, "fr", None, None)], docs.schema)
    before = docs.unionByName(extra)

    kept = corpus_pipeline.language_id(spark, before, data)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    lettered = {r["doc_id"] for r in before.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert kept.columns == columns and ids(kept) <= lettered and len(ids(kept)) > 0.98 * len(lettered)

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    copies = corpus_pipeline.near_copies(spark, kept, data)
    want = {k for k, (_, c) in brute_components(rows, 5, 80).items() if c == k}
    assert copies.columns == columns and ids(copies) == want

    items = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in read(spark, data, "benchmark").collect()]
    clean = corpus_pipeline.benchmark_passages(spark, copies, data)
    whole = {r["doc_id"] for r in copies.collect() if any(f" {i} " in f" {' '.join(re.findall(r'[^\W_]+', r['text'].lower()))} " for i in items)}
    assert whole and clean.columns == columns and not ids(clean) & whole and len(ids(copies)) - len(ids(clean)) <= len(whole) + 1

    redacted = corpus_pipeline.secret_scan(spark, clean, data)
    old = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in redacted.collect():
        assert not brute_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        assert (r["text"] == old[r["doc_id"]]) == (not brute_secrets(old[r["doc_id"]]))
    assert redacted.columns == columns and ids(redacted) == ids(clean)

    out = corpus_pipeline.token_ids(spark, redacted, data)
    want = redacted.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    assert out.join(want, "doc_id").filter("h = decoded_sha256").count() == redacted.count() == out.count()


def test_rows_that_share_an_id(spark, data):
    """Each row is judged by itself: no row goes because of another of its id, and of equal rows one stays."""
    item = next(r["text"] for r in read(spark, data, "benchmark").collect())
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, words(1)), (1, words(1)), (1, words(2)), (2, words(2)), (3, f"{words(3)} {item}"), (3, words(4)), (None, words(5)), (None, words(6)), (None, words(6)), (7, None), (7, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    copies = corpus_pipeline.near_copies(spark, docs, data)
    assert copies.columns == docs.columns
    texts = sorted(r["text"] or "" for r in copies.collect())
    assert texts == sorted(["", "", words(1), words(2), f"{words(3)} {item}", words(4), words(5), words(6)])
    clean = corpus_pipeline.benchmark_passages(spark, docs, data)
    assert clean.columns == docs.columns and sorted(r["text"] or "" for r in clean.collect()) == sorted(t or "" for _, t in rows if item not in (t or ""))


def test_run_and_empty(spark, data, tmp_path):
    assert corpus_pipeline.run(spark, data).count() > 0
    for t in ("documents", "benchmark"):
        read(spark, data, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert public_tokenizers.PATTERN
