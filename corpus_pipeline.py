"""A corpus in five stages: language ID, near copies, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the last returns ids. Its result is written as
Parquet to the shared folder and read again as the next one's docs.

Null and empty texts go in the first stage, as they have no letter; the other stages, given such texts, keep them: they are near nothing, hold no benchmark item and no
secret, and have no ids. Rows that repeat an id, or have none, are judged each by itself; of rows that repeat a text the near-copy stage keeps one. Other columns,
whatever their names, pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import bpe_round_trip
from millrace.llm.common import read, settle
from millrace.llm.decontaminate import leaks
from millrace.llm.inplace import keep_languages, redact_secrets, without_rows
from millrace.llm.language import train
from millrace.llm.ngram_join import ngram_components


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from all labelled rows; texts without letters or without a clear language go."""
    return keep_languages(docs, train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 on five-word shingles, the smallest doc_id stays (where ids are repeated or null, any row)."""

    def copies(rows: DataFrame) -> DataFrame:
        return ngram_components(rows, n=5, num=80, den=100).filter("component_id <> doc_id").select(F.col("doc_id").alias("id"))

    return without_rows(docs, copies)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bench = read(spark, sf_dir, "benchmark")
    return without_rows(docs, lambda rows: leaks(rows, bench).select(F.col("doc_id").alias("id")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256: ids, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe_round_trip(docs, path, public_tokenizers.PATTERN, keep_ids=True)
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_copies),
    ("decontamination", benchmark_passages),
    ("secret_scan", secret_scan),
    ("bpe", token_ids),
]

#: Aligning, learning and merging have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
