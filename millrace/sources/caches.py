"""Keyed tables of what was fetched or answered before. A cache is a Parquet folder; changes are written to a new folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import last_wins

PAGE = ("key", "status", "content_type", "final_url", "body")


def page_key(url: Column) -> Column:
    return F.sha2(url, 256)


def cached_pages(log: DataFrame) -> DataFrame:
    """What the page cache keeps of a fetch (url, status, final_url, content_type, body): a missing status as 0; error and headers are lost. Failed fetches (error without status) aren't kept."""
    kept = log.filter(F.col("status").isNotNull() | F.col("error").isNull()) if "error" in log.columns else log
    rows = kept.select(page_key(F.col("url")).alias("key"), F.coalesce(F.col("status").cast("int"), F.lit(0)).alias("status"), F.coalesce("content_type", F.lit("")).alias("content_type"), F.coalesce("final_url", F.lit("")).alias("final_url"), F.coalesce("body", F.lit("")).alias("body"))
    return last_wins(rows, ["key"], ["status", "final_url", "content_type", "body"])


def lookup_pages(urls: DataFrame, cache: DataFrame) -> DataFrame:
    """url, hit, status, final_url, content_type (null if blank), body, error (never of a hit)."""
    found = urls.join(cache.withColumn("hit", F.lit(True)), page_key(F.col("url")) == F.col("key"), "left")
    return found.select("url", F.coalesce("hit", F.lit(False)).alias("hit"), "status", "final_url", F.nullif("content_type", F.lit("")).alias("content_type"), "body", F.lit(None).cast("string").alias("error"))


def answer_key(candidate: Column, provider: Column, version: str, brand: Column, domains: Column) -> Column:
    """The name of a cached answer: candidate, provider, and a digest of both, the prompt's version, the brand and its sorted domains (200 characters of them)."""
    signature = F.concat(F.trim(brand), F.lit("|"), F.substring(F.array_join(F.array_sort(domains), "|"), 1, 200))
    digest = F.substring(F.sha2(F.concat_ws("|", candidate, provider, F.lit(version), signature), 256), 1, 32)
    return F.concat_ws("_", candidate, F.substring(F.regexp_replace(provider, "[^A-Za-z0-9]", "_"), 1, 40), digest)


def get_answers(jobs: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """jobs (key and more) with the cached payload of this version, else null."""
    return jobs.join(cache.filter(F.col("version") == version).select("key", "payload"), "key", "left")


def set_answers(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with new answers (key, version, payload) in place of old ones; of several new ones of a key the greatest payload."""
    new = last_wins(new.select("key", "version", "payload"), ["key"], ["payload", "version"])
    return cache.join(new.select("key"), "key", "left_anti").select("key", "version", "payload").unionByName(new)


def drop_answers(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("key"), "key", "left_anti")
