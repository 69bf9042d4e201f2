"""What came of fetching URLs: recorded attempts folded into one row a URL, the page cache first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .caches import lookup_pages

#: Attempts after the first, bytes of a body that are read, seconds waited after the first failure (twice as many after the second, and so on).
RETRIES, BODY_BYTES, BACK_OFF = 2, 2_000_000, 0.4


def folded(attempts: DataFrame, retries: int = RETRIES) -> DataFrame:
    """url, status, final_url, content_type, body, error, tries, waited of each URL that was tried.

    attempts: url, attempt (from 0), status (null: no answer), final_url, content_type, body (binary), error. The first answer counts, also one of an HTTP error,
    which keeps its body and its error; failures before it were waited for. Without an answer within retries + 1 attempts the last failure's error counts.
    Attempts after an answer, or beyond the last one allowed, change nothing; of attempts recorded twice the greatest record counts."""
    rest = ["status", "final_url", "content_type", "body", "error"]
    rows = attempts.filter((F.col("attempt") >= 0) & (F.col("attempt") <= retries))
    answer, failure = F.col("status").isNotNull(), F.col("status").isNull()
    first = F.min(F.when(answer, F.col("attempt"))).alias("at")
    row = F.min_by(F.struct(*rest), F.struct(failure.cast("int"), "attempt", F.coalesce("final_url", F.lit("")))).alias("row")
    last = F.max_by("error", F.when(failure, F.struct("attempt", F.coalesce("error", F.lit(""))))).alias("last")
    failed = F.collect_set(F.when(failure, F.col("attempt"))).alias("failed")  # at most retries + 1 of a URL
    rows = rows.groupBy("url").agg(first, row, last, failed)
    before = F.size(F.filter("failed", lambda k: F.col("at").isNull() | (k < F.col("at"))))
    waits = F.least(before, F.lit(retries))
    answered = F.col("at").isNotNull()
    own = lambda c: F.when(answered, F.col(f"row.{c}"))
    return rows.select(
        "url", own("status").alias("status"), F.coalesce(F.nullif(own("final_url"), F.lit("")), "url").alias("final_url"), own("content_type").alias("content_type"),
        F.coalesce(F.substring(own("body"), 1, BODY_BYTES), F.lit(b"")).alias("body"), F.when(answered, F.col("row.error")).otherwise(F.coalesce("last", F.lit("unknown"))).alias("error"),
        (before + answered.cast("int")).alias("tries"), F.round(waits * (waits + 1) * (BACK_OFF / 2), 3).alias("waited"),
    )


def fetched(urls: DataFrame, attempts: DataFrame, cache: DataFrame, retries: int = RETRIES) -> DataFrame:
    """A row for each URL (distinct): from the cache where it has it, without an error; else what its attempts came to; URLs that were never tried failed as unknown.
    to_cache: whether the answer is new and is kept."""
    found = lookup_pages(urls.select("url").distinct(), cache)
    held = found.filter("hit").select("url", F.lit("cache").alias("source"), "status", "final_url", "content_type", F.col("body").cast("binary").alias("body"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("tries"), F.lit(0.0).alias("waited"))
    asked = found.filter("not hit").select("url")
    new = asked.join(folded(attempts, retries), "url", "left").select(
        "url", F.lit("network").alias("source"), "status", F.coalesce("final_url", "url").alias("final_url"), "content_type", F.coalesce("body", F.lit(b"")).alias("body"),
        F.when(F.col("tries").isNull(), "unknown").otherwise(F.col("error")).alias("error"), F.coalesce("tries", F.lit(0)).alias("tries"), F.coalesce("waited", F.lit(0.0)).alias("waited"),
    )
    return held.unionByName(new).withColumn("to_cache", (F.col("source") == "network") & F.col("status").isNotNull())
