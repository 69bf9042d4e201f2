"""What goes in and out of a run: fetch attempts, dumps read in splits, tables in total orders, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sinks.ordered import read_ordered, write_ordered
from ..sinks.versions import Versions
from ..sources import attempts as A
from ..sources import caches, files
from .evidence import DISCOVERED, RUN_AT, discovered, relationships
from .fixtures import duck, fixture
from .intake import CELLS, DEDUPED, PRIORITY, VERIFIED, deduped, markdown_rows, normalized, queue, verified
from .monitor import HOST, LISTED, MOVED, redirects, table
from .records import folder
from .research import CONSENSUS, WEB_ROWS, brand_summaries, consensus, web_queue
from .tiers import JOBS as MESH_JOBS
from .tiers import mesh_jobs

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = duck(sql)
        return f

    return add


# --- fetch attempts ------------------------------------------------------------------------------

CACHED = "page_id % 6 = 1"


@query(f"""WITH t AS (SELECT *, count(*) FILTER (status IS NULL) OVER (PARTITION BY url ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS failed, count(*) FILTER (status IS NOT NULL) OVER (PARTITION BY url ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS answered,
        row_number() OVER (PARTITION BY url ORDER BY attempt DESC) AS from_end FROM ({{fetch_attempts}}) WHERE attempt <= {A.RETRIES}),
    r AS (SELECT * FROM t WHERE status IS NOT NULL AND answered = 0 UNION ALL SELECT * FROM t x WHERE status IS NULL AND from_end = 1 AND answered = 0)
    SELECT u.page_id, CASE WHEN {CACHED.replace('page_id', 'u.page_id')} THEN 'cache' ELSE 'network' END AS source, CASE WHEN {CACHED.replace('page_id', 'u.page_id')} THEN 203 ELSE r.status END AS status, CASE WHEN {CACHED.replace('page_id', 'u.page_id')} THEN u.url || '#held' WHEN r.status IS NOT NULL AND r.final_url <> '' THEN r.final_url ELSE u.url END AS final_url,
    CASE WHEN {CACHED.replace('page_id', 'u.page_id')} THEN sha256('held') ELSE sha256(substr(CASE WHEN r.status IS NULL THEN '' ELSE coalesce(r.body, '') END, 1, {A.BODY_BYTES})) END AS body_sha256, CASE WHEN {CACHED.replace('page_id', 'u.page_id')} THEN NULL WHEN r.url IS NULL THEN 'unknown' ELSE r.error END AS error,
    CAST(CASE WHEN {CACHED.replace('page_id', 'u.page_id')} OR r.url IS NULL THEN 0 ELSE failed + 1 END AS INTEGER) AS tries, CASE WHEN {CACHED.replace('page_id', 'u.page_id')} OR r.url IS NULL THEN 0::DOUBLE ELSE round(0.2::DOUBLE * least({A.RETRIES}, failed + CASE WHEN r.status IS NULL THEN 1 ELSE 0 END) * (least({A.RETRIES}, failed + CASE WHEN r.status IS NULL THEN 1 ELSE 0 END) + 1), 3) END AS waited,
    NOT ({CACHED.replace('page_id', 'u.page_id')}) AND r.status IS NOT NULL AS to_cache FROM ({{attempt_urls}}) u LEFT JOIN r ON r.url = u.url""")
def fetch_attempts_fold(spark, sf_dir):
    """One row a URL: from the cache, or what its attempts came to."""
    urls = fixture(spark, sf_dir, "attempt_urls").select("page_id", "url")
    log = fixture(spark, sf_dir, "fetch_attempts").withColumn("body", F.col("body").cast("binary"))
    held = urls.filter(CACHED).select("url", F.lit(203).alias("status"), F.lit("text/html").alias("content_type"), F.concat("url", F.lit("#held")).alias("final_url"), F.lit("held").alias("body"))
    rows = A.fetched(urls, log, caches.cached_pages(held)).join(urls, "url")
    return rows.select("page_id", "source", "status", "final_url", F.sha2("body", 256).alias("body_sha256"), "error", "tries", "waited", "to_cache")


# --- dumps in splits -----------------------------------------------------------------------------

LINE = "concat(CAST(o_orderkey AS VARCHAR(20)), ' ', o_orderpriority, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE concat(' | ', o_orderstatus) END)"


@query(f"SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, {LINE} AS text FROM orders")
def line_ordinals(spark, sf_dir):
    """A dump of many lines, written in parts and read in small splits: each line with its number."""
    path = folder(spark, "dump")
    table(spark, sf_dir, "orders").select("o_orderkey", F.expr(LINE).alias("text")).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("text").write.text(path)
    return files.numbered_lines(spark, path, 64 << 10).select("pos", "text")


# --- total orders --------------------------------------------------------------------------------


def placed(name: str, rows, order: list, keep: list[str], sql: str):
    """Registers sorted_<name>: rows(spark, sf_dir) through an ordered sink, read back with their places. sql has the same columns, and `at` by a window."""

    def run(spark, sf_dir) -> DataFrame:
        path = folder(spark, name)
        write_ordered(rows(spark, sf_dir).select(*keep), path, [F.expr(o.removesuffix(" DESC")).desc() if o.endswith(" DESC") else F.expr(o) for o in order])
        return read_ordered(spark, path)

    query(sql, f"sorted_{name}")(run)


def _sql(source: str, order: list[str], keep: list[str], before: str = "") -> str:
    return f"{before} SELECT {', '.join(keep)}, row_number() OVER (ORDER BY {', '.join(o if o.endswith(' DESC') else o + ' ASC' for o in order)}) - 1 AS at FROM {source}"


MARKDOWN = rf"""WITH k AS (SELECT file, pos, {CELLS} AS cells FROM ({{md_lines}}) WHERE starts_with(trim(text), '|') AND len({CELLS}) >= 2), h AS (SELECT file, min(pos) AS p FROM k GROUP BY file),
    m AS (SELECT CAST(k.file AS VARCHAR) AS source_set, row_number() OVER (PARTITION BY k.file ORDER BY pos) - 1 AS row_index, coalesce(cells[1], '') AS brand, coalesce(cells[2], '') AS primary_domain
        FROM k JOIN h ON h.file = k.file AND k.pos > h.p WHERE len(list_filter(cells, lambda c: c <> '' AND NOT regexp_matches(c, '^:?-+:?$'))) > 0)"""
_o, _k = ["from_url", "to_url", "page_id"], ["from_url", "to_url", "page_id"]
placed("redirects", lambda s, d: redirects(fixture(s, d, "fetch_log")), _o, _k, _sql(f"({MOVED})", _o, _k))
_o, _k = ["relationship_id", "source_url"], ["relationship_id", "source_url"]
placed("relationships", lambda s, d: relationships(discovered(s, d), RUN_AT), _o, _k, _sql(f"(SELECT 'rel_' || {HOST('s')} || '__to__' || domain AS relationship_id, s AS source_url FROM (SELECT domain, unnest(source_urls) AS s FROM ({DISCOVERED})))", _o, _k, f"WITH l AS ({LISTED})"))
_o, _k = ["priority_score DESC", "domain", "brand", "candidate_id"], ["candidate_id", "brand", "domain", "priority_score"]
placed("queue", queue, _o, _k, _sql("qq", _o, _k, PRIORITY))
#: Groups in order, rows of none first (as `None`), duplicates before the row they are of.
_o, _k = ["coalesce(duplicate_group_id, 'None')", "duplicate_of IS NULL", "candidate_id"], ["candidate_id", "duplicate_group_id", "duplicate_of"]
placed("dedupe", lambda s, d: deduped(normalized(fixture(s, d, "candidates"))), _o, _k, _sql("dd", _o, _k, DEDUPED))
_o, _k = ["source_set", "row_index", "brand", "primary_domain"], ["source_set", "row_index", "brand", "primary_domain"]
placed("intake", lambda s, d: markdown_rows(fixture(s, d, "md_lines")).select("source_set", "row_index", *(F.col("cells")[c].alias(c) for c in ("brand", "primary_domain"))), _o, _k, _sql("m", _o, _k, MARKDOWN))
_o, _k = ["brand", "job_id", "line"], ["brand", "job_id", "line"]
placed("jobs", mesh_jobs, _o, _k, _sql(f"({MESH_JOBS})", _o, _k))
_o, _k = ["verification_score DESC", "domain", "page_id"], ["page_id", "domain", "verification_score"]
placed("verified", lambda s, d: verified(fixture(s, d, "fetch_log")).withColumn("domain", U.domain_from_url(F.col("url"))), _o, _k, _sql(f"(SELECT *, {HOST('url')} AS domain FROM ({VERIFIED}))", _o, _k))
_o, _k = ["priority_score DESC", "brand", "candidate_id"], ["candidate_id", "brand", "priority_score"]
placed("web_queue", lambda s, d: web_queue(brand_summaries(s, d)), _o, _k, _sql(f"({WEB_ROWS})", _o, _k))
_o, _k = ["brand", "candidate_id"], ["brand", "candidate_id", "consensus"]
_brands = "SELECT candidate_id, min(brand) AS brand FROM ({provider_result}) GROUP BY 1"
placed("consensus", lambda s, d: consensus(fixture(s, d, "provider_result")).join(fixture(s, d, "provider_result").groupBy("candidate_id").agg(F.min("brand").alias("brand")), "candidate_id"), _o, _k, _sql(f"(SELECT c.candidate_id, brand, consensus FROM ({CONSENSUS}) c JOIN ({_brands}) b ON b.candidate_id = c.candidate_id)", _o, _k))


# --- versions ------------------------------------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN c_custkey % 15 = 0 THEN 3 WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS round, CASE WHEN c_custkey % 15 = 0 THEN 'third' WHEN c_custkey % 5 = 0 THEN 'second' ELSE 'first' END AS value FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT c_custkey, 3, 'third' FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 15 = 0""")
def versioned_upserts(spark, sf_dir):
    """Three rounds of upserts, one of them begun twice and one broken off before its commit."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    held = Versions(spark, folder(spark, "customers"))
    of = lambda rows, n, v: rows.select("c_custkey", F.lit(n).alias("round"), F.lit(v).alias("value"))
    held.upsert(of(c.filter("c_custkey % 7 <> 0"), 1, "first"), ["c_custkey"], ["round"], "run 1")
    second = of(c.filter("c_custkey % 5 = 0 and c_custkey % 7 <> 0"), 2, "second")
    held.write(of(c, 9, "broken off"))
    for _ in range(2):
        held.upsert(second, ["c_custkey"], ["round"], "run 2")
    held.upsert(of(c.filter("c_custkey % 15 = 0"), 3, "third"), ["c_custkey"], ["round"], "run 3")
    return held.read()
