"""A monitor run in stages: each stage is a table that is written before the next one reads it, and a rerun of the same run takes up what is whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import relational as R
from ..sinks import files as W
from ..sources import files
from . import evidence as E
from . import fingerprints as P
from .fixtures import duck, fixture
from .monitor import LISTED, MOVED, URL, extracted, listed, redirects, table
from .records import folder

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


class Run:
    """Stages under `root`, one run a name. A stage is whole once its log entry stands, which is written after its table; what was broken off before that is done anew,
    in a folder of its own. Stages that a changed stage feeds are not redone: a run is one set of inputs."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark, self.home = spark, f"{root.rstrip('/')}/{name}"
        self.report: list[tuple[int, str, int, bool]] = []

    def entry(self, stage: str) -> dict | None:
        path = f"{self.home}/log/{stage}.json"
        if not files.exists(self.spark, path):
            return None
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(path).collect()))

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of the stage: as it was left by an earlier try of this run, or made now."""
        held = self.entry(name)
        resumed = held is not None
        if held is None:
            part = f"{name}-{uuid.uuid4().hex}"
            make().write.parquet(f"{self.home}/{part}")
            held = {"folder": part, "rows": self.spark.read.parquet(f"{self.home}/{part}").count()}
            W.write_text(self.spark, f"{self.home}/log/{name}.json", W.json_text(held))
        self.report.append((len(self.report), name, held["rows"], resumed))
        return self.spark.read.parquet(f"{self.home}/{held['folder']}")

    def summary(self) -> DataFrame:
        """seq, stage, rows, resumed of the stages so far."""
        return self.spark.createDataFrame(self.report, "seq int, stage string, rows long, resumed boolean")


def monitor(run: Run, log: DataFrame, discovered: Callable[[], DataFrame], network: tuple[DataFrame, ...], known: DataFrame, run_at: str, most: int = P.MOST) -> dict[str, DataFrame]:
    """discover, extract, fingerprint, redirects, classify, emit (entities, relationships), bridge; each reads what the ones before wrote.

    log: recorded fetches as extracted() takes them; discovered: makes domain, source_urls, seq; network: the four logs of fingerprints(); known: host."""
    found = run.stage("discover", discovered)
    pages = run.stage("extract", lambda: extracted(log))
    out = {"discover": found, "extract": pages}
    out["fingerprint"] = run.stage("fingerprint", lambda: P.fingerprints(P.first_domains(found, most), *network, run_at))

    def moved() -> DataFrame:
        http = redirects(log).select("from_url", "to_url", "domain_from", "domain_to", F.lit("http_redirect").alias("discovery_type"), F.col("from_url").alias("source_url"), F.lit(run_at).alias("first_seen"), F.col("page_id").alias("seq"))
        return E.merged_redirects(http, E.phrase_redirects(pages, run_at))

    out["redirects"] = run.stage("redirects", moved)
    labels = out["classify"] = run.stage("classify", lambda: E.hints(pages))
    out["entities"] = run.stage("entities", lambda: E.entities(found, pages, labels))
    out["relationships"] = run.stage("relationships", lambda: E.relationships(found, run_at))

    def bridged() -> DataFrame:
        answered = out["redirects"].filter("discovery_type = 'http_redirect'").select(F.col("domain_to").alias("domain")).distinct().withColumn("kind", F.lit("http_redirect"))
        rows = found.join(answered, "domain", "left").select("domain", F.coalesce("kind", F.lit("link")).alias("discovery_type"))
        return R.bridge(rows, known)

    out["bridge"] = run.stage("bridge", bridged)
    return out


def ordered_union(*lists: DataFrame) -> DataFrame:
    """value, source, seq: the values of several lists (value, seq, source), in order of the lists and then of seq; of equal ones the first."""
    rows = None
    for k, one in enumerate(lists):
        own = one.select("value", "source", "seq").withColumn("list", F.lit(k))
        rows = own if rows is None else rows.unionByName(own)
    first = rows.groupBy("value").agg(F.min(F.struct("list", "seq", "source")).alias("first"))
    return R.numbered(first.select("value", F.col("first.source").alias("source"), F.col("first.list").alias("list"), F.col("first.seq").alias("old")), ["list", "old", "value"], "seq").drop("list", "old")


def seeds(spark: SparkSession, seed_file: str, bootstrap_file: str) -> DataFrame:
    """value, source, seq: URLs to begin with, in normal form and each once, in order: the seed list, then the front page of each bootstrap host; hosts that are URLs are passed over."""

    def lines(path: str) -> DataFrame:
        rows = files.numbered_lines(spark, path).select(F.regexp_replace("text", r"^\s+|\s+$", "").alias("t"), F.col("pos").alias("seq"))
        return rows.filter((F.col("t") != "") & ~F.col("t").startswith("#"))

    host = F.regexp_replace(F.lower("t"), r"^\.+|\.+$", "")
    named = lines(bootstrap_file).filter((host != "") & ~host.startswith("http")).select(F.concat(F.lit("https://"), host, F.lit("/")).alias("t"), "seq")
    each = [df.select(U.normalize_url(F.col("t")).alias("value"), "seq", F.lit(s).alias("source")).filter("value is not null") for df, s in ((lines(seed_file), "seed"), (named, "bootstrap"))]
    return ordered_union(*each)


EXTERNAL = ["perplexity", "claude", "gemini"]
LOCAL = "deterministic"


def requested(providers: DataFrame, column: str = "providers") -> DataFrame:
    """The rows with `want` (external providers that are asked for, sorted), `others` (names that are neither external nor the local one), `left_out` (external ones that aren't asked for)
    and `run_external`. A null list asks for none."""
    names = F.array_distinct(F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda p: F.lower(F.trim(p))))
    known = F.array(*map(F.lit, EXTERNAL))
    out = {"want": F.array_intersect(names, known), "others": F.array_except(names, F.array(*map(F.lit, [*EXTERNAL, LOCAL]))), "left_out": F.array_except(known, names)}
    return providers.withColumns({k: F.array_sort(v) for k, v in out.items()} | {"run_external": F.exists(names, lambda n: n != LOCAL)})


# --- queries -------------------------------------------------------------------------------------

RUN_AT = "2024-01-02T03:04:05"


def monitor_inputs(spark, sf_dir) -> dict:
    log = fixture(spark, sf_dir, "evidence_log")
    first = table(spark, sf_dir, "pages").groupBy(U.domain_from_url(F.col("url")).alias("domain")).agg(F.min("page_id").alias("seq"))
    found = lambda: E.discovered(spark, sf_dir).select("domain", "source_urls").join(first, "domain", "left").withColumn("seq", F.coalesce("seq", F.lit(1 << 40)))
    return {"log": log, "discovered": found, "network": P.found(spark, sf_dir), "known": listed(spark, sf_dir), "run_at": RUN_AT}


STAGE_ROWS = f"""WITH l AS ({LISTED}), d AS ({E.DISCOVERED}), r AS ({E.RECORDS}), n AS (SELECT 'discover' AS stage, 0 AS seq, count(*) AS rows FROM d UNION ALL SELECT 'extract', 1, count(*) FROM {{evidence_log}} UNION ALL SELECT 'fingerprint', 2, least({P.MOST}, count(*)) FROM d
    UNION ALL SELECT 'redirects', 3, count(*) FROM (SELECT from_url, to_url FROM ({MOVED}) GROUP BY 1, 2 UNION ALL SELECT final_url, 'phrase' FROM r WHERE len(rebrand_phrase_hits) > 0 GROUP BY 1) UNION ALL SELECT 'classify', 4, count(*) FROM {{evidence_log}} UNION ALL SELECT 'entities', 5, count(*) FROM d
    UNION ALL SELECT 'relationships', 6, sum(len(source_urls)) FROM d UNION ALL SELECT 'bridge', 7, count(*) FROM d)"""


@query(f"{STAGE_ROWS} SELECT t AS try, CAST(seq AS INTEGER) AS seq, stage, CAST(rows AS BIGINT) AS rows, t = 2 OR (t = 1 AND seq < 3) AS resumed FROM n, (SELECT unnest([0, 1, 2]) AS t) WHERE t > 0 OR seq < 3")
def monitor_run(spark, sf_dir):
    """A run that breaks off after its third stage, its second try, and a third that finds all done."""
    root, given = folder(spark, "runs"), monitor_inputs(spark, sf_dir)
    first = Run(spark, root, "run-1")
    found = first.stage("discover", given["discovered"])
    first.stage("extract", lambda: extracted(given["log"]))
    first.stage("fingerprint", lambda: P.fingerprints(P.first_domains(found), *given["network"], RUN_AT))
    out = first.summary().withColumn("try", F.lit(0))
    for k in (1, 2):
        again = Run(spark, root, "run-1")
        monitor(again, **given)
        out = out.unionByName(again.summary().withColumn("try", F.lit(k)))
    return out


@query(f"""WITH l AS ({LISTED}), d AS ({E.DISCOVERED}), h AS (SELECT DISTINCT domain_to AS domain FROM ({MOVED})), m AS (SELECT d.domain, min(l.host) AS matched FROM d JOIN l ON l.host <> d.domain AND (ends_with(d.domain, '.' || l.host) OR ends_with(l.host, '.' || d.domain)) GROUP BY 1)
    SELECT d.domain, CASE WHEN d.domain IN (SELECT host FROM l) THEN 'already_known' WHEN m.matched IS NOT NULL THEN 'possible_same_cluster' WHEN h.domain IS NOT NULL THEN 'possible_rebrand' ELSE 'net_new' END AS bridge_status,
    CASE WHEN d.domain IN (SELECT host FROM l) THEN NULL ELSE m.matched END AS matched FROM d LEFT JOIN m ON m.domain = d.domain LEFT JOIN h ON h.domain = d.domain""")
def monitor_bridge(spark, sf_dir):
    """The last stage of a whole run: discovered domains against those known."""
    return monitor(Run(spark, folder(spark, "runs"), "run-2"), **monitor_inputs(spark, sf_dir))["bridge"]


SEED = "CASE WHEN page_id % 11 = 5 THEN '# comment' WHEN page_id % 13 = 6 THEN concat('  ', upper(substring(url, 1, 4)), substring(url, 5, 500), ' ') ELSE url END"
BOOT = "CASE WHEN page_id % 9 = 4 THEN concat('.', upper(h), '. ') WHEN page_id % 9 = 8 THEN concat('http://', h) ELSE h END"
_host = "lower(split_part(split_part(url, '://', 2), '/', 1))"


@query(f"""SELECT value, source, row_number() OVER (ORDER BY list, seq) - 1 AS seq FROM (SELECT value, source, list, seq FROM (SELECT {URL('t')} AS value, 'seed' AS source, 0 AS list, page_id AS seq FROM (SELECT page_id, replace(trim({SEED}), 'HTTP', 'http') AS t FROM pages WHERE page_id % 3 <> 1) WHERE NOT starts_with(t, '#')
    UNION ALL SELECT {URL('t')}, 'bootstrap', 1, page_id FROM (SELECT page_id, 'https://' || trim(lower(trim({BOOT})), '.') || '/' AS t FROM (SELECT page_id, {_host} AS h FROM pages) WHERE page_id % 9 <> 8)) WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY value ORDER BY list, seq) = 1)""")
def seeds_with_bootstrap(spark, sf_dir):
    """Seed and bootstrap lists as files, and what a crawl begins with."""
    pages, path = table(spark, sf_dir, "pages"), folder(spark, "seeds")
    pages.filter("page_id % 3 <> 1").repartitionByRange("page_id").sortWithinPartitions("page_id").select(F.expr(SEED).alias("value")).write.text(f"{path}/seed_urls.txt")
    pages.select("page_id", F.expr(_host).alias("h")).repartitionByRange("page_id").sortWithinPartitions("page_id").select(F.expr(BOOT).alias("value")).write.text(f"{path}/bootstrap_domains.txt")
    return seeds(spark, f"{path}/seed_urls.txt", f"{path}/bootstrap_domains.txt")


ASKED = "split_part('perplexity| Claude |GEMINI;deterministic;deterministic| deterministic;gemini|gemini|other;;perplexity|claude|gemini|extra|Extra', ';', CAST(c_custkey % 6 AS INT) + 1)"
_names = f"list_distinct(list_transform(list_filter(string_split({ASKED}, '|'), lambda x: x <> ''), lambda p: lower(trim(p))))"


@query(f"""SELECT c_custkey, list_sort(list_filter(n, lambda x: list_contains(['perplexity', 'claude', 'gemini'], x))) AS want, list_sort(list_filter(n, lambda x: NOT list_contains(['perplexity', 'claude', 'gemini', 'deterministic'], x))) AS others,
    list_sort(list_filter(['perplexity', 'claude', 'gemini'], lambda x: NOT list_contains(n, x))) AS left_out, len(list_filter(n, lambda x: x <> 'deterministic')) > 0 AS run_external FROM (SELECT c_custkey, {_names} AS n FROM customer)""")
def requested_providers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.filter(F.split(F.expr(ASKED), r"\|"), lambda x: x != "").alias("providers"))
    return requested(rows).drop("providers")


@query(f"""SELECT candidate_id, coalesce(list_sort(list_filter(a, lambda x: list_contains(b, x))), []) AS both, coalesce(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), []) AS only_first, coalesce(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), []) AS only_second
    FROM (SELECT candidate_id, list_distinct(list_filter(string_split(max(domains) FILTER (i = 1), '|'), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(max(domains) FILTER (i = 2), '|'), lambda x: x <> '')) AS b FROM ({{provider_result}}) GROUP BY 1)""")
def provider_differences(spark, sf_dir):
    """Domains that both, or only one, of the first two external providers name."""
    of = lambda i: F.array_distinct(F.filter(F.split(F.max(F.when(F.col("i") == i, F.col("domains"))), r"\|"), lambda x: x != ""))
    rows = fixture(spark, sf_dir, "provider_result").groupBy("candidate_id").agg(of(1).alias("a"), of(2).alias("b"))
    return rows.select("candidate_id", F.array_sort(F.array_intersect("a", "b")).alias("both"), F.array_sort(F.array_except("a", "b")).alias("only_first"), F.array_sort(F.array_except("b", "a")).alias("only_second"))
