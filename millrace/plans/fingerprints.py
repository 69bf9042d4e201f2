"""Fingerprints of domains: one record a domain out of four logs of the network, and the records keyed by domain as one payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import relational as R
from ..sources import network as N
from .fixtures import duck, fixture
from .monitor import HOST

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


MOST = 500
NO_ANSWER, NO_DOMAIN = "no answer recorded", "empty domain"
PARTS = ["dns_a", "dns_aaaa", "dns_ns", "dns_mx", "tls"]


def first_domains(discovered: DataFrame, most: int = MOST) -> DataFrame:
    """domain of the first `most` distinct hosts in order of discovery (domain, seq); blank ones don't count."""
    rows = discovered.select(U.normalize_host(F.coalesce("domain", F.lit(""))).alias("domain"), "seq").filter("domain <> ''")
    return R.first_n(rows, ["domain"], ["seq"], most).select("domain")


def fingerprints(domains: DataFrame, addresses: DataFrame, servers: DataFrame, mails: DataFrame, certificates: DataFrame, run_at: str) -> DataFrame:
    """domain, fingerprinted_at, dns, tls, errors, partial of each domain (distinct hosts; a blank one fails in all parts).

    addresses: host, a, a_error, aaaa, aaaa_error; servers: host, answers (names), error; mails: host, answers (struct<priority, host>), error; certificates: host, subject,
    issuer, dates, names, error; each has one row a host at most. A log without a row for a host has no answer. A certificate with an error is empty."""
    tagged = lambda df, tag: df.select(F.col("host").alias("domain"), F.struct(*(c for c in df.columns if c != "host")).alias(tag))
    rows = domains.select("domain").distinct()
    for df, tag in ((addresses, "a"), (servers, "s"), (mails, "m"), (certificates, "c")):
        rows = rows.join(tagged(df, tag), "domain", "left")
    none = F.array().cast("array<string>")
    silent = lambda tag: F.when(F.col(tag).isNull(), NO_ANSWER)
    found = N.addresses(F.col("a.a"), F.coalesce("a.a_error", silent("a")), F.col("a.aaaa"), F.coalesce("a.aaaa_error", silent("a")))
    rows = rows.withColumn("r", found)
    blank = F.col("domain") == ""
    failed = {"dns_a": F.col("r.error_a"), "dns_aaaa": F.col("r.error_aaaa"), "dns_ns": F.coalesce("s.error", silent("s")), "dns_mx": F.coalesce("m.error", silent("m")), "tls": F.coalesce("c.error", silent("c"))}
    rows = rows.withColumn("errors", F.struct(*(F.when(blank, NO_DOMAIN).otherwise(e).alias(k) for k, e in failed.items())))
    kept = lambda x, part: F.when(F.col(f"errors.{part}").isNull(), x)
    ns = F.coalesce(N.merged_ns(kept(F.col("s.answers"), "dns_ns")), none)
    mx = F.coalesce(N.merged_mx(kept(F.col("m.answers"), "dns_mx")), F.array().cast("array<struct<priority:int,host:string>>"))
    text = lambda c: kept(F.col(f"c.{c}"), "tls")
    tls = N.certificate(text("subject"), text("issuer"), text("dates"), text("names"))
    return rows.select("domain", F.lit(run_at).alias("fingerprinted_at"), F.struct(F.col("r.a").alias("a"), F.col("r.aaaa").alias("aaaa"), ns.alias("ns"), mx.alias("mx")).alias("dns"), tls.alias("tls"), "errors", N.partial([F.col(f"errors.{p}") for p in PARTS]).alias("partial"))


def payload(records: DataFrame, run_at: str) -> DataFrame:
    """One row: artifact_type, generated_at, and the records in a map by domain. For the bounded number of records that first_domains leaves."""
    entry = F.struct("domain", F.struct(*records.columns).alias("record"))
    return records.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("fingerprints")).select(F.lit("domain_fingerprints").alias("artifact_type"), F.lit(run_at).alias("generated_at"), "fingerprints")


# --- queries -------------------------------------------------------------------------------------

RUN_AT = "2024-01-02T03:04:05Z"
DOMAINS = f"SELECT domain FROM (SELECT {HOST('url')} AS domain, min(page_id) AS k FROM pages GROUP BY 1) ORDER BY k LIMIT {MOST}"


def found(spark, sf_dir) -> tuple[DataFrame, ...]:
    log = fixture(spark, sf_dir, "net_log")
    each = lambda c: F.filter(F.split(c, r"\|"), lambda x: x != "")
    mail = F.transform(each("mx"), lambda x: F.struct(F.split_part(x, F.lit(" "), F.lit(1)).cast("int").alias("priority"), F.split_part(x, F.lit(" "), F.lit(2)).alias("host")))
    host = U.normalize_host(F.col("host")).alias("host")
    return (
        log.select(host, each("a").alias("a"), "a_error", each("aaaa").alias("aaaa"), "aaaa_error"), log.filter("k % 21 <> 4").select(host, each("ns").alias("answers"), F.col("ns_error").alias("error")),
        log.select(host, mail.alias("answers"), F.col("mx_error").alias("error")), log.filter("k % 9 <> 1").select(host, "subject", "issuer", "dates", "names", F.col("tls_error").alias("error")),
    )


def records(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    domains = first_domains(pages.select(U.domain_from_url(F.col("url")).alias("domain"), F.col("page_id").alias("seq")))
    return fingerprints(domains, *found(spark, sf_dir), RUN_AT)


FLAT = f"""SELECT d.domain, '{RUN_AT}' AS fingerprinted_at, CASE WHEN k % 4 = 0 THEN '1.1.1.1|2.2.2.2' ELSE '' END AS a, CASE WHEN k % 6 = 0 THEN '::1' ELSE '' END AS aaaa, CASE WHEN k % 21 = 4 OR k % 5 = 0 THEN '' ELSE 'ns1.' || d.domain || '|ns2.' || d.domain END AS ns,
    CASE WHEN k % 7 = 0 THEN '' ELSE '5 mx2.' || d.domain || '|10 mx1.' || d.domain END AS mx, CASE WHEN k % 9 > 1 AND k % 4 <> 3 THEN d.domain END AS subject_cn, CASE WHEN k % 9 > 1 THEN 'CA ' || k % 3 END AS issuer_cn, CASE WHEN k % 9 > 1 THEN 'a.' || d.domain || '|' || d.domain ELSE '' END AS san,
    CASE WHEN k % 9 > 1 THEN '2025-05-03T12:00:00Z' END AS not_before, CASE WHEN k % 9 > 1 AND k % 4 <> 0 THEN '2026-05-30T12:00:00Z' END AS not_after,
    CASE WHEN k % 4 IN (1, 2) THEN 'no A' END AS dns_a, CASE WHEN k % 4 <> 0 AND k % 6 = 1 THEN 'no AAAA' END AS dns_aaaa, CASE WHEN k % 21 = 4 THEN '{NO_ANSWER}' WHEN k % 5 = 0 THEN 'timeout' END AS dns_ns, CASE WHEN k % 7 = 0 THEN 'refused' END AS dns_mx,
    CASE WHEN k % 9 = 1 THEN '{NO_ANSWER}' WHEN k % 9 = 0 THEN 'handshake' END AS tls FROM ({DOMAINS}) d JOIN (SELECT {HOST('host')} AS domain, k FROM ({{net_log}})) l ON l.domain = d.domain"""
WHOLE = f"SELECT *, dns_a IS NOT NULL OR dns_aaaa IS NOT NULL OR dns_ns IS NOT NULL OR dns_mx IS NOT NULL OR tls IS NOT NULL AS partial FROM ({FLAT})"


def flat(rows: DataFrame) -> DataFrame:
    joined: dict[str, Column] = {c: F.array_join(x, "|") for c, x in (("a", F.col("dns.a")), ("aaaa", F.col("dns.aaaa")), ("ns", F.col("dns.ns")), ("mx", F.transform("dns.mx", lambda m: F.concat(m["priority"].cast("string"), F.lit(" "), m["host"]))), ("san", F.col("tls.san")))}
    own = [F.col(f"tls.{c}").alias(c) for c in ("subject_cn", "issuer_cn", "not_before", "not_after")]
    return rows.select("domain", "fingerprinted_at", *(x.alias(c) for c, x in joined.items()), *own, *(F.col(f"errors.{p}").alias(p) for p in PARTS), "partial")


@query(WHOLE)
def fingerprint_records(spark, sf_dir):
    """Whole records of the first domains: addresses, name servers, mail hosts, certificate, errors."""
    return flat(records(spark, sf_dir))


@query(f"SELECT 'domain_fingerprints' AS artifact_type, '{RUN_AT}' AS generated_at, list_sort(list(domain)) AS domains, list_sort(list(domain) FILTER (partial)) AS partial_domains, list_sort(list(coalesce(subject_cn, '-') || '=' || ns)) AS parts FROM ({WHOLE})")
def fingerprint_payload(spark, sf_dir):
    """The payload that is signed: the records in a map by domain."""
    rows = payload(records(spark, sf_dir), RUN_AT)
    entries = F.map_values("fingerprints")
    parts = F.transform(entries, lambda r: F.concat(F.coalesce(r["tls"]["subject_cn"], F.lit("-")), F.lit("="), F.array_join(r["dns"]["ns"], "|")))
    return rows.select("artifact_type", "generated_at", F.array_sort(F.map_keys("fingerprints")).alias("domains"), F.array_sort(F.transform(F.filter(entries, lambda r: r["partial"]), lambda r: r["domain"])).alias("partial_domains"), F.array_sort(parts).alias("parts"))
