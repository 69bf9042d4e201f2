"""Queries that write files and read them back, and records of the network: sources and sinks over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import relational as R
from ..sinks import files as W
from ..sinks import signing as S
from ..sinks.versions import Versions
from ..sources import caches, files, network
from .fixtures import duck, fixture
from .intake import BUCKETED, NAMES, canonical
from .monitor import HOST, HOSTS, LISTED, MOVED, UNDER, URL, listed, redirects, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


def folder(spark, name: str) -> str:
    """A new folder under the shared one."""
    R.shared_root(spark)
    return f"{R.shared_root(spark)}/{name}-{uuid.uuid4().hex}"


# --- files ---------------------------------------------------------------------------------------


@query("SELECT 'k' || n_nationkey || ' ' || n_name AS value FROM nation WHERE n_nationkey % 4 > 1")
def line_list(spark, sf_dir):
    """Lists with blank lines and comments; a missing file has no lines."""
    rows = table(spark, sf_dir, "nation").select(F.expr("case n_nationkey % 4 when 0 then concat('# ', n_name) when 1 then '   ' else concat('  k', n_nationkey, ' ', n_name, '\t') end").alias("value"))
    path = folder(spark, "lines")
    rows.write.text(path)
    return files.read_lines(spark, path).unionByName(files.read_lines(spark, f"{path}-missing"))


SCHEMA = "p_partkey long, p_name string, p_size int, p_retailprice double"


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def json_round_trip(spark, sf_dir):
    """A table as one deterministic JSON array, read back strictly; what is no array or missing has no rows."""
    path = folder(spark, "json")
    W.write_json(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), f"{path}/parts.json", ["p_partkey"])
    W.write_text(spark, f"{path}/object.json", W.json_text({"p_partkey": 1}))
    W.write_text(spark, f"{path}/broken.json", "[{")
    out = files.read_json_array(spark, f"{path}/parts.json", SCHEMA, strict=True)
    for name in ("object", "broken", "missing"):
        out = out.unionByName(files.read_json_array(spark, f"{path}/{name}.json", SCHEMA))
    return out


@query("SELECT CAST(s_suppkey AS VARCHAR) AS line, s_name || ', \"quoted\"' AS brand, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'newly' || chr(10) || 'listed' END AS status_hint FROM supplier ORDER BY s_suppkey LIMIT 40")
def csv_round_trip(spark, sf_dir):
    """Quotes, commas, line feeds and nulls through a CSV file; the first 40 rows of it."""
    path = folder(spark, "csv")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("line"), F.concat("s_name", F.lit(', "quoted"')).alias("brand"), F.expr("case when s_suppkey % 3 = 0 then null else concat('newly', chr(10), 'listed') end").alias("status_hint"))
    W.write_csv(rows, path, ["line"])
    return files.read_csv(spark, path, limit=40)


@query("SELECT CASE file WHEN 0 THEN 'set1' WHEN 1 THEN 'set2' ELSE 'other' END AS source_set, CAST(count(*) AS BIGINT) AS n_lines FROM ({md_lines}) GROUP BY 1")
def markdown_folder(spark, sf_dir):
    """Lines of a folder of markdown files, by their source set."""
    from .intake import source_set

    path = folder(spark, "md")
    rows = fixture(spark, sf_dir, "md_lines")
    for k, name in enumerate(("List_Set1", "a-set2", "other")):
        rows.filter(F.col("file") == k).repartitionByRange("pos").sortWithinPartitions("pos").select("text").write.text(f"{path}/{name}.md")
    lines = files.numbered_lines(spark, f"{path}/*.md")
    return lines.groupBy(source_set(F.col("file")).alias("source_set")).agg(F.count("*").alias("n_lines"))


@query(f"{BUCKETED} SELECT bucket, candidate_id, brand, domain AS primary_domain, array_to_string(aliases, ', ') AS other_domains, printf('%.4f', confidence) AS confidence, coalesce(duplicate_group_id, '') AS duplicate_group_id FROM bb")
def bucket_files(spark, sf_dir):
    """A CSV file for each bucket, empty ones too, read back."""
    path = folder(spark, "buckets")
    rows = canonical(spark, sf_dir).select("bucket", "candidate_id", "brand", F.col("domain").alias("primary_domain"), F.array_join("aliases", ", ").alias("other_domains"), F.format_string("%.4f", "confidence").alias("confidence"), "duplicate_group_id")
    W.write_buckets(rows, path, "bucket", [*NAMES, "empty_bucket"], ["candidate_id"])
    out = None
    for name in [*NAMES, "empty_bucket"]:
        part = files.read_csv(spark, f"{path}/{name}.csv").withColumn("bucket", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select("bucket", "candidate_id", "brand", "primary_domain", "other_domains", "confidence", "duplicate_group_id")


@query(f"SELECT from_url, to_url, max(seq) AS seq, CAST(count(*) AS BIGINT) AS n FROM (SELECT from_url, to_url, page_id AS seq FROM ({MOVED}) UNION ALL SELECT from_url, to_url, 1000000 + page_id FROM ({MOVED}) WHERE page_id % 2 = 0) GROUP BY 1, 2")
def redirect_upsert(spark, sf_dir):
    """Redirects on file, replaced by newer ones of the same key in a new version, and read back. n: how many records of its key there have been so far, over both runs;
    the largest number stands, wherever it comes from."""
    held, keys, later = Versions(spark, folder(spark, "redirects")), ["from_url", "to_url"], F.when(F.expr("page_id % 2 = 0"), F.col("page_id") + 1000000)
    r = redirects(fixture(spark, sf_dir, "fetch_log")).groupBy(*keys).agg(F.max("page_id").alias("seq"), F.count("*").alias("n"), F.max(later).alias("later"), F.count(later).alias("more"))
    held.upsert(r.select(*keys, "seq", "n"), keys, ["seq"], "first")
    new = r.filter("more > 0").select(*keys, F.greatest("seq", "later").alias("seq"), (F.col("n") + F.col("more")).alias("n"))
    held.upsert(new, keys, ["seq"], "second")
    held.upsert(new, keys, ["seq"], "second")  # a rerun changes nothing
    return held.read().select(*keys, "seq", "n")


@query("SELECT '2024-01-02T03:04:05' AS run_at, CAST(count(*) AS BIGINT) AS pages, CAST(count(*) FILTER (page_id % 2 = 0) AS BIGINT) AS even, CAST(7 AS BIGINT) AS patched FROM pages")
def run_report(spark, sf_dir):
    """The counters of a run as a file, patched afterwards and read back."""
    path = folder(spark, "reports")
    row = table(spark, sf_dir, "pages").agg(F.count("*").alias("pages"), F.count_if(F.expr("page_id % 2 = 0")).alias("even"))
    report = W.write_report(row, path, "discover", "2024-01-02T03:04:05")
    W.patch_json(spark, report, patched=7)
    return spark.read.json(report, multiLine=True, schema="run_at string, pages long, even long, patched long")


# --- caches and the network ----------------------------------------------------------------------


@query("SELECT url, page_id % 3 <> 0 AS hit, CASE WHEN page_id % 3 <> 0 THEN CAST(CASE WHEN page_id % 5 = 0 THEN 0 ELSE 200 END AS INTEGER) END AS status, CASE WHEN page_id % 3 <> 0 AND page_id % 4 <> 0 THEN 'text/html' END AS content_type FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)")
def page_cache(spark, sf_dir):
    """Pages looked up in the cache: a missing status comes back as 0, a missing type as none."""
    p = table(spark, sf_dir, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"), F.first("html").alias("body"))
    log = p.filter("page_id % 3 <> 0").select("url", F.expr("case when page_id % 5 = 0 then null else 200 end").alias("status"), F.expr("case when page_id % 4 = 0 then null else 'text/html' end").alias("content_type"), F.col("url").alias("final_url"), "body")
    path = folder(spark, "cache")
    caches.cached_pages(log).write.parquet(path)
    return caches.lookup_pages(p.select("url"), spark.read.parquet(path)).select("url", "hit", "status", "content_type")


NET = """SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN ['2.2.2.2', '1.1.1.1', '2.2.2.2'] ELSE [] END AS a, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 < 3 THEN 'no A' END AS a_error, CASE WHEN c_custkey % 6 = 0 THEN ['::1'] ELSE [] END AS aaaa, CASE WHEN c_custkey % 6 = 1 THEN 'no AAAA' END AS aaaa_error FROM customer"""


@query(f"SELECT k, list_sort(list_distinct(a)) AS a, aaaa, CASE WHEN len(a) = 0 THEN a_error END AS error_a, CASE WHEN len(a) = 0 AND len(aaaa) = 0 THEN aaaa_error END AS error_aaaa, (len(a) = 0 AND a_error IS NOT NULL) OR (len(a) = 0 AND len(aaaa) = 0 AND aaaa_error IS NOT NULL) OR k % 9 = 0 AS partial, k % 5 = 0 AS dns_ok FROM ({NET})")
def address_records(spark, sf_dir):
    """Addresses with the errors that count, whether a host resolves, and whether its fingerprint is partial."""
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "case when c_custkey % 4 = 0 then array('2.2.2.2', '1.1.1.1', '2.2.2.2') end as a", "case when c_custkey % 4 = 0 then null when c_custkey % 4 < 3 then 'no A' end as a_error", "case when c_custkey % 6 = 0 then array('::1') end as aaaa", "case when c_custkey % 6 = 1 then 'no AAAA' end as aaaa_error", "case when c_custkey % 5 = 0 then true when c_custkey % 5 = 1 then false end as known")
    c = c.withColumn("r", network.addresses(F.col("a"), F.col("a_error"), F.col("aaaa"), F.col("aaaa_error")))
    errors = [F.col("r.error_a"), F.col("r.error_aaaa"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.expr("case when k % 9 = 0 then 'handshake' end")]
    return c.select("k", "r.*", network.partial(errors).alias("partial"), network.dns_ok(F.col("known"), F.concat(F.lit("h"), "k")).alias("dns_ok"))


def message(kind: int, name: str) -> str:
    """SQL for the bytes of an answer with two records of a kind for host `name`, the second one's name by a pointer."""
    label = lambda x: f"concat(unhex(lpad(hex(length({x})), 2, '0')), cast({x} as binary))"
    data = lambda host, p: f"concat({f'unhex(lpad(hex({p}), 4, {chr(39)}0{chr(39)})), ' if kind == 15 else ''}{host})"
    record = lambda d: f"concat(unhex('C00C{kind:04X}000100000E10'), unhex(lpad(hex(length({d})), 4, '0')), {d})"
    first, second = data(f"concat({label(chr(39) + 'Mx1' + chr(39))}, unhex('C00C'))", "10 + k % 3"), data(f"concat({label(name)}, {label(chr(39) + 'NET' + chr(39))}, unhex('00'))", "5")
    return f"concat(unhex('00018180'), unhex('0001'), unhex('0001'), unhex('0001'), unhex('0000'), {label(name)}, {label(chr(39) + 'com' + chr(39))}, unhex('00'), unhex('{kind:04X}0001'), {record(first)}, {record(second)})"


@query("SELECT k, '5 h' || k || '.net,' || (10 + k % 3) || ' mx1.h' || k || '.com' AS mx, ['h' || k || '.net', 'mx1.h' || k || '.com'] AS ns, k % 7 = 0 AS broken FROM (SELECT DISTINCT p_size AS k FROM part) WHERE k % 7 <> 0 UNION ALL SELECT k, '', [], true FROM (SELECT DISTINCT p_size AS k FROM part) WHERE k % 7 = 0")
def dns_messages(spark, sf_dir):
    """Mail hosts and name servers out of the bytes of DNS messages with pointers; cut ones give an error."""
    rows = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("k")).distinct().withColumn("name", F.concat(F.lit("h"), "k"))
    cut = lambda m: f"case when k % 7 = 0 then substring({m}, 1, length({m}) - 3) else {m} end"
    rows = rows.select("k", network.dns_answers(F.expr(cut(message(15, "name"))), "MX").alias("mx"), network.dns_answers(F.expr(cut(message(2, "name"))), "NS").alias("ns"))
    mx = F.array_join(F.transform(network.merged_mx(F.col("mx.answers")), lambda m: F.concat(m["priority"].cast("string"), F.lit(" "), m["host"])), ",")
    return rows.select("k", mx.alias("mx"), network.merged_ns(F.col("ns.answers.host")).alias("ns"), F.col("mx.error").isNotNull().alias("broken"))


ASKED = "CASE CAST(s_suppkey % 6 AS INT) WHEN 0 THEN concat('s', CAST(s_suppkey AS VARCHAR(20)), '.com.') WHEN 1 THEN concat('WWW.S', CAST(s_suppkey AS VARCHAR(20)), '.Co.UK') WHEN 2 THEN '' WHEN 3 THEN concat(repeat('a', 64), '.com') WHEN 4 THEN 'x' ELSE concat('a..', CAST(s_suppkey AS VARCHAR(20))) END"
_wire = "array_to_string(list_transform(string_split(n, '.'), lambda l: lpad(to_hex(length(l)), 2, '0') || hex(l)), '')"


@query(f"""SELECT s_suppkey AS k, kind, CASE WHEN NOT bad THEN upper(lpad(to_hex(s_suppkey % 65536), 4, '0') || '01000001000000000000' || CASE WHEN n = '' THEN '' ELSE {_wire} END || '00' || CASE kind WHEN 'NS' THEN '0002' ELSE '000F' END || '0001') END AS message, bad AS refused
    FROM (SELECT *, s_suppkey % 6 IN (3, 5) AS bad FROM (SELECT s_suppkey, lower(rtrim({ASKED}, '.')) AS n FROM supplier)), (SELECT unnest(['NS', 'MX']) AS kind)""")
def dns_questions(spark, sf_dir):
    """What is asked of a name server for each host; names that don't fit a message are refused."""
    hosts, out = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("k"), F.expr(ASKED).alias("host")), None
    for kind in ("NS", "MX"):
        q = hosts.select("k", F.lit(kind).alias("kind"), network.dns_question(F.col("host"), kind, F.col("k") % 65536).alias("q"))
        q = q.select("k", "kind", F.hex("q.message").alias("message"), F.col("q.error").isNotNull().alias("refused"))
        out = q if out is None else out.unionByName(q)
    return out


@query("SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 's' || s_suppkey || '.com' END AS subject_cn, 'CA ' || s_nationkey AS issuer_cn, ['a.s' || s_suppkey || '.com', 's' || s_suppkey || '.com'] AS san, '2025-05-03T12:00:00Z' AS not_before, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '2026-05-30T12:00:00Z' END AS not_after FROM supplier")
def certificates(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as k", "case when s_suppkey % 5 = 0 then 'subject=O = Org' else concat('subject=C=US, O=Org, CN = s', s_suppkey, '.com') end as subject", "concat('x\nissuer=CN=old, O=Org, CN = CA ', s_nationkey) as issuer",
        "concat('notBefore=May  3 12:00:00 2025 GMT\nnotAfter=', case when s_suppkey % 4 = 0 then 'never' else 'May 30 12:00:00 2026 GMT' end) as dates", "concat('DNS:S', s_suppkey, '.com, DNS:a.s', s_suppkey, '.com, DNS:s', s_suppkey, '.COM, IP:1.1.1.1') as names",
    )
    return rows.select("k", network.certificate(F.col("subject"), F.col("issuer"), F.col("dates"), F.col("names")).alias("c")).select("k", "c.*")


@query("""SELECT event_id, sha256('{"a":[1,' || event_id || '],"b":{"t":"' || event_type || '","x":null},"z":"\\u00e9"}') AS payload_hash FROM events""")
def canonical_hash(spark, sf_dir):
    """Digests of any JSON objects, whatever the order of their keys and their blanks."""
    doc = F.concat(F.lit('{ "z" : "é", "b": {"x": null, "t": "'), "event_type", F.lit('"}, "a": [1, '), F.col("event_id").cast("string"), F.lit("]}"))
    return table(spark, sf_dir, "events").select("event_id", S.payload_hash(doc).alias("payload_hash"))


SNAPSHOT = "entities array<struct<domain:string,hostname:string,normalized_domain:string>>, domains array<string>, known_domains map<string,string>, operators array<string>"


@query("SELECT DISTINCT d AS domain FROM (SELECT unnest(['e' || (s_suppkey % 5) || '.com', 'h' || s_suppkey || '.com', 'd' || (s_suppkey % 9) || '.com', 'k' || (s_suppkey % 7) || '.com', 'o' || s_suppkey || '.com']) AS d FROM supplier)")
def snapshot_blocks(spark, sf_dir):
    """Known domains of all four blocks of a snapshot: lists of strings or of objects, or keys of a map."""
    doc = F.format_string('{"entities": [{"domain": "WWW.e%d.com"}, {"domain": "", "hostname": "h%d.com"}, {"other": 1}], "domains": ["d%d.com.", ""], "known_domains": {"k%d.com": 1}, "operators": ["O%d.com"]}', F.expr("s_suppkey % 5"), "s_suppkey", F.expr("s_suppkey % 9"), F.expr("s_suppkey % 7"), "s_suppkey")
    s = table(spark, sf_dir, "supplier").select(F.from_json(doc, SNAPSHOT).alias("s"))
    return s.select(F.explode(snapshot_hosts(F.col("s"))).alias("domain")).distinct()


def snapshot_hosts(s):
    none = F.array().cast("array<string>")
    named = F.transform("s.entities", lambda e: F.coalesce(F.nullif(e["domain"], F.lit("")), F.nullif(e["hostname"], F.lit("")), e["normalized_domain"]))
    every = F.concat(*(F.coalesce(x, none) for x in (named, s["domains"], F.map_keys(s["known_domains"]), s["operators"])))
    return F.filter(F.transform(every, U.normalize_host), lambda h: h != "")


# --- domain map and ordinals ---------------------------------------------------------------------


def domain_map(links: DataFrame, seeds: DataFrame, deny: DataFrame) -> DataFrame:
    """Every domain that a link (source_url, url, seq) or a seed that isn't denied (url, seq) names: its first link, or else its first seed; all its sources. Denied domains of links stay."""
    named = links.select(U.domain_from_url(F.col("url")).alias("domain"), F.lit(0).alias("kind"), "seq", "url", "source_url").filter("domain <> ''")
    own = R.settled(seeds.select(U.normalize_url(F.col("url")).alias("url"), "seq"), "seeds")  # else Spark writes the normal form out again wherever it is used
    own = own.filter("url is not null").select(U.domain_from_url(F.col("url")).alias("domain"), F.lit(1).alias("kind"), "seq", "url", F.col("url").alias("source_url"))
    fit = R.hosts_within(own.select(F.col("domain").alias("host")).distinct(), None, deny)
    own = own.join(fit.select(F.col("host").alias("domain")), "domain", "left_semi")
    first = F.min_by(F.struct("kind", "url"), F.struct("kind", "seq")).alias("first")
    sources = F.array_sort(F.collect_set(F.when(F.col("kind") == 0, "outbound_link").otherwise("seed")))
    rows = named.unionByName(own).groupBy("domain").agg(first, sources.alias("sources"), F.array_sort(F.collect_set("source_url")).alias("source_urls"))
    return rows.select("domain", F.col("first.url").alias("discovered_url"), F.when(F.col("first.kind") == 0, "outbound_link").otherwise("seed").alias("discovery_type"), "sources", F.get("source_urls", F.lit(0)).alias("source_url"), "source_urls")


LINKED = f"SELECT {HOST('x.url')} AS domain, 0 AS kind, x.page_id * 10 + x.pos AS seq, {URL('x.url')} AS url, {URL('f.url')} AS source_url FROM ({{page_links}}) x JOIN pages f ON f.page_id = x.page_id"
SEEDED = f"SELECT host AS domain, 1 AS kind, page_id AS seq, {URL('url')} AS url, {URL('url')} AS source_url FROM (SELECT page_id, url, {HOST('url')} AS host FROM pages) h WHERE page_id % 3 = 0 AND NOT {UNDER} UNION ALL SELECT 'only.seed.example', 1, -1, 'https://only.seed.example/', 'https://only.seed.example/'"


@query(f"""WITH l AS ({LISTED}) SELECT domain, split_part(arg_min(kind || ' ' || url, kind * 1000000000 + seq), ' ', 2) AS discovered_url, CASE WHEN min(kind) = 0 THEN 'outbound_link' ELSE 'seed' END AS discovery_type,
    list_sort(list(DISTINCT CASE kind WHEN 0 THEN 'outbound_link' ELSE 'seed' END)) AS sources, min(source_url) AS source_url, list_sort(list(DISTINCT source_url)) AS source_urls FROM ({LINKED} UNION ALL {SEEDED}) GROUP BY 1""")
def seeded_domain_map(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = fixture(spark, sf_dir, "page_links").join(pages.select("page_id", F.col("url").alias("s")), "page_id").select(U.normalize_url(F.col("s")).alias("source_url"), U.normalize_url(F.col("url")).alias("url"), (F.col("page_id") * 10 + F.col("pos")).alias("seq"))
    seeds = pages.filter("page_id % 3 = 0").select("url", F.col("page_id").alias("seq")).unionByName(spark.sql("SELECT 'https://only.seed.example' AS url, -1L AS seq"))
    return domain_map(links, seeds, listed(spark, sf_dir))


@query(f"SELECT page_id, 'p' || row_number() OVER (ORDER BY url, page_id) AS id FROM pages")
def fetch_ids(spark, sf_dir):
    """Pages numbered in order of URL, by counts of ranges: no task sees all rows."""
    return R.numbered(table(spark, sf_dir, "pages").select("page_id", "url"), ["url", "page_id"], "n").select("page_id", F.concat(F.lit("p"), (F.col("n") + 1).cast("string")).alias("id"))


@query(f"SELECT host, page_id FROM (SELECT host, min(page_id) AS page_id FROM ({HOSTS}) GROUP BY host) ORDER BY page_id LIMIT 20")
def first_domains(spark, sf_dir):
    """The 20 first distinct hosts, by their first page."""
    return R.first_n(table(spark, sf_dir, "pages").select(U.domain_from_url(F.col("url")).alias("host"), "page_id"), ["host"], ["page_id"], 20)


U241F = "'␟'"


@query(f"""SELECT s_suppkey AS k, 'candidate_' || replace(lower(s_name) || '.com', '.', '_') AS entity_id, 'cand_' || substr(sha256(concat_ws({U241F}, 'set1', 'a/b.md', CAST(s_suppkey AS VARCHAR), s_name, 'x.com', '')), 1, 16) AS markdown_id,
    'cand_' || substr(sha256(concat_ws({U241F}, 'bulk', 'dump', CAST(s_suppkey AS VARCHAR), s_name, 'x.com')), 1, 16) AS bulk_id, substr(sha256(s_name || '|a|b'), 1, 16) AS job_id FROM supplier""")
def candidate_ids(spark, sf_dir):
    """The four forms of ids."""
    s, k, name, x = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("string"), F.col("s_name"), F.lit("x.com")
    return s.select(
        F.col("s_suppkey").alias("k"), U.entity_id(F.concat(F.lower(name), F.lit(".com"))).alias("entity_id"), U.hashed_id("cand_", 16, F.lit("set1"), F.lit("a/b.md"), k, name, x, F.lit(None).cast("string")).alias("markdown_id"),
        U.hashed_id("cand_", 16, F.lit("bulk"), F.lit("dump"), k, name, x).alias("bulk_id"), U.job_id(name, F.lit("a|b")).alias("job_id"),
    )


@query("SELECT p_partkey, CAST(1 + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 4 END AS INTEGER) AS size FROM part")
def merge_sizes(spark, sf_dir):
    """Group sizes out of merge notes."""
    note = F.expr("case when p_partkey % 3 = 0 then 'duplicate_of=c1' when p_partkey % 4 = 0 then 'merged_ids= ;x' else concat('a;merged_ids=', array_join(transform(sequence(1, cast(p_partkey % 4 as int)), i -> concat('c', i)), ','), ';b') end")
    return table(spark, sf_dir, "part").select("p_partkey", T.merge_group_size(note).alias("size"))
