"""Queries over recorded fetches: URLs, links, crawl, redirects, signals, classification, entities, bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import lexicon as L
from ..functions import text as T
from ..functions import urls as U
from ..operators import relational as R
from .fixtures import duck, fixture

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


# SQL forms of the functions, for the oracle
NH = lambda x: f"regexp_replace(regexp_replace(split_part(regexp_replace(lower(trim({x})), '^\\.+|\\.+$', '', 'g'), ':', 1), '^\\.+|\\.+$', '', 'g'), '^www\\.', '')"
HOST = lambda x: NH(f"regexp_replace(regexp_extract(CASE WHEN contains({x}, '://') THEN {x} ELSE 'https://' || {x} END, '://([^/?#]*)', 1), '^.*@', '')")
URL = lambda x: (
    f"(CASE WHEN regexp_extract({x}, '^([a-zA-Z]+)://', 1) IN ('http', 'https') AND {HOST(x)} <> '' THEN "
    f"(CASE WHEN regexp_extract({x}, '^[a-z]+://[^/?#]*?:([0-9]+)([/?#]|$)', 1) = '443' OR (starts_with({x}, 'https') AND regexp_extract({x}, '^[a-z]+://[^/?#]*?:([0-9]+)([/?#]|$)', 1) = '') THEN 'https://' ELSE 'http://' END) || {HOST(x)} || "
    f"(CASE WHEN regexp_extract({x}, '^[a-z]+://[^/?#]*?:([0-9]+)([/?#]|$)', 1) IN ('', '80', '443') THEN '' ELSE ':' || regexp_extract({x}, '^[a-z]+://[^/?#]*?:([0-9]+)([/?#]|$)', 1) END) || "
    f"coalesce(nullif(regexp_extract({x}, '^[a-zA-Z]+://[^/?#]*([^?#;]*)', 1), ''), '/') || "
    f"(CASE WHEN regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1) = '' THEN '' ELSE '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract({x}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda y: y <> '')), '&') END) END)"
)
TEXT = lambda x: f"lower(regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '<script[^>]*>.*?</script>', ' ', 'gis'), '<style[^>]*>.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'))"
HITS = lambda x, terms: f"list_filter({sql_list(sorted(set(terms)))}, lambda zt: contains({x}, zt))"
RAW_HOST = "concat(CASE WHEN page_id % 3 = 0 THEN ' WWW.' ELSE '.' END, upper(split_part(split_part(url, '://', 2), '/', 1)), CASE WHEN page_id % 4 = 0 THEN ':8080' WHEN page_id % 4 = 1 THEN '.' ELSE '' END, CASE WHEN page_id % 10 = 7 THEN '@x' ELSE '' END)"


@query(f"SELECT page_id, CASE WHEN contains(raw, '@') THEN '' ELSE {NH('raw')} END AS host FROM (SELECT page_id, {RAW_HOST} AS raw FROM pages)")
def normalize_host_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_host(F.expr(RAW_HOST)).alias("host"))


@query(f"SELECT page_id, {HOST('u')} AS domain FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN split_part(url, '://', 2) WHEN page_id % 3 = 1 THEN replace(url, '://', '://me@') ELSE url END AS u FROM pages)")
def domain_from_url_pages(spark, sf_dir):
    u = F.expr("CASE WHEN page_id % 3 = 0 THEN split_part(url, '://', 2) WHEN page_id % 3 = 1 THEN replace(url, '://', '://me@') ELSE url END")
    return table(spark, sf_dir, "pages").select("page_id", U.domain_from_url(u).alias("domain"))


ODD_URL = "CASE WHEN page_id % 7 = 0 THEN concat('ftp', url) WHEN page_id % 7 = 1 THEN concat(url, CASE WHEN contains(url, '?') THEN '&' ELSE '?' END, 'z=1&a=2&&b=') WHEN page_id % 7 = 2 THEN regexp_replace(url, '^(https?://[^/?#]*)', '\\1:8443') WHEN page_id % 7 = 3 THEN regexp_replace(url, '^(https?://[^/?#]*)', '\\1:443') WHEN page_id % 7 = 4 THEN concat('mailto:', url) ELSE url END"


@query(f"SELECT page_id, {URL('u')} AS normalized FROM (SELECT page_id, {ODD_URL} AS u FROM pages)")
def normalize_url_pages(spark, sf_dir):
    u = F.expr(ODD_URL.replace("'\\1:", "'$1:"))
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_url(u).alias("normalized"))


ODD_DOMAIN = "concat(CASE WHEN page_id % 5 = 0 THEN 'bad host/' WHEN page_id % 5 = 1 THEN 'HTTPS://user@' ELSE ' ' END, upper(split_part(split_part(url, '://', 2), '/', 1)), CASE WHEN page_id % 4 = 0 THEN ':80/p' WHEN page_id % 4 = 1 THEN '?q#f' ELSE './' END)"


@query(f"""SELECT page_id, CASE WHEN regexp_matches(d, '^[a-z0-9.\\-]+$') THEN d ELSE '' END AS domain FROM (SELECT page_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(
    CASE WHEN contains(trim(raw), '://') THEN regexp_replace(trim(raw), '^.*?://', '') ELSE trim(raw) END, '[/?#].*$', ''), '^.*@', ''), ':[0-9]+$', '')), '^\\.+|\\.+$', '', 'g'), '^www\\.', '') AS d FROM (SELECT page_id, {ODD_DOMAIN} AS raw FROM pages))""")
def normalize_domain_variants(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_domain(F.expr(ODD_DOMAIN)).alias("domain"))


def page_hrefs(pages: DataFrame) -> DataFrame:
    """page_id, pos, url: link targets in normal form, resolved against the page, each once."""
    return pages.select("page_id", F.posexplode(H.page_links(F.col("html"), F.col("url"))).alias("pos", "url"))


ROOTED = "CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || href ELSE href END"


@query(f"""SELECT DISTINCT page_id, {URL('u')} AS url FROM (SELECT page_id, {ROOTED} AS u FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<(?:a|area)\\s[^>]*?href="([^"]*)"', 1, 'i')) AS href FROM pages)) WHERE {URL('u')} IS NOT NULL""")
def extract_links_pages(spark, sf_dir):
    return page_hrefs(table(spark, sf_dir, "pages")).select("page_id", "url").distinct()


def page_state() -> tuple[Column, Column, Column]:
    """Of a fetch: the URL where it ended, whether there is a body, and whether that is HTML."""
    final = F.when(F.coalesce("final_url", F.lit("")) == "", F.col("url")).otherwise(F.col("final_url"))
    fetched = F.col("status").between(200, 399) & (F.coalesce("body", F.lit("")) != "")
    return final, fetched, F.coalesce(fetched & F.lower("content_type").contains("html"), F.lit(False))


def rebranded(log: DataFrame) -> DataFrame:
    """page_id, url, final_url, domain, rebrand_phrase_hits of extracted(), of the pages with such phrases: the others' texts go no further than to be searched. Written, as in redirects()."""
    final, _, is_page = page_state()
    hits = H.page_hits(F.when(is_page, F.col("body")).otherwise(""), L.REBRAND)
    rows = log.withColumn("rebrand_phrase_hits", hits).filter("size(rebrand_phrase_hits) > 0")
    return R.settled(rows.select("page_id", "url", final.alias("final_url"), "rebrand_phrase_hits"), "phrases").select("page_id", "url", "final_url", U.domain_from_url(F.col("final_url")).alias("domain"), "rebrand_phrase_hits")


def extracted(log: DataFrame, chars: int | None = H.TEXT_CHARS) -> DataFrame:
    """The 19 columns of a fetched page (url, final_url, status, content_type, body, error, fetched_at) and its page_id: pages that are no HTML, or not fetched, keep their row with empty signals.
    Terms and footer are of the first `chars` characters of its text, with None of all."""
    final, fetched, is_page = page_state()
    rows = log.withColumns({"final": final, "is_page": is_page}).withColumn("s", H.page_signals(F.when(F.col("is_page"), F.col("body")).otherwise(""), F.col("final"), L.SWEEPS + L.PAYMENT + L.PROVIDERS + L.REBRAND, chars))
    sites = lambda xs: F.array_sort(F.array_distinct(F.filter(F.transform(xs, U.domain_from_url), lambda d: d != "")))
    kind = lambda u: F.when(T.any_of(F.lower(u), L.POLICY_PATHS), "policy").when(T.any_of(F.lower(u), L.SUPPORT_PATHS), "support").otherwise("other")
    of_kind = lambda k: F.slice(F.array_sort(F.array_distinct(F.filter("s.links", lambda u: kind(u) == k))), 1, 80)
    of_list = lambda terms: F.filter("s.hits", lambda t: t.isin(terms))
    path = F.lower(F.regexp_extract("final", r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1))
    notes = F.array(F.concat(F.lit("fetch_error: "), "error"), F.when(F.col("is_page") & T.any_of(path, L.POLICY_PATHS), "policy_like_path"), F.when(F.col("is_page") & T.any_of(path, L.SUPPORT_PATHS), "support_like_path"), F.when(~F.col("is_page") & fetched, "non_html_skipped"))
    return rows.select(
        "page_id", "url", F.col("final").alias("final_url"), U.domain_from_url(F.col("final")).alias("domain"), "status", "content_type", "s.title", "s.meta_description",
        F.substring("s.footer", 1, 1200).alias("footer_legal_snippet"),
        sites(F.col("s.scripts")).alias("script_domains"), sites(F.col("s.iframes")).alias("iframe_domains"), F.slice(sites(F.filter("s.links", lambda u: u.rlike(L.ASSET))), 1, 50).alias("asset_domains"),
        of_kind("support").alias("support_links"), F.slice("s.emails", 1, 40).alias("contact_emails"), of_kind("policy").alias("policy_links"),
        of_list(L.SWEEPS + L.PAYMENT).alias("text_hits"), of_list(L.PROVIDERS).alias("provider_mentions"), of_list(L.REBRAND).alias("rebrand_phrase_hits"),
        F.array_sort(F.array_compact(notes)).alias("notes"), "fetched_at",
    )


LESS_TEXT = "regexp_replace(regexp_replace(regexp_replace(h, '<script[^>]*>.*?</script>', '', 'gis'), '<style[^>]*>.*?</style>', '', 'gis'), '<!--.*?-->', '', 'gs')"
DECODED = lambda x: f"replace(replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
SITES = lambda xs: f"list_sort(list_distinct(list_filter(list_transform({xs}, lambda u: {HOST('u')}), lambda d: d <> '')))"
KIND_OF = lambda u: f"CASE WHEN len({HITS(f'lower({u})', L.POLICY_PATHS)}) > 0 THEN 'policy' WHEN len({HITS(f'lower({u})', L.SUPPORT_PATHS)}) > 0 THEN 'support' ELSE 'other' END"
OF_KIND = lambda k: f"list_sort(list_distinct(list_filter(links, lambda u: {KIND_OF('u')} = '{k}')))[1:80]"


def extracted_sql(log: str, chars: int | None = H.TEXT_CHARS) -> str:
    """The record of each page by expressions, for pages whose tags and entities are regular: double quotes, no white space in tags but between attributes, rooted or whole links, five kinds of entities."""
    path = "lower(regexp_extract(final, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1))"
    seen = f"substr(text, 1, {chars})" if chars else "text"
    from_root = "CASE WHEN starts_with(x, '//') THEN 'https:' || x WHEN starts_with(x, '/') THEN regexp_extract(final, '^([a-zA-Z]+://[^/?#]*)', 1) || x ELSE x END"
    urls = lambda pattern, text: f"list_filter(list_transform(list_transform(regexp_extract_all({text}, '{pattern}', 1, 'i'), lambda x: {DECODED(from_root)}), lambda u: {URL('u')}), lambda u: u IS NOT NULL)"
    squeezed = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"""SELECT page_id, url, final AS final_url, {HOST('final')} AS domain, status, content_type, title, meta_description, substr(trim(right(seen, 4000)), 1, 1200) AS footer_legal_snippet, {SITES('scripts')} AS script_domains, {SITES('frames')} AS iframe_domains,
        {SITES(f"list_filter(links, lambda u: regexp_matches(u, '{L.ASSET}'))")}[1:50] AS asset_domains, {OF_KIND('support')} AS support_links, list_sort(list_distinct(regexp_extract_all(text, '{L.EMAIL}')))[1:40] AS contact_emails, {OF_KIND('policy')} AS policy_links,
        {HITS('lower(seen)', L.SWEEPS + L.PAYMENT)} AS text_hits, {HITS('lower(seen)', L.PROVIDERS)} AS provider_mentions, {HITS('lower(seen)', L.REBRAND)} AS rebrand_phrase_hits,
        list_sort(list_filter(['fetch_error: ' || error, CASE WHEN is_page AND len({HITS(path, L.POLICY_PATHS)}) > 0 THEN 'policy_like_path' END, CASE WHEN is_page AND len({HITS(path, L.SUPPORT_PATHS)}) > 0 THEN 'support_like_path' END, CASE WHEN NOT is_page AND fetched THEN 'non_html_skipped' END], lambda x: x IS NOT NULL)) AS notes
        FROM (SELECT *, {seen} AS seen FROM (SELECT *, {squeezed(DECODED("regexp_extract(shown, '<title[^>]*>(.*?)</title>', 1, 'is')"))} AS title, trim({DECODED("regexp_extract(h, '<meta name=" + '"description" content="([^"]*)"' + "', 1)")}) AS meta_description,
            {squeezed(DECODED("regexp_replace(regexp_replace(shown, '>\\s+<', '><', 'g'), '<[^>]+>', '', 'g')"))} AS text, {urls('<(?:a|link)\\s[^>]*?href="([^"]+)"', 'shown')} AS links, {urls('<script[^>]*?src="([^"]+)"', 'h')} AS scripts, {urls('<iframe[^>]*?src="([^"]+)"', 'h')} AS frames
            FROM (SELECT *, {LESS_TEXT} AS shown FROM (SELECT *, CASE WHEN is_page THEN body ELSE '' END AS h FROM (SELECT *, fetched AND contains(lower(content_type), 'html') AS is_page FROM (
            SELECT *, CASE WHEN coalesce(final_url, '') = '' THEN url ELSE final_url END AS final, status BETWEEN 200 AND 399 AND coalesce(body, '') <> '' AS fetched FROM ({log})))))))"""


@query(extracted_sql("{evidence_log}", None))
def signals_html_parser(spark, sf_dir):
    """All columns of every fetched page, but the time; terms and footer of its whole text."""
    return extracted(fixture(spark, sf_dir, "evidence_log"), None).drop("fetched_at")


@query(f"""SELECT domain, min_by(u, [page_id, pos]) AS discovered_url, CAST(count(DISTINCT page_id) AS BIGINT) AS n_sources, min(page_id) AS first_page FROM (SELECT page_id, pos, {URL('url')} AS u, {HOST('url')} AS domain FROM ({{page_links}})) GROUP BY domain""")
def outbound_domains_first_touch(spark, sf_dir):
    links = fixture(spark, sf_dir, "page_links").select("page_id", "pos", U.normalize_url(F.col("url")).alias("u")).withColumn("domain", U.domain_from_url(F.col("u")))
    return links.groupBy("domain").agg(F.min_by("u", F.struct("page_id", "pos")).alias("discovered_url"), F.count_distinct("page_id").alias("n_sources"), F.min("page_id").alias("first_page"))


HOSTS = f"SELECT page_id, {HOST('url')} AS host FROM pages"
#: Every fourth host, and the parents of every third below one.
LISTED = f"SELECT DISTINCT CASE WHEN page_id % 3 = 1 AND host LIKE '%.%.%.%' THEN substr(host, strpos(host, '.') + 1) ELSE host END AS host FROM ({HOSTS}) WHERE page_id % 16 = 0 OR (page_id % 3 = 1 AND page_id % 2 = 0 AND host LIKE '%.%.%.%')"
UNDER = "EXISTS (SELECT 1 FROM l WHERE h.host = l.host OR ends_with(h.host, '.' || l.host))"


def page_hosts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.domain_from_url(F.col("url")).alias("host"))


def listed(spark, sf_dir) -> DataFrame:
    parent = F.expr("substr(host, instr(host, '.') + 1)")
    return page_hosts(spark, sf_dir).filter("page_id % 16 = 0 or page_id % 3 = 1 and page_id % 2 = 0 and host like '%.%.%.%'").select(F.when(F.expr("page_id % 3 = 1 and host like '%.%.%.%'"), parent).otherwise(F.col("host")).alias("host")).distinct()


@query(f"WITH l AS ({LISTED}) SELECT page_id, host FROM ({HOSTS}) h WHERE NOT {UNDER}")
def deny_anti_join(spark, sf_dir):
    return R.matches_suffix(page_hosts(spark, sf_dir), "host", listed(spark, sf_dir), "left_anti")


@query(f"WITH l AS ({LISTED}) SELECT page_id, host FROM ({HOSTS}) h WHERE {UNDER}")
def allow_semi_join(spark, sf_dir):
    return R.matches_suffix(page_hosts(spark, sf_dir), "host", listed(spark, sf_dir), "left_semi")


def crawl(seeds: DataFrame, links: DataFrame, deny: DataFrame, max_depth: int, max_pages: int, allow: DataFrame | None = None) -> DataFrame:
    """url, depth, seq of pages visited, level by level: exactly the order of a queue. seeds: url, seq. links: from_url, pos, url. Seeds are exempt from lists and budget."""
    seen = R.settled(seeds.groupBy("url").agg(F.min("seq").alias("seq")).withColumn("depth", F.lit(0)))
    level, spent = seen, 0
    for depth in range(1, max_depth + 1):
        found = level.select(F.col("url").alias("from_url"), F.col("seq").alias("parent")).join(links, "from_url").groupBy("url").agg(F.min(F.struct("parent", "pos")).alias("first"))
        found = found.join(seen.select("url"), "url", "left_anti").withColumn("host", U.domain_from_url(F.col("url")))
        fit = R.hosts_within(found.select("host").distinct(), allow, deny)
        found = found.join(fit, "host", "left_semi").orderBy("first.parent", "first.pos").limit(max_pages - spent)
        base = seen.count()
        found = found.withColumn("seq", F.row_number().over(Window.orderBy("first.parent", "first.pos")) + F.lit(base) - 1)  # at most the budget's rows
        level = R.settled(found.select("url", F.col("seq").cast("long").alias("seq"), F.lit(depth).alias("depth")))
        if level.isEmpty():
            break
        spent += level.count()
        seen = R.settled(seen.unionByName(level))
    return seen


#: Where a crawl begins: in one section of the sites. Its budget is a share of the table.
SECTION, SHARE = "/es/", {1: 20, 2: 3}
_LINKED = f"SELECT {URL('f.url')} AS from_url, x.pos, {URL('x.url')} AS url FROM ({{page_links}}) x JOIN pages f ON f.page_id = x.page_id"
_LEVEL = lambda parents, seen, least: f"""SELECT h.url, row_number() OVER (ORDER BY first) AS seq FROM (SELECT k.url, min(p.seq * 10 + k.pos) AS first, {HOST('k.url')} AS host FROM {parents} p JOIN k ON k.from_url = p.url WHERE k.url NOT IN ({seen}) GROUP BY k.url) h
        WHERE NOT {UNDER} QUALIFY seq <= {least}"""  # noqa: E731


def crawl_sql(depth: int) -> str:
    budget = f"(SELECT count(*) // {SHARE[depth]} FROM pages)"
    sql = f"""WITH l AS ({LISTED}), s AS (SELECT {URL('url')} AS url, min(page_id) AS seq FROM pages WHERE contains(url, '{SECTION}') GROUP BY 1), k AS ({_LINKED}), one AS ({_LEVEL('s', 'SELECT url FROM s', budget)})"""
    if depth == 2:
        sql += f", two AS ({_LEVEL('one', 'SELECT url FROM s UNION ALL SELECT url FROM one', f'{budget} - (SELECT count(*) FROM one)')})"
    return sql + " SELECT url, 0 AS depth FROM s UNION ALL SELECT url, 1 FROM one" + (" UNION ALL SELECT url, 2 FROM two" if depth == 2 else "")


def crawled(spark, sf_dir, depth: int) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", U.normalize_url(F.col("url")).alias("u"))
    links = fixture(spark, sf_dir, "page_links").join(pages.select("page_id", "u"), "page_id").select(F.col("u").alias("from_url"), "pos", U.normalize_url(F.col("url")).alias("url"))
    seeds = pages.filter(F.col("url").contains(SECTION)).select(F.col("u").alias("url"), F.col("page_id").alias("seq"))
    return crawl(seeds, links, listed(spark, sf_dir), depth, pages.count() // SHARE[depth]).select("url", "depth")


@query(crawl_sql(1))
def bfs_crawl_depth1_budget(spark, sf_dir):
    """One level from the seeds, under a budget that cuts it."""
    return crawled(spark, sf_dir, 1)


@query(crawl_sql(2))
def bfs_crawl_depth2(spark, sf_dir):
    """Two levels under one budget: the second has what the first leaves."""
    return crawled(spark, sf_dir, 2)


def redirects(log: DataFrame) -> DataFrame:
    """Fetches that ended at another URL, slashes at the end aside. The URLs are written first: Spark would take the comparison of both into a join that makes the log, as that of every page with every other."""
    rows, trail = R.settled(log.select("page_id", "url", "final_url"), "fetches"), lambda c: F.rtrim(c, F.lit("/"))
    return rows.filter(trail(F.col("final_url")) != trail(F.col("url"))).select("page_id", F.col("url").alias("from_url"), F.col("final_url").alias("to_url"), U.domain_from_url(F.col("url")).alias("domain_from"), U.domain_from_url(F.col("final_url")).alias("domain_to"))


MOVED = f"SELECT page_id, url AS from_url, final_url AS to_url, {HOST('url')} AS domain_from, {HOST('final_url')} AS domain_to FROM ({{fetch_log}}) WHERE rtrim(final_url, '/') <> rtrim(url, '/')"


@query(MOVED)
def http_redirects(spark, sf_dir):
    return redirects(fixture(spark, sf_dir, "fetch_log"))


@query(f"SELECT page_id, CAST(length({TEXT('html')}) AS BIGINT) AS n_chars, md5({TEXT('html')}) AS digest FROM ({{pages_lex}})")
def html_to_text_len(spark, sf_dir):
    s = T.html_to_text(F.col("html"))
    return fixture(spark, sf_dir, "pages_lex").select("page_id", F.length(s).cast("long").alias("n_chars"), F.md5(s.cast("binary")).alias("digest"))


@query(f"SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '{L.EMAIL}'))) AS emails FROM documents WHERE regexp_matches(text, '{L.EMAIL}')")
def emails_in_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.emails(F.col("text"), L.EMAIL).alias("emails")).filter("size(emails) > 0")


@query(f"SELECT page_id, list_sort({HITS('t', L.VERIFY)}) AS hits, CAST(len({HITS('t', L.PROVIDERS)}) AS BIGINT) AS n_providers FROM (SELECT page_id, {TEXT('html')} AS t FROM ({{pages_lex}}))")
def keyword_hits_lex(spark, sf_dir):
    t = T.html_to_text(F.col("html"))
    return fixture(spark, sf_dir, "pages_lex").select("page_id", t.alias("t")).select("page_id", T.hits(F.col("t"), L.VERIFY).alias("hits"), F.size(T.hits(F.col("t"), L.PROVIDERS)).cast("long").alias("n_providers"))


def page_risk(hits: Column, fields: Column) -> Column:
    """0 to 100: four points a weight, at most 85, and five for each field hint."""
    weight = F.create_map(*(x for k, w in sorted(L.RISK.items()) for x in (F.lit(k), F.lit(w))))
    keywords = F.aggregate(hits, F.lit(0.0), lambda acc, t: acc + weight[t] * 4)
    return F.least(F.lit(100.0), F.round(F.least(F.lit(85.0), keywords) + fields * 5.0, 2))


@query(f"""SELECT page_id, hits, list_concat(list_transform(hits, lambda h: 'keyword:' || h), CASE WHEN f > 0 THEN ['field:password'] ELSE [] END, CASE WHEN len(hits) = 0 AND f = 0 THEN ['no_risk_keywords'] ELSE [] END) AS risk_reasons,
    least(100.0::DOUBLE, round(least(85.0::DOUBLE, coalesce(list_sum(list_transform(hits, lambda h: 4 * (CASE {' '.join(f"WHEN h = '{k}' THEN {w}" for k, w in L.RISK.items())} END)::DOUBLE)), 0)) + f * 5.0::DOUBLE, 2)) AS risk_score
    FROM (SELECT page_id, list_sort({HITS('t', list(L.RISK))}) AS hits, CASE WHEN page_id % 6 = 0 THEN 1 ELSE 0 END AS f FROM (SELECT page_id, {TEXT('html')} AS t FROM ({{pages_lex}})))""")
def page_risk_lex(spark, sf_dir):
    rows = fixture(spark, sf_dir, "pages_lex").select("page_id", T.hits(T.html_to_text(F.col("html")), list(L.RISK)).alias("hits"), F.when(F.col("page_id") % 6 == 0, 1).otherwise(0).alias("f"))
    none = F.array().cast("array<string>")
    reasons = F.concat(
        F.transform("hits", lambda h: F.concat(F.lit("keyword:"), h)),
        F.when(F.col("f") > 0, F.array(F.lit("field:password"))).otherwise(none),
        F.when((F.size("hits") == 0) & (F.col("f") == 0), F.array(F.lit("no_risk_keywords"))).otherwise(none),
    )
    return rows.select("page_id", "hits", F.slice(reasons, 1, 40).alias("risk_reasons"), page_risk(F.col("hits"), F.col("f")).alias("risk_score"))


EXTRA = ["/terms", "/Privacy.html", "/help-center", "/faq?x=1", "/style.CSS", "/app.js?v=2", "/img/a.png", "/play", "/cookie/faq"]


def lex_links(pages: DataFrame) -> DataFrame:
    """page_id, url: each page's host with one more path."""
    paths = F.array(*map(F.lit, EXTRA))
    return pages.select("page_id", F.concat(F.lit("https://"), U.domain_from_url(F.col("url")), F.get(paths, (F.col("page_id") % len(EXTRA)).cast("int"))).alias("url"))


LINKS = f"SELECT page_id, 'https://' || {HOST('url')} || {sql_list(EXTRA)}[page_id % {len(EXTRA)} + 1] AS url FROM pages"


@query(f"SELECT page_id, CASE WHEN len({HITS('lower(url)', L.POLICY_PATHS)}) > 0 THEN 'policy' WHEN len({HITS('lower(url)', L.SUPPORT_PATHS)}) > 0 THEN 'support' ELSE 'other' END AS kind FROM ({LINKS})")
def link_categories(spark, sf_dir):
    u = F.lower("url")
    return lex_links(table(spark, sf_dir, "pages")).select("page_id", F.when(T.any_of(u, L.POLICY_PATHS), "policy").when(T.any_of(u, L.SUPPORT_PATHS), "support").otherwise("other").alias("kind"))


@query(f"SELECT {HOST('url')} AS domain, CAST(count(*) AS BIGINT) AS n_assets FROM ({LINKS}) WHERE regexp_matches(url, '{L.ASSET}') GROUP BY 1")
def asset_links(spark, sf_dir):
    return lex_links(table(spark, sf_dir, "pages")).filter(F.col("url").rlike(L.ASSET)).groupBy(U.domain_from_url(F.col("url")).alias("domain")).agg(F.count("*").alias("n_assets"))


def classified(rows: DataFrame) -> DataFrame:
    """title, meta, text_hits, policy_links, support_links (counts), provider_mentions -> four scores, label, confidence, reasoning. Sums are doubles, in this order."""
    blob = F.lower(F.concat_ws(" ", "title", "meta"))
    add = lambda *xs: sum(xs[1:], xs[0])
    when = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
    times = lambda terms, v: F.aggregate(F.array(*map(F.lit, terms)), F.lit(0.0), lambda a, t: F.when(blob.contains(t), a + v).otherwise(a))
    operator = add(when(T.any_of(blob, ["social casino", "sweepstakes", "slots", "casino"]), 0.25), when(T.any_of(blob, ["gold coins", "sweeps", "redeem"]), 0.2))
    operator = F.aggregate(F.filter("text_hits", lambda t: t.isin(L.SWEEPS)), operator, lambda a, _: a + 0.06) + when(F.col("policy_links") > 0, 0.12)
    promoter = times(L.PROMOTER, 0.2) + when(F.col("support_links") > 8, 0.1) + when((F.col("policy_links") < 2) & T.any_of(blob, ["review", "compare", "best"]), 0.15)
    n = F.size("provider_mentions")
    provider = F.when(n == 0, 0.0).otherwise(F.least(0.35 + 0.1 * F.least(n, F.lit(4)), F.lit(1.0)))
    payment = F.aggregate(F.array(*map(F.lit, L.PAYMENT)), F.aggregate(F.filter("text_hits", lambda t: t.isin(L.PAYMENT)), F.lit(0.0), lambda a, _: a + 0.12), lambda a, t: F.when(blob.contains(t), a + 0.1).otherwise(a))
    s = rows.select("*", *(F.least(F.lit(1.0), x).alias(c) for c, x in (("operator", operator), ("promoter", promoter), ("provider", provider), ("payment", payment))))
    best = F.greatest("operator", "promoter", "provider", "payment")
    top = F.when(F.col("operator") == best, "likely_operator").when(F.col("promoter") == best, "likely_promoter").when(F.col("provider") == best, "likely_provider").otherwise("likely_payment_path")
    s = s.withColumn("best", best).withColumn("top", top)
    turned = (F.col("top") == "likely_provider") & (F.col("operator") > 0.35)
    label = F.when(F.col("best") < 0.15, "unknown").when(turned, "likely_operator").otherwise(F.col("top"))
    sure = F.when(F.col("best") < 0.15, 0.1).when(turned, F.col("operator")).otherwise(F.col("best"))
    also = lambda c: F.when(F.col(c) > 0.2, F.concat(F.lit(f"likely_{c}="), T.two_decimals(F.col(c))))
    named = F.when(n > 0, F.concat(F.lit("provider mentions: "), F.array_join(F.slice("provider_mentions", 1, 6), ", ")))
    highest = F.concat(F.lit("highest rule score for "), "top", F.lit(" ("), T.two_decimals(F.col("best")), F.lit(")"))
    outweighed = F.array(F.lit("operator signals outweighed provider-only mentions"), F.concat(F.lit("likely_operator score="), T.two_decimals(F.col("operator"))))
    reasoning = F.when(F.col("best") < 0.15, F.array(F.lit("insufficient keyword signals"))).when(turned, outweighed).otherwise(F.array_compact(F.array(highest, also("operator"), also("promoter"), named)))
    return s.withColumn("reasoning", reasoning).withColumns({"label": label, "confidence_hint": F.round(sure, 4), **{c: F.round(c, 4) for c in ("operator", "promoter", "provider", "payment")}})


def signals(spark, sf_dir) -> DataFrame:
    rows = fixture(spark, sf_dir, "pages_lex").select("page_id", "url", "title", "meta", T.html_to_text(F.col("html")).alias("t"))
    return rows.select("page_id", "url", "title", "meta", T.hits(F.col("t"), L.SWEEPS + L.PAYMENT).alias("text_hits"), (F.col("page_id") % 3).cast("int").alias("policy_links"), (F.col("page_id") % 12).cast("int").alias("support_links"), T.hits(F.col("t"), L.PROVIDERS).alias("provider_mentions"))


FOLD = lambda xs, start, step: f"list_reduce(list_concat([({start})::DOUBLE], list_transform({xs}, lambda z: ({step})::DOUBLE)), lambda a, b: a + b)"
HAS = lambda terms: f"len({HITS('blob', terms)}) > 0"
REASONS = """CASE WHEN best < 0.15::DOUBLE THEN ['insufficient keyword signals'] WHEN top = 'likely_provider' AND o > 0.35::DOUBLE THEN ['operator signals outweighed provider-only mentions', 'likely_operator score=' || printf('%.2f', o)]
        ELSE list_filter(['highest rule score for ' || top || ' (' || printf('%.2f', best) || ')', CASE WHEN o > 0.2::DOUBLE THEN 'likely_operator=' || printf('%.2f', o) END, CASE WHEN p > 0.2::DOUBLE THEN 'likely_promoter=' || printf('%.2f', p) END,
            CASE WHEN len(mentions) > 0 THEN 'provider mentions: ' || array_to_string(mentions[1:6], ', ') END], lambda x: x IS NOT NULL) END"""


def classified_sql(source: str) -> str:
    """Scores, label, confidence and reasons of rows page_id, url, blob (title and description, in lower case), th (hits), policy, support (counts), mentions."""
    return f"""SELECT page_id, url, policy, round(o, 4) AS operator, round(p, 4) AS promoter, round(v, 4) AS provider, round(y, 4) AS payment,
    CASE WHEN best < 0.15::DOUBLE THEN 'unknown' WHEN top = 'likely_provider' AND o > 0.35::DOUBLE THEN 'likely_operator' ELSE top END AS label,
    round(CASE WHEN best < 0.15::DOUBLE THEN 0.1::DOUBLE WHEN top = 'likely_provider' AND o > 0.35::DOUBLE THEN o ELSE best END, 4) AS confidence_hint,
    {REASONS} AS reasoning
    FROM (SELECT *, CASE WHEN o = best THEN 'likely_operator' WHEN p = best THEN 'likely_promoter' WHEN v = best THEN 'likely_provider' ELSE 'likely_payment_path' END AS top FROM (SELECT *, greatest(o, p, v, y) AS best FROM (
    SELECT page_id, url, policy, mentions, least(1.0::DOUBLE, {FOLD("list_filter(th, lambda q: list_contains(" + sql_list(L.SWEEPS) + ", q))", f"(CASE WHEN {HAS(['social casino', 'sweepstakes', 'slots', 'casino'])} THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN {HAS(['gold coins', 'sweeps', 'redeem'])} THEN 0.2::DOUBLE ELSE 0 END)", "0.06")} + (CASE WHEN policy > 0 THEN 0.12::DOUBLE ELSE 0 END)) AS o,
    least(1.0::DOUBLE, {FOLD(HITS('blob', L.PROMOTER), '0', '0.2')} + (CASE WHEN support > 8 THEN 0.1::DOUBLE ELSE 0 END) + (CASE WHEN policy < 2 AND {HAS(['review', 'compare', 'best'])} THEN 0.15::DOUBLE ELSE 0 END)) AS p,
    CASE WHEN np = 0 THEN 0::DOUBLE ELSE least(0.35::DOUBLE + 0.1::DOUBLE * least(np, 4), 1.0::DOUBLE) END AS v,
    least(1.0::DOUBLE, {FOLD(HITS('blob', L.PAYMENT), FOLD("list_filter(th, lambda q: list_contains(" + sql_list(L.PAYMENT) + ", q))", '0', '0.12'), '0.1')}) AS y
    FROM (SELECT *, len(mentions) AS np FROM ({source})))))"""


CLASSIFIED = classified_sql(f"SELECT page_id, url, lower(title || ' ' || meta) AS blob, {HITS('t', L.SWEEPS + L.PAYMENT)} AS th, page_id % 3 AS policy, page_id % 12 AS support, {HITS('t', L.PROVIDERS)} AS mentions FROM (SELECT *, {TEXT('html')} AS t FROM ({{pages_lex}}))")


@query(f"SELECT page_id, operator, promoter, provider, payment, label, confidence_hint FROM ({CLASSIFIED})")
def classify_label(spark, sf_dir):
    return classified(signals(spark, sf_dir)).select("page_id", "operator", "promoter", "provider", "payment", "label", "confidence_hint")


@query(f"SELECT page_id, operator, promoter, provider, payment FROM ({CLASSIFIED})")
def classify_scores(spark, sf_dir):
    return classified(signals(spark, sf_dir)).select("page_id", "operator", "promoter", "provider", "payment")


@query(f"SELECT page_id, reasoning FROM ({CLASSIFIED})")
def classify_reasons(spark, sf_dir):
    return classified(signals(spark, sf_dir)).select("page_id", "reasoning")


@query(f"SELECT label, CAST(count(*) AS BIGINT) AS n FROM ({CLASSIFIED}) GROUP BY label")
def classification_counts(spark, sf_dir):
    return classified(signals(spark, sf_dir)).groupBy("label").agg(F.count("*").alias("n"))


FOUND = f"SELECT host AS domain, CASE WHEN min(page_id) % 5 = 0 THEN 'http_redirect' ELSE 'link' END AS discovery_type FROM ({HOSTS}) GROUP BY host UNION ALL SELECT 'sub.' || host, 'link' FROM ({LISTED}) WHERE length(host) % 2 = 0 GROUP BY host"


@query(f"""WITH l AS ({LISTED}), d AS (SELECT domain, min(discovery_type) AS discovery_type FROM ({FOUND}) GROUP BY 1), m AS (SELECT d.domain, min(l.host) AS matched FROM d JOIN l ON l.host <> d.domain AND (ends_with(d.domain, '.' || l.host) OR ends_with(l.host, '.' || d.domain)) GROUP BY 1)
    SELECT d.domain, CASE WHEN d.domain IN (SELECT host FROM l) THEN 'already_known' WHEN m.matched IS NOT NULL THEN 'possible_same_cluster' WHEN discovery_type = 'http_redirect' THEN 'possible_rebrand' ELSE 'net_new' END AS bridge_status,
    CASE WHEN d.domain IN (SELECT host FROM l) THEN NULL ELSE m.matched END AS matched FROM d LEFT JOIN m ON m.domain = d.domain""")
def intel_bridge_status(spark, sf_dir):
    known = listed(spark, sf_dir)
    own = page_hosts(spark, sf_dir).groupBy(F.col("host").alias("domain")).agg(F.min("page_id").alias("p")).select("domain", F.when(F.col("p") % 5 == 0, "http_redirect").otherwise("link").alias("discovery_type"))
    below = known.filter("length(host) % 2 = 0").select(F.concat(F.lit("sub."), "host").alias("domain"), F.lit("link").alias("discovery_type"))
    return R.bridge(own.unionByName(below).groupBy("domain").agg(F.min("discovery_type").alias("discovery_type")), known)


@query("""SELECT CAST(count(*) AS BIGINT) AS fetched, CAST(count(DISTINCT url) AS BIGINT) AS urls, CAST(count(*) FILTER (status BETWEEN 200 AND 399 AND contains(lower(content_type), 'html') AND body <> '') AS BIGINT) AS html_pages,
    CAST(count(*) FILTER (rtrim(final_url, '/') <> rtrim(url, '/')) AS BIGINT) AS redirects, CAST(count(*) FILTER (error IS NOT NULL OR NOT dns_ok) AS BIGINT) AS partial FROM ({fetch_log})""")
def stage_counters(spark, sf_dir):
    trail = lambda c: F.regexp_replace(c, "/+$", "")
    return fixture(spark, sf_dir, "fetch_log").agg(
        F.count("*").alias("fetched"),
        F.count_distinct("url").alias("urls"),
        F.count_if(F.expr("status between 200 and 399 and contains(lower(content_type), 'html') and body <> ''")).alias("html_pages"),
        F.count_if(trail("final_url") != trail("url")).alias("redirects"),
        F.count_if(F.expr("error is not null or not dns_ok")).alias("partial"),
    )
