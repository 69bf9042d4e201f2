"""Derived inputs, in SQL that Spark and DuckDB both read: {name} stands for a table, and for earlier derived inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.lexicon import PAYMENT, PROMOTER, PROVIDERS, REBRAND, RISK, SWEEPS

LEX = sorted({*SWEEPS, *PAYMENT, *PROMOTER, *PROVIDERS, *REBRAND, *RISK, "review"} - {"light & wonder"})
_pick = lambda k: f"split_part('{'|'.join(LEX)}', '|', CAST((page_id * 7 + {k} * 13) % {len(LEX)} AS INT) + 1)"

FIXTURES = {
    "pages_lex": f"""SELECT page_id, url, concat('<meta name="description" content="', {_pick(3)}, '">', html, CASE WHEN page_id % 4 = 0 THEN '<a href="/Terms-Of-Use?b=2&amp;a=1">t</a><a href="https://www.elsewhere.example/privacy">p</a><a href="/rules">r</a><a href="/rules">r</a>' ELSE '' END, ' <p>', {_pick(0)}, ' ', {_pick(1)}, ' ', {_pick(2)}, '</p>') AS html,
        concat({_pick(4)}, ' | ', {_pick(5)}) AS title, {_pick(3)} AS meta FROM {{pages}}""",
    "queue_pages": "SELECT page_id, url FROM {pages} UNION ALL SELECT -1 AS page_id, 'https://never.fetched.example/' AS url",
    "n_pages": "SELECT count(*) AS n FROM {pages}",
    "page_links": """SELECT s.page_id, 0 AS pos, t.url FROM {pages} s CROSS JOIN ({n_pages}) c JOIN {pages} t ON t.page_id = (3 * s.page_id + 1) % c.n
        UNION ALL SELECT s.page_id, 1 AS pos, t.url FROM {pages} s CROSS JOIN ({n_pages}) c JOIN {pages} t ON t.page_id = (5 * s.page_id + 2) % c.n""",
    "fetch_log": """SELECT p.page_id, p.url, CASE WHEN p.page_id % 9 = 0 THEN q.url WHEN p.page_id % 19 = 0 THEN '' ELSE p.url END AS final_url, CASE WHEN p.page_id % 11 = 0 THEN 404 ELSE 200 END AS status,
        CASE WHEN p.page_id % 13 = 0 THEN 'application/pdf' ELSE 'text/HTML; charset=utf-8' END AS content_type, CASE WHEN p.page_id % 17 = 0 THEN '' ELSE p.html END AS body,
        CASE WHEN p.page_id % 11 = 0 THEN 'http_error' END AS error, CASE WHEN p.page_id % 23 = 0 THEN NULL ELSE p.page_id % 7 <> 3 END AS dns_ok, p.title, p.meta
        FROM ({pages_lex}) p CROSS JOIN ({n_pages}) c JOIN {pages} q ON q.page_id = (7 * p.page_id + 3) % c.n""",
    "net_log": """SELECT host, k, CASE WHEN k % 4 = 0 THEN '2.2.2.2|1.1.1.1|2.2.2.2' ELSE '' END AS a, CASE WHEN k % 4 = 1 OR k % 4 = 2 THEN 'no A' END AS a_error, CASE WHEN k % 6 = 0 THEN '::1' ELSE '' END AS aaaa, CASE WHEN k % 6 = 1 THEN 'no AAAA' END AS aaaa_error,
        concat('NS2.', host, '.|ns1.', host, '|ns1.', upper(host)) AS ns, CASE WHEN k % 5 = 0 THEN 'timeout' END AS ns_error, concat('10 mx1.', host, '.|5 MX2.', host) AS mx, CASE WHEN k % 7 = 0 THEN 'refused' END AS mx_error,
        CASE WHEN k % 4 = 3 THEN 'subject=O = Org' ELSE concat('subject=C=US, O=Org, CN = ', host) END AS subject, concat('issuer=CN=old, O=Org, CN = CA ', CAST(k % 3 AS VARCHAR(20))) AS issuer, concat('notBefore=May  3 12:00:00 2025 GMT
notAfter=', CASE WHEN k % 4 = 0 THEN 'never' ELSE 'May 30 12:00:00 2026 GMT' END) AS dates, concat('DNS:', upper(host), ', DNS:a.', host, ', DNS:', host) AS names, CASE WHEN k % 9 = 0 THEN 'handshake' END AS tls_error
        FROM (SELECT CASE WHEN substring(h, 1, 4) = 'www.' THEN substring(h, 5, 200) ELSE h END AS host, min(page_id) AS k FROM (SELECT page_id, lower(split_part(split_part(split_part(url, '://', 2), '/', 1), ':', 1)) AS h FROM {pages}) t GROUP BY 1) x""",
    "attempt_urls": """SELECT page_id, concat(url, CASE WHEN contains(url, '?') THEN '&' ELSE '?' END, 'p=', CAST(page_id AS VARCHAR(20))) AS url, html FROM {pages}""",
    "fetch_attempts": """SELECT page_id, url, attempt, CASE WHEN kind = 'ok' THEN 200 WHEN kind = 'http' THEN 500 + attempt END AS status, CASE WHEN kind = 'fail' THEN NULL WHEN page_id % 7 = 0 THEN '' WHEN page_id % 3 = 0 THEN concat(url, '&moved=1') ELSE url END AS final_url,
        CASE WHEN kind <> 'fail' THEN 'text/html' END AS content_type, CASE WHEN kind = 'ok' AND page_id % 40 = 5 THEN repeat('x', 2000100) WHEN kind = 'ok' THEN html WHEN kind = 'http' AND page_id % 4 = 0 THEN 'not found' END AS body,
        CASE WHEN kind = 'http' THEN concat('HTTP Error ', CAST(500 + attempt AS VARCHAR(20))) WHEN kind = 'fail' THEN concat('timed out ', CAST(attempt AS VARCHAR(20))) END AS error
        FROM (SELECT u.*, a.attempt, CASE WHEN page_id % 5 = 0 THEN 'ok' WHEN page_id % 5 = 1 THEN CASE WHEN attempt = 0 THEN 'fail' ELSE 'ok' END WHEN page_id % 5 = 2 THEN CASE WHEN attempt < 2 THEN 'fail' ELSE 'http' END WHEN page_id % 5 = 3 THEN CASE WHEN attempt < 3 THEN 'fail' ELSE 'ok' END
            ELSE CASE WHEN attempt = 0 THEN 'http' ELSE 'ok' END END AS kind FROM ({attempt_urls}) u CROSS JOIN (SELECT 0 AS attempt UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) a WHERE page_id % 50 <> 7 AND (page_id % 20 <> 8 OR attempt < 2))""",
    "evidence_log": """SELECT page_id, url, final_url, status, content_type, CASE WHEN body = '' THEN '' ELSE concat(body, ' <p>', CASE WHEN page_id % 8 = 1 THEN 'We have moved, formerly ' ELSE '' END, title, ' &amp; ', meta, '</p>', CASE WHEN page_id % 5 = 2 THEN '<script src="//cdn.example/a.js?v=1"></script><script src="/own.js">x</script><iframe src="https://www.frame.example:8443/f"></iframe>' ELSE '' END,
        CASE WHEN page_id % 6 = 3 THEN concat('<a href="/help/contact">c</a><a href="/logo.png">l</a><link rel="x" href="https://static.example/s.css?x"><p>mail info@site', CAST(page_id AS VARCHAR(20)), '.example</p>') ELSE '' END) END AS body, error, CAST(NULL AS VARCHAR(20)) AS fetched_at FROM ({fetch_log})""",
    "candidates": """SELECT concat('c', lpad(CAST(p_partkey AS VARCHAR(20)), 8, '0')) AS candidate_id, p_partkey AS k,
        CASE WHEN p_partkey % 23 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN upper(concat(p_name, '  ', p_brand, CAST(p_partkey % 40 AS VARCHAR(20)))) WHEN p_partkey % 29 = 0 THEN 'VGW'
             WHEN p_partkey % 31 = 0 THEN 'winz slots' WHEN p_partkey % 37 = 0 THEN 'wins gold.com casino' WHEN p_partkey % 41 = 0 THEN 'bet' ELSE concat(p_name, ' ', p_brand, CAST(p_partkey % 40 AS VARCHAR(20))) END AS brand,
        CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 6 = 0 THEN concat('https://www.Site', CAST(p_partkey % 1500 AS VARCHAR(20)), '.com:8080/path?x=1')
             WHEN p_partkey % 6 = 1 THEN concat('user@site', CAST(p_partkey % 1500 AS VARCHAR(20)), '.net') WHEN p_partkey % 47 = 0 THEN 'not a domain!' ELSE concat('Play.site', CAST(p_partkey % 1500 AS VARCHAR(20)), '.us/') END AS raw_domain,
        CASE WHEN p_partkey % 7 = 0 THEN concat('a', CAST(p_partkey % 50 AS VARCHAR(20)), '.com; b.org|') WHEN p_partkey % 7 = 1 THEN 'one.net' ELSE '' END AS other_domains,
        split_part('high|med|low|hi|72%|0.5|88|1.5|abc|| 45 %|0.4499', '|', CAST(p_partkey % 12 AS INT) + 1) AS raw_confidence,
        split_part('operator|Affiliate listing|review site|Holding company|skill game|formerly X|giveaway sweepstakes|casino|social media giveaway|Papaya Gaming|none|sweepstakes.com', '|', CAST(p_partkey % 12 AS INT) + 1) AS category,
        concat('Rating: ', CAST(p_partkey % 5 AS VARCHAR(20)), '/5 ', p_type) AS notes FROM {part}""",
    "bulk_lines": """SELECT line, CASE CAST(line % 20 AS INT) WHEN 0 THEN concat('| ', name, ' | https://', site, '.com/x | rating: 4.5 | more |') WHEN 1 THEN '|---|:--:|'
        WHEN 2 THEN concat('brand: ', name, ' domain: ', site, '.net') WHEN 3 THEN concat(name, ' - http://www.', site, '.us/p?q=1 bonus: 5 coins') WHEN 4 THEN '# comment'
        WHEN 5 THEN concat('mail me@x.com or see ', site, '.org conf: 80% since 2019 games: 1,200') WHEN 6 THEN '   ' WHEN 7 THEN concat('domain: ', site, '.io name: ', name)
        WHEN 8 THEN '| Brand | Domain |' WHEN 9 THEN concat('| ', name, ' | ', site, '.com | note') WHEN 10 THEN concat(name, '|', site, '.com') WHEN 11 THEN concat(name, chr(9), site, '.com', chr(9), 'two', chr(9), 'notes')
        WHEN 12 THEN concat('| ', site, '.com |') WHEN 13 THEN concat('http://', site, '.com/a ', name) WHEN 14 THEN concat(site, '.png and user@', site, '.com only') WHEN 15 THEN '=====' WHEN 16 THEN concat('| ', name, ' | none | ', site, '.com |')
        WHEN 17 THEN concat('https://', site, '.com/') WHEN 18 THEN 'x' ELSE concat('  ', site, '.com: ', name, ' est. 2020') END AS text
        FROM (SELECT s_suppkey AS line, s_name AS name, concat('site', CAST(s_suppkey AS VARCHAR(20))) AS site FROM {supplier})""",
    "md_lines": """SELECT s_suppkey % 3 AS file, s_suppkey AS pos, CASE WHEN s_suppkey < 4 THEN '| Brand | Primary  Domain | Notes |' WHEN s_suppkey % 10 = 4 THEN '|---|---|---|' WHEN s_suppkey % 10 = 5 THEN concat('| ', s_name, ' |')
        WHEN s_suppkey % 10 = 6 THEN concat('| ', s_name, ' | a.com | n | more | cells |') WHEN s_suppkey % 10 = 7 THEN 'plain text' ELSE concat('| ', s_name, ' | site', CAST(s_suppkey AS VARCHAR(20)), '.com | n', CAST(s_suppkey AS VARCHAR(20)), ' |') END AS text FROM {supplier}""",
    "provider_answers": """SELECT candidate_id, tier, k % 11 <> 0 AS has_key, CASE WHEN k % 6 = 1 THEN '{"family_hints": "kept", "entity_type_guess": "odd", "confidence_hint": null}' END AS cached, k % 12 = 1 AS refresh, CASE WHEN k % 7 = 2 THEN concat('timeout ', CAST(k AS VARCHAR(20))) END AS error,
        CASE CAST(k % 7 AS INT) WHEN 0 THEN concat('Sure:
```json
', j, '
```
Done.') WHEN 1 THEN concat('The answer is ', j, ' as asked.') WHEN 2 THEN '' WHEN 3 THEN 'no object' WHEN 4 THEN '{"a": ' WHEN 5 THEN '{}' ELSE j END AS text FROM (SELECT candidate_id, k, tier, concat('{"entity_type_guess": "', split_part('likely_promoter| unresolved |other|likely_noise', '|', CAST(k % 4 AS INT) + 1),
        '", "citations": ', split_part('["u1", "", "u2"]#"single"#null', '#', CAST(k % 3 AS INT) + 1), ', "extracted_domains": [" A.com ", "b', CAST(k AS VARCHAR(20)), '.NET"], "family_hints": ["f"], "confidence_hint": ', split_part('1.7|"0.5"|null|"x"|0.0|0.31', '|', CAST(k % 6 AS INT) + 1), ', "notes": "n', CAST(k AS VARCHAR(20)), '", "footer_or_company_phrases": ["p1", "p2"], "same_backend_or_legal_language_hint": "', CASE WHEN k % 2 = 0 THEN 'h' ELSE '' END, '"}') AS j
        FROM (SELECT concat('j', CAST(c_custkey AS VARCHAR(20))) AS candidate_id, c_custkey * 3 + tier AS k, tier FROM {customer} CROSS JOIN (SELECT 1 AS tier UNION ALL SELECT 2 UNION ALL SELECT 3) t))""",
    "mesh_answers": """SELECT k, tier, status, CASE WHEN status = 'unavailable' OR k % 29 = 3 THEN 'unavailable' WHEN status = 'error' THEN 'error' WHEN k % 5 = 0 THEN NULL ELSE 'ok' END AS provider_status,
        split_part('likely_real_operator|unresolved|likely_redirect_or_rebrand|likely_noise|likely_promoter', '|', CAST((k * (1 + tier) + tier) % 5 AS INT) + 1) AS entity_type_guess,
        CASE WHEN (k + tier) % 9 = 4 THEN NULL ELSE CAST((k * 7 + tier * 3) % 101 AS DOUBLE) / 100 END AS confidence_hint,
        CASE WHEN (k + tier) % 5 = 0 THEN '' WHEN k % 3 = 0 AND tier = 1 THEN concat('d', CAST(k AS VARCHAR(20)), '.com|e.net|e.net') WHEN k % 3 = 0 THEN concat('e.net|d', CAST(k AS VARCHAR(20)), '.com') ELSE concat('f', CAST(k % (2 + tier) AS VARCHAR(20)), '.org') END AS domains,
        CASE WHEN (k + 3 * tier) % 8 = 0 THEN concat('fam', CAST(tier AS VARCHAR(20))) ELSE '' END AS family_hints
        FROM (SELECT p_partkey AS k, tier, CASE WHEN (p_partkey * 3 + tier) % 11 = 0 THEN 'unavailable' WHEN (p_partkey + tier) % 13 = 0 THEN 'error' WHEN (p_partkey + tier) % 17 = 0 THEN 'stub' ELSE 'ok' END AS status
        FROM {part} CROSS JOIN (SELECT 1 AS tier UNION ALL SELECT 2) t)""",
    "provider_result": """SELECT concat('j', CAST(c_custkey AS VARCHAR(20))) AS candidate_id, concat('Brand ', CAST(c_custkey % 300 AS VARCHAR(20))) AS brand, p.name AS provider_name, p.i AS i,
        CASE WHEN (c_custkey * 3 + p.i) % 11 = 0 AND p.i > 0 THEN 'unavailable' WHEN (c_custkey + p.i) % 13 = 0 AND p.i > 0 THEN 'error' WHEN (c_custkey + p.i) % 17 = 0 AND p.i > 0 THEN 'stub' ELSE 'ok' END AS status,
        (c_custkey + p.i) % 4 = 0 AND p.i > 0 AS cached,
        split_part('likely_real_operator|unresolved|likely_redirect_or_rebrand|likely_noise|likely_promoter', '|', CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 5 ELSE (c_custkey * (1 + p.i)) % 5 END AS INT) + 1) AS entity_type_guess,
        CAST(((c_custkey * 7 + p.i * 3) % 101) AS DOUBLE) / 100 AS confidence_hint,
        CASE WHEN (c_custkey + p.i) % 5 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN concat('d', CAST(c_custkey AS VARCHAR(20)), '.com') ELSE concat('d', CAST(c_custkey AS VARCHAR(20)), '.com|e', CAST((c_custkey + p.i) % 3 AS VARCHAR(20)), '.net') END AS domains,
        CASE WHEN c_custkey % 19 = 0 THEN 'fam' ELSE '' END AS family_hints, CASE WHEN c_custkey % 6 = 0 THEN 'r' ELSE '' END AS redirect_hints, CAST(c_custkey % 60 AS DOUBLE) AS risk_score,
        split_part('coming_soon|newly_listed|existing_family|new_social|listed', '|', CAST(c_custkey % 5 AS INT) + 1) AS status_hint,
        CASE WHEN c_custkey % 7 = 0 THEN 'SweepsKings list' WHEN c_custkey % 4 = 0 THEN 'x|y|z' WHEN c_custkey % 4 = 1 THEN 'family page' ELSE 'x' END AS discovery_source
        FROM {customer} CROSS JOIN (SELECT 0 AS i, 'deterministic' AS name UNION ALL SELECT 1, 'tier1' UNION ALL SELECT 2, 'tier2' UNION ALL SELECT 3, 'tier3') p""",
}

def _expand(sql: str, table) -> str:
    """Names in braces: derived inputs in parentheses as they stand, tables through `table`. In a FROM a derived input needs its parentheses around the braces."""
    while True:
        new = re.sub(r"\(\{([a-z]\w*)\}\)", lambda m: f"({FIXTURES[m[1]]})" if m[1] in FIXTURES else m[0], sql)
        new = re.sub(r"\{([a-z]\w*)\}", lambda m: table(m[1]) if m[1] not in FIXTURES else f"({FIXTURES[m[1]]})", new)
        if new == sql:
            return sql
        sql = new


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(_expand(FIXTURES[name], lambda t: f"parquet.`{sf_dir}/{t}.parquet`"))


def duck(sql: str) -> str:
    """Oracle SQL with the derived inputs written out."""
    return _expand(sql, lambda t: t)
