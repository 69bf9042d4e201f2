"""Every query against its SQL on the smallest tables, and branch coverage of the rules."""

import duckdb
import pytest

from millrace.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def norm(v):
    if v is None or v != v:
        return "-"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_against_sql(spark, data, duck, name):
    df = catalog.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(catalog.ORACLE[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())
    assert got


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name, column, values", [
    ("bucket_classify", "bucket", {"corporate_entities", "operators", "promoters", "redirects_rebrands", "rejected_or_ambiguous"}),
    ("verify_score_status", "verification_status", {"reachable", "redirected", "unclear", "unreachable"}),
    ("intel_bridge_status", "bridge_status", {"already_known", "possible_same_cluster", "possible_rebrand", "net_new"}),
    ("link_categories", "kind", {"policy", "support", "other"}),
])
def test_branches_are_hit(spark, name, column, values):
    assert {r[column] for r in catalog.QUERIES[name](spark, "/root/testdata/sf0.01").select(column).distinct().collect()} == values


def test_page_parser():
    from millrace.functions.html import parsed, signals_of

    page = "<html><head><title> T &amp;\n U</title><meta name='description' content='own'><meta property='og:description' content='og'><meta name=description content=''><script src='https://s.com/a.js'>var x</script><style>p{}</style></head><body><b>social</b><b>casino</b><a href='/terms'>t</a><link href=x.css><area href='#top'><area href=../up><iframe src='//f.com'></iframe>%s me@late.example</body>" % ("w " * 5000)
    title, meta, links, scripts, iframes, text, emails = signals_of(page, "https://www.a.com/d/e/f?q")
    assert (title, meta, links, scripts, iframes) == ("T & U", "own", ["https://a.com/terms", "https://a.com/d/e/x.css"], ["https://s.com/a.js"], ["https://f.com/"])
    assert text.startswith("T & Usocialcasinot") and len(text) == 8000 and emails == ["me@late.example"]
    assert parsed(page, "https://www.a.com/d/e/f?q").anchors == ["https://a.com/terms", "https://a.com/d/up"]
    assert signals_of("<![if x", "https://a.com")[0] == "" and signals_of(None, None)[2] == []


URLS = [
    ("foo/bar.html", "https://a.com/x/y?z"), ("../up", "https://a.com/x/y/z"), ("../../../up", "https://a.com/x/"), ("./a/./b/..", "http://a.com"), ("?b&a=1", "https://a.com/p/q?r"), ("  https://A.com  ", None), ("https://a.com:8443/x", None), ("http://a.com:443", None), ("https://a.com:80/", None),
    ("//cdn.com/x", "http://a.com"), ("/abs?x=a%20b&y=~*&z=%2B", "https://www.a.com/q"), ("mailto:x@y.com", "https://a.com"), ("javascript:void(0)", "https://a.com"), ("#frag", "https://a.com"), ("ftp://a.com/x", None), ("https://u:p@a.com/x;p=1?q=1#f", None), ("https://a.com/x;p/y;q", None), ("", "https://a.com"), (None, "https://a.com"), ("tel:1", "https://a.com"), ("https://a.com?x=1&x=0&&y", None), ("x y", "https://a.com/b/c"), ("https://[::1]/x", None), ("https://[2001:db8::1]:8443/x", None), ("https://[::1]:80", None),
]


def test_urls_by_expression_and_by_parser(spark):
    from pyspark.sql import functions as F

    from millrace.functions.html import absolute
    from millrace.functions.urls import normalize_url

    rows = spark.createDataFrame([(i, u, b or "") for i, (u, b) in enumerate(URLS)], "i int, u string, b string")
    got = {r["i"]: r["n"] for r in rows.select("i", normalize_url(F.col("u"), F.col("b")).alias("n")).collect()}
    assert [got[i] for i in range(len(URLS))] == [absolute(u or "", b or "") for u, b in URLS]
    assert got[0] == "https://a.com/x/foo/bar.html" and got[1] == "https://a.com/x/up" and got[4] == "https://a.com/p/q?a=1&b=" and got[5] == "https://a.com/"


@pytest.mark.parametrize("line, want", [
    ("| Brand | Domain |", None), ("| --- | :-: |", None), ("| Acme | acme.com | note", ("table", "Acme", "acme.com", "note")), ("Acme|acme.com", ("cells", "Acme", "acme.com", "")), ("Acme Games - acme.com", ("host", "Acme Games", "acme.com", "")),
    ("brand: Acme domain: acme.com", ("brand_first", "Acme", "acme.com", "")), ("url = acme.com name = Acme Co", ("domain_first", "Acme Co", "acme.com", "")), ("https://acme.com/x Acme", ("url", "Acme", "https://acme.com/x", "")), ("https://acme.com", ("url", "https://acme.com", "https://acme.com", "")),
    ("Acme\tacme.com\tone\ttwo", ("cells", "Acme", "acme.com", "one two")), ("logo.png", None), ("me@acme.com", None), ("a.b@acme.com or x.acme.com", ("host", "a.b@acme.com or", "x.acme.com", "")), ("no domain here", None), ("# acme.com", None), ("=====", None), ("  ", None), ("| acme.com |", ("host", "acme.com", "acme.com", "")),
])
def test_bulk_lines(spark, line, want):
    from millrace.plans.intake import bulk_rows

    got = [(r["kind"], r["brand"], r["raw_domain"], r["notes"]) for r in bulk_rows(spark.createDataFrame([(0, line)], "line int, text string")).collect()]
    assert got == ([want] if want else [])


def test_markdown_tables(spark):
    from millrace.plans.intake import markdown_rows

    text = ["# x", "| one |", "| Brand | Primary  Domain | Brand |", "|---|---|---|", "| a | a.com | last |", "| only |", "| b |  |", "| Other | Header | Row | more |", "plain | text"]
    rows = [("dir/Lists_SET2_set1.md", i, t) for i, t in enumerate(text)] + [("dir/Own.Name.md", 0, "| h | i |"), ("dir/Own.Name.md", 1, "| x | y |")]
    got = sorted((r["file"], r["source_set"], r["row_index"], r["cells"]) for r in markdown_rows(spark.createDataFrame(rows, "file string, pos int, text string")).collect())
    first = ("dir/Lists_SET2_set1.md", "set2")
    assert got == [(*first, 0, {"primary_domain": "a.com", "brand": "last"}), (*first, 1, {"primary_domain": "", "brand": ""}), (*first, 2, {"primary_domain": "Header", "brand": "Row"}), ("dir/Own.Name.md", "own.name", 0, {"h": "x", "i": "y"})]


def test_extracted_record(spark):
    from millrace.plans.monitor import extracted

    html = "<title>Casino</title><a href='/terms'>x</a><a href='/help'>y</a><a href='https://o.com/x'>o</a><link href='/s.css'><script src='//s.net/a.js'></script><p>redeem gold coins via PayPal, now at new.example; me@a.com</p>"
    log = [(1, "http://a.com/privacy", "https://www.a.com/privacy", 200, "text/HTML", html, None, "t"), (2, "http://b.com/", "", 200, "application/pdf", "x", None, "t"), (3, "http://c.com/help", None, 404, "text/html", html, "http_error", "t")]
    got = {r["page_id"]: r.asDict(True) for r in extracted(spark.createDataFrame(log, "page_id long, url string, final_url string, status int, content_type string, body string, error string, fetched_at string")).collect()}
    assert len(got[1]) == 20
    want = {"domain": "a.com", "title": "Casino", "policy_links": ["https://a.com/terms"], "support_links": ["https://a.com/help"], "asset_domains": ["a.com"], "script_domains": ["s.net"], "contact_emails": ["me@a.com"], "text_hits": ["casino", "gold coins", "paypal", "redeem"], "provider_mentions": ["paypal"], "rebrand_phrase_hits": ["now at"], "notes": ["policy_like_path"]}
    assert {k: got[1][k] for k in want} == want
    assert got[2]["notes"] == ["non_html_skipped"] and got[2]["final_url"] == "http://b.com/" and got[3]["notes"] == ["fetch_error: http_error"] and got[3]["title"] == ""


def test_bridging_row_joins_groups(spark):
    from millrace.plans.intake import grouped

    rows = [("a", "one.com", "longbrand"), ("b", "two.com", "longbrand"), ("c", "", "longbrand"), ("d", "x.com", "abc"), ("e", "y.com", "abc"), ("f", "x.com", "other")]
    got = {r["candidate_id"]: r["canonical"] for r in grouped(spark.createDataFrame(rows, "candidate_id string, domain string, fold string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "d"}


@pytest.mark.parametrize("links", [20, 150, 400_000])
def test_components_by_key_against_loops(spark, monkeypatch, links):
    """Groups by two keys, whether they are united in one task or by rounds of stars."""
    import random

    from pyspark.sql import functions as F

    from millrace.operators import relational

    monkeypatch.setattr(relational, "LINKS", links)
    rng = random.Random(links)
    rows = [(f"n{k:04}", rng.choice([None, f"x{rng.randrange(160)}"]), rng.choice([None, f"y{rng.randrange(200)}", "hot" if k % 3 == 0 else None])) for k in range(500)]
    rows += [(f"n{1000 + k}", f"p{k}", f"q{k + 1}") for k in range(60)] + [(f"n{2000 + k}", f"p{k}", f"q{k}") for k in range(60)]  # a long chain
    up = {n: n for n, _, _ in rows}
    changed = True
    while changed:
        changed = False
        for at in (1, 2):
            least = {}
            for r in rows:
                if r[at]:
                    least[r[at]] = min(least.get(r[at], up[r[0]]), up[r[0]])
            for r in rows:
                if r[at] and least[r[at]] < up[r[0]]:
                    up[r[0]], changed = least[r[at]], True
    df = spark.createDataFrame(rows, "node string, a string, b string").repartition(6)
    keys = [F.concat(F.lit("A"), "a"), F.concat(F.lit("B"), "b")]
    got = {r["node"]: r["label"] for r in relational.components_by_key(df, "node", keys).collect()}
    assert got == {n: m for n, m in up.items() if n != m}


def test_files(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from millrace.operators.relational import numbered, pick
    from millrace.sinks import files as W
    from millrace.sources import files

    root = f"file://{tmp_path}"
    W.write_text(spark, f"{root}/l.txt", "# c\n\n  a \r\nb\n")
    assert [r["value"] for r in files.read_lines(spark, f"{root}/l.txt").collect()] == ["a", "b"]
    W.write_text(spark, f"{root}/bad.json", "{}")
    with pytest.raises(PySparkException):
        files.read_json_array(spark, f"{root}/bad.json", "a int", strict=True).collect()
    layout = files.Layout(root)
    W.write_text(spark, f"{layout.path('candidates')}/web_new_verification_queue.csv", "x\n1\n")
    assert layout.find(spark, "verification_queue.csv").endswith("web_new_verification_queue.csv") and layout.find(spark, "other.csv") == f"{root}/other.csv" and layout.path("deny_domains").endswith("data/seeds/deny_domains.txt")
    assert W.patch_json(spark, f"{root}/none.json", a=1) == {} and W.json_text({"b": "é", "a": [1]}) == '{\n  "a": [\n    1\n  ],\n  "b": "\\u00e9"\n}\n'
    with pytest.raises(ValueError):
        W.write_buckets(spark.createDataFrame([("x", 1)], "bucket string, n int"), f"{root}/b", "bucket", ["y"], ["n"])
    df = spark.createDataFrame([(k * 7 % 100,) for k in range(100)], "k int")
    assert all(r["k"] == r["n"] for r in numbered(df.repartition(5), ["k"], "n").collect()) and numbered(df, ["k"], "n").count() == 100 and numbered(df.limit(0), ["k"], "n").count() == 0
    row = spark.createDataFrame([(" x ", None)], "`Primary Domain` string, brand string")
    assert row.select(pick(row, "primary_domain", "primary domain").alias("a"), pick(row, "Brand").alias("b"), pick(row, "no").alias("c")).first().asDict() == {"a": "x", "b": "", "c": ""}
    assert row.select(F.lit(1)).count() == 1


def test_answers():
    from millrace.functions.answers import adapter, object_in

    assert object_in('x ```json\n{"a": {"b": 1}}\n``` y') == '{"a": {"b": 1}}' and object_in('see {"a": {"b": [1]}} and {"c": 2}') == '{"a": {"b": [1]}}'
    assert object_in("```{bad}``` {\"a\": 1}") is None and object_in("no") is None and object_in(None) is None and object_in('{"a": "}"}') is None and object_in("{") is None
    assert adapter(" Deterministic ") == 0
    with pytest.raises(KeyError):
        adapter("other")


def test_provider_states(spark):
    from millrace.plans.providers import results

    j = '{"entity_type_guess": "likely_noise", "confidence_hint": 0, "family_hints": ["f"], "notes": "n", "footer_or_company_phrases": ["p"], "same_backend_or_legal_language_hint": "h"}'
    rows = [("a", 1, False, None, False, None, j), ("b", 1, True, '{"notes": "c", "confidence_hint": 0.9}', False, "e", None), ("c", 1, True, '{"notes": "c"}', True, None, j), ("d", 1, True, None, False, "boom", ""), ("e", 1, True, None, False, None, ""), ("f", 2, True, None, False, None, ""), ("g", 3, True, None, False, None, "{ }"), ("h", 3, True, None, False, None, j)]
    got = {r["candidate_id"]: r for r in results(spark.createDataFrame(rows, "candidate_id string, tier int, has_key boolean, cached string, refresh boolean, error string, text string")).collect()}
    assert {k: (r["status"], r["cached"], r["notes"]) for k, r in got.items()} == {"a": ("unavailable", False, "no key"), "b": ("ok", True, "c"), "c": ("ok", False, "n"), "d": ("error", False, "boom"), "e": ("error", False, "empty_parse"), "f": ("unavailable", False, "empty"), "g": ("error", False, "empty_parse"), "h": ("ok", False, "n | h")}
    assert got["b"]["confidence_hint"] == 0.9 and got["c"]["confidence_hint"] == 0.45 and got["h"]["family_hints"] == ["f", "p"] and '"notes":"n"' in got["h"]["to_cache"] and got["b"]["to_cache"] is None


def test_dns_names_and_signatures(spark):
    from millrace.sinks import signing
    from millrace.sources.network import answers_of, name_at

    assert name_at(b"\x01a\x00\x01b\xc0\x00", 3) == ("b.a", 7)
    for bad in (b"\xc0\x00", b"\x05ab", b"\xc0", b""):
        with pytest.raises(ValueError):
            name_at(bad, 0)
    assert answers_of(None, "MX")[1] and answers_of(b"\x00" * 12, "NS") == ([], None)
    assert signing.digest(signing.canonical({"b": 1, "a": "é"})) == __import__("hashlib").sha256(b'{"a":"\\u00e9","b":1}').hexdigest()
    made = signing.envelope({"a": 1}, lambda data: b"\xff" * 4 + data[:1], "k", "2024-01-01T00:00:00Z")
    assert made["signature"]["signature_b64"] == "_____3s" and made["signature"]["payload_hash_sha256"] == signing.digest(b'{"a":1}')
    with pytest.raises(TypeError):
        signing.canonical({"a": object()})
    from pyspark.sql import functions as F

    got = spark.createDataFrame([('{"b": 1, "a": [2, {"d": null, "c": 1.5}]}',), ("no",), (None,)], "j string").select(signing.canonical_json(F.col("j")).alias("c")).collect()
    assert [r["c"] for r in got] == ['{"a":[2,{"c":1.5,"d":null}],"b":1}', None, None]
