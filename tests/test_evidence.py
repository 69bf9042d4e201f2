"""Entities, relationships and redirects as they are proposed, by the rules' own cases."""

import json
import random
import re

import duckdb
from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions.lexicon import EMAIL
from millrace.functions.text import two_decimals
from millrace.plans import catalog
from millrace.plans import evidence as E
from millrace.plans.fixtures import fixture
from millrace.plans.monitor import classified, extracted, rebranded, redirects

RECORD = "page_id long, url string, final_url string, domain string, title string, meta_description string, text_hits array<string>, policy_links array<string>, support_links array<string>, provider_mentions array<string>, rebrand_phrase_hits array<string>, script_domains array<string>, iframe_domains array<string>, notes array<string>"


def record(page_id, domain, **more):
    base = dict(page_id=page_id, url=f"https://{domain}/", final_url=f"https://{domain}/", domain=domain, title="", meta_description="", text_hits=[], policy_links=[], support_links=[], provider_mentions=[], rebrand_phrase_hits=[], script_domains=None, iframe_domains=None, notes=[])
    return tuple((base | more).values())


def rows(df):
    return [r.asDict(True) for r in df.collect()]


def test_two_decimals_as_printed(spark):
    rng = random.Random(4)
    xs = [0.0, 1.0, 0.125, 0.375, 0.625, 0.875, 0.005, 0.015, 0.145, 0.285, 0.995, 0.994999, 0.25 + 0.06 * 3 + 0.12] + [round(rng.random(), rng.randint(2, 16)) for _ in range(4000)] + [sum([0.06] * k, 0.25) for k in range(12)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", two_decimals(F.col("x")).alias("s")).collect()
    assert {r["i"]: r["s"] for r in got} == {i: f"{x:.2f}" for i, x in enumerate(xs)}


def test_reasons(spark):
    def one(title="", meta="", hits=(), policy=0, support=0, providers=()):
        df = spark.createDataFrame([(title, meta, list(hits), policy, support, list(providers))], "title string, meta string, text_hits array<string>, policy_links int, support_links int, provider_mentions array<string>")
        r = classified(df).first()
        return r["label"], r["reasoning"]

    assert one() == ("unknown", ["insufficient keyword signals"])
    assert one("Social casino - gold coins & sweeps", "Play slots", ["gold coins", "sweepstakes"], 1) == ("likely_operator", ["highest rule score for likely_operator (0.69)", "likely_operator=0.69"])
    label, why = one("Best sweeps, compare top sweepstakes sites", "Reviews", support=10)
    assert label == "likely_promoter" and why[0].startswith("highest rule score for likely_promoter (") and why[-1].startswith("likely_promoter=") and any(w.startswith("likely_operator=0.4") for w in why)
    many = [f"p{k}" for k in range(8)]
    assert one(providers=many) == ("likely_provider", ["highest rule score for likely_provider (0.75)", "provider mentions: p0, p1, p2, p3, p4, p5"])
    assert one("casino, gold coins", providers=many) == ("likely_operator", ["operator signals outweighed provider-only mentions", "likely_operator score=0.45"])


def test_entities(spark):
    found = spark.createDataFrame([("z.com", ["https://seed.example/a"]), ("www.Odd.com.", ["x", "y"]), ("none.com", []), ("", ["https://q.com"])], "domain string, source_urls array<string>")
    records = spark.createDataFrame([
        record(1, "z.com", title="old"), record(2, "z.com", title="Social casino", meta_description="sweeps coins", text_hits=["gold coins"], policy_links=["https://z.com/terms"], provider_mentions=["stripe"]),
        record(3, "", title="no domain"), record(4, "none.com", title=None, meta_description=None, text_hits=None, policy_links=None, support_links=None, provider_mentions=None, rebrand_phrase_hits=None, notes=None),
    ], RECORD)
    got = {r["normalized_domain"]: r for r in rows(E.entities(found, records, E.hints(records)))}
    assert set(got) == {"z.com", "odd.com", "none.com"}
    z = got["z.com"]
    assert z["candidate_id"] == "candidate_z_com" and z["source_urls"] == ["https://seed.example/a"] and z["likely_type"] == "likely_operator" and z["reasoning"] and z["discovered_from"] == "discovery"
    snapshot = json.loads(z["raw_evidence_snapshot"])
    assert list(snapshot) == [k for k in E.EVIDENCE if k not in ("script_domains", "iframe_domains")] and snapshot["title"] == "Social casino" and snapshot["support_links"] == []
    assert got["odd.com"]["raw_evidence_snapshot"] == E.NO_EVIDENCE and got["odd.com"]["reasoning"] == [E.NO_HINT] and (got["odd.com"]["likely_type"], got["odd.com"]["confidence_hint"]) == ("unknown", 0.0)
    assert got["none.com"]["raw_evidence_snapshot"] == "{}" and got["none.com"]["reasoning"] == ["insufficient keyword signals"] and got["none.com"]["confidence_hint"] == 0.1


def test_relationships(spark):
    found = spark.createDataFrame([("b.com", ["https://www.A.com:8080/x", "https://a.com/y", "no host", "https://"]), ("", ["https://a.com"]), ("c.com", None)], "domain string, source_urls array<string>")
    got = sorted((r["relationship_id"], r["from_domain"], r["to_domain"], r["relationship_kind"], r["source_url"], r["first_seen"]) for r in rows(E.relationships(found, "t")) if r["source_url"] != "no host")
    assert got == [("rel_a.com__to__b.com", "a.com", "b.com", "discovered_link", u, "t") for u in ("https://a.com/y", "https://www.A.com:8080/x")]


def test_redirects_by_answer_and_by_phrase(spark):
    http = spark.createDataFrame([("https://a.test/x", "https://b.test/y", "a.test", "b.test", "http_redirect", "https://seed/x", "old", 1), ("https://a.test/x", "https://b.test/y", "a.test", "b.test", "http_redirect", "https://seed/x", "new", 2)], "from_url string, to_url string, domain_from string, domain_to string, discovery_type string, source_url string, first_seen string, seq long")
    records = spark.createDataFrame([record(1, "c.test", rebrand_phrase_hits=["formerly"]), record(2, "d.test"), record(3, "", url="https://e.test/p", final_url="", rebrand_phrase_hits=["moved to", "now at"]), record(4, "c.test", rebrand_phrase_hits=["rebrand"]), record(5, "f.test", url=None, final_url=None, rebrand_phrase_hits=["now at"]), record(6, "g.test", rebrand_phrase_hits=None)], RECORD)
    got = {(r["from_url"], r["discovery_type"]): r for r in rows(E.merged_redirects(http, E.phrase_redirects(records, "now")))}
    assert set(got) == {("https://a.test/x", "http_redirect"), ("https://c.test/", "page_phrase_rebrand"), ("https://e.test/p", "page_phrase_rebrand")}
    assert got["https://a.test/x", "http_redirect"]["first_seen"] == "new" and got["https://a.test/x", "http_redirect"]["phrases_matched"] is None
    assert got["https://c.test/", "page_phrase_rebrand"]["phrases_matched"] == ["rebrand"]  # the later page
    assert got["https://e.test/p", "page_phrase_rebrand"]["domain_to"] == "e.test" and got["https://e.test/p", "page_phrase_rebrand"]["notes"] == E.PHRASE_NOTE


def test_nothing_to_propose(spark):
    none = spark.createDataFrame([], RECORD)
    found = spark.createDataFrame([], "domain string, source_urls array<string>")
    assert E.entities(found, none, E.hints(none)).count() == 0 and E.relationships(found, "t").count() == 0 and E.phrase_redirects(none, "t").count() == 0


def test_redirects_join_no_page_with_every_other(spark, data):
    """The comparison of both URLs stays out of the join that makes the log."""
    got = redirects(fixture(spark, data, "fetch_log"))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString() and not got.isEmpty()


def test_slashes_at_the_end_are_no_redirect(spark):
    log = spark.createDataFrame([(1, "http://a.com", "http://a.com//"), (2, "http://a.com", "http://a.com/\n"), (3, "http://a.com/", "http://b.com/"), (4, "http://a.com/", None), (5, "http://a.com/", "")], "page_id long, url string, final_url string")
    assert {r["page_id"] for r in redirects(log).collect()} == {2, 3, 5}


def test_redirects_found_often_are_counted(spark, data, tmp_path):
    """Against the SQL, on pages that repeat their URLs; one page's number is above those of the second run."""
    con, name = duckdb.connect(), "redirect_upsert"
    con.sql(f"CREATE TABLE pages AS SELECT page_id + 50 * i AS page_id, url, html FROM '{data}/pages.parquet', range(6) t(i) UNION ALL SELECT 3000119, url, html FROM '{data}/pages.parquet' WHERE page_id = 38")
    con.sql(f"COPY pages TO '{tmp_path}/pages.parquet'")
    got, rel = catalog.QUERIES[name](spark, str(tmp_path)), con.sql(catalog.ORACLE[name])
    want = sorted(rel.select("from_url, to_url, seq, n").fetchall())
    assert sorted(tuple(r) for r in got.select("from_url", "to_url", "seq", "n").collect()) == want
    assert {n for *_, n in want} >= {1, 2, 3} and 3000119 in {seq for *_, seq, _ in want}


PLAIN = '<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><meta name="description" content="d &lt; e"><style>p{margin:0}</style><script src="/a.js">if (a<b) "</p>"</script></head><body><!-- no - text --><p class="x">For<b>merly</b> <b>&nbsp;</b>x</p><br/><a href="/q?b=2&amp;a=1">l</a><a href="https://www.b.com/p">m</a><iframe src="//f.example:8443/f"></iframe> a@b.com</body></html>'
ODD = ["", "a < b", "<p", "<SCRIPT>x</SCRIPT>y", "<script>x", "<script>a</ script >b", "<title>a<b>c</b></title>d", "<!-->x", "<!-- a -- b -->c", "<a href=/x>l</a>", "<a href='/x'>l</a>", "<noscript>n</noscript>", "&amp", "x &lt", "<textarea><b>t</b></textarea>", "<?pi?>z", '<a href="/./a">l</a>', '<a href="https://www.www.a.b">l</a>', "</script>a</title>b", '<iframe src="/f"><b>x</b></iframe>']


def by_parser(html, base):
    """As signals_of(), all by the parser."""
    page = H._Page(base)
    page.url = lambda ref: H.absolute(ref, base)
    page.feed(html)
    page.close()
    text = " ".join("".join(page.text).split())
    return " ".join("".join(page.title).split()), page.description, page.links, page.scripts, page.iframes, text[: H.TEXT_CHARS], sorted(set(re.findall(EMAIL, text)))


def test_pages_of_plain_tokens_need_no_parser(monkeypatch):
    for base in ("https://www.a.com/x", "http://a.com:8080", "http://a.com:x/", "x", ""):
        for html in (PLAIN, *ODD, *(PLAIN + x for x in ODD)):
            assert H.signals_of(html, base) == by_parser(html, base) and H.text_of(html) == by_parser(html, base)[5], (html, base)
    want = by_parser(PLAIN, "https://www.a.com/x")
    monkeypatch.setattr(H._Page, "feed", None)
    assert H.signals_of(PLAIN, "https://www.a.com/x") == want and H.text_of(PLAIN) == want[5] and want[5].startswith("T & tFormerly")


def test_phrases_are_those_of_whole_records(spark, data):
    """Of pages with phrases, and without a join of all texts."""
    columns = ["page_id", "url", "final_url", "domain", "rebrand_phrase_hits"]
    log = fixture(spark, data, "evidence_log")
    want = {tuple(map(str, r)) for r in extracted(log).filter("size(rebrand_phrase_hits) > 0").select(columns).collect()}
    assert want and {tuple(map(str, r)) for r in rebranded(log).collect()} == want


def test_terms_and_footers_of_texts(spark):
    """Terms in any case, once each and sorted, from the first 8,000 characters; the footer from the last 4,000 of these."""
    body = "<p>Formerly SLOTS, slots and KKnami Kİx</p>" + "a " * 4000 + "redirect"
    log = spark.createDataFrame([(1, "https://a.com/", "", 200, "text/html", body, None, None), (2, "https://a.com/", "", 404, "text/html", body, None, None)], "page_id long, url string, final_url string, status int, content_type string, body string, error string, fetched_at string")
    one, two = extracted(log).orderBy("page_id").collect()
    assert one["text_hits"] == ["slot", "slots"] and one["rebrand_phrase_hits"] == ["formerly"] and one["provider_mentions"] == [] and one["footer_legal_snippet"] == ("a " * 600)
    assert two["text_hits"] == [] and two["rebrand_phrase_hits"] == [] and two["footer_legal_snippet"] == ""
    assert [tuple(r) for r in rebranded(log).collect()] == [(1, "https://a.com/", "https://a.com/", "a.com", ["formerly"])]


def test_whole_texts_are_searched(spark, data, tmp_path):
    """Against the SQL, on pages of over 8,000 characters and over 2 MB, by parser and by expression: the phrases stand at their ends."""
    con, name = duckdb.connect(), "signals_html_parser"
    long = "concat(html, CASE WHEN page_id % 2 = 0 THEN '<p class=x>' ELSE '<p>' END, repeat('aé ', CASE WHEN page_id = 1 THEN 1000000 ELSE 4000 END), 'Cashier stripe</p><p>', repeat('b ', 3000), 'c</p>')"
    con.sql(f"CREATE TABLE pages AS SELECT page_id, url, {long} AS html FROM '{data}/pages.parquet'")
    con.sql(f"COPY pages TO '{tmp_path}/pages.parquet'")
    columns = ["page_id", "title", "footer_legal_snippet", "contact_emails", "text_hits", "provider_mentions", "rebrand_phrase_hits"]
    read = lambda rows: sorted((r[0], *map(str, r[1:])) for r in rows)
    got = catalog.QUERIES[name](spark, str(tmp_path)).select(columns).collect()
    assert read(got) == read(con.sql(catalog.ORACLE[name]).select(", ".join(columns)).fetchall())
    made = {r["page_id"]: r for r in got}
    for k in (1, 25, 41):
        assert "cashier" in made[k]["text_hits"] and "stripe" in made[k]["provider_mentions"] and {"formerly", "we have moved"} <= set(made[k]["rebrand_phrase_hits"]) and set(made[k]["footer_legal_snippet"]) == {"b", " "}, k


def test_normal_forms_are_written_before_they_are_used(spark, data):
    """Spark would write the expression out anew wherever a normal form is used."""
    plan = E.discovered(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "encode" not in plan and "domain" in plan
