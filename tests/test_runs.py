"""Fingerprints with broken parts, runs that break off, seeds and sets."""

import pytest

from millrace.plans import fingerprints as P
from millrace.plans import runs as G

LOGS = ("host string, a array<string>, a_error string, aaaa array<string>, aaaa_error string", "host string, answers array<string>, error string", "host string, answers array<struct<priority:int,host:string>>, error string", "host string, subject string, issuer string, dates string, names string, error string")
EMPTY = {"subject_cn": None, "issuer_cn": None, "san": [], "not_before": None, "not_after": None}


def logs(spark, *rows):
    return tuple(spark.createDataFrame(r, schema) for r, schema in zip(rows, LOGS))


def test_fingerprints(spark):
    network = logs(
        spark,
        [("good.com", ["2.2.2.2", "1.1.1.1"], None, ["::1"], None), ("half.com", [], "no A", ["::1"], "ignored"), ("", ["9.9.9.9"], None, [], None)],
        [("good.com", ["NS2.good.com.", "ns1.good.com", "ns1.GOOD.com"], None), ("half.com", ["left.over"], "timeout")],
        [("good.com", [(20, "b.good.com"), (5, "A.good.com.")], None), ("half.com", [], None)],
        [("good.com", "subject=CN = good.com", "issuer=O=x, CN = CA", "notBefore=May  3 12:00:00 2025 GMT", "DNS:good.com, DNS:www.good.com", None), ("half.com", "subject=CN = left.over", None, None, "DNS:left.over", "handshake")],
    )
    domains = spark.createDataFrame([("good.com",), ("half.com",), ("none.com",), ("",), ("good.com",)], "domain string")
    got = {r["domain"]: r.asDict(True) for r in P.fingerprints(domains, *network, "t").collect()}
    assert set(got) == {"good.com", "half.com", "none.com", ""}
    good = got["good.com"]
    assert not good["partial"] and set(good["errors"]) == set(P.PARTS) and not any(good["errors"].values()) and good["fingerprinted_at"] == "t"
    assert good["dns"] == {"a": ["1.1.1.1", "2.2.2.2"], "aaaa": ["::1"], "ns": ["ns1.good.com", "ns2.good.com"], "mx": [{"priority": 5, "host": "a.good.com"}, {"priority": 20, "host": "b.good.com"}]}
    assert good["tls"] == {"subject_cn": "good.com", "issuer_cn": "CA", "san": ["good.com", "www.good.com"], "not_before": "2025-05-03T12:00:00Z", "not_after": None}
    half = got["half.com"]
    assert half["partial"] and half["errors"] == {"dns_a": "no A", "dns_aaaa": None, "dns_ns": "timeout", "dns_mx": None, "tls": "handshake"} and half["tls"] == EMPTY and half["dns"]["ns"] == [] == half["dns"]["mx"]
    assert got["none.com"]["partial"] and set(got["none.com"]["errors"].values()) == {P.NO_ANSWER} and got["none.com"]["tls"] == EMPTY
    assert got[""]["partial"] and set(got[""]["errors"].values()) == {P.NO_DOMAIN}
    one = P.payload(P.fingerprints(domains, *network, "t"), "t").first().asDict(True)
    assert one["artifact_type"] == "domain_fingerprints" and one["fingerprints"] == got


def test_first_domains(spark):
    rows = spark.createDataFrame([("b.com", 3), ("WWW.a.com.", 2), ("a.com", 9), (None, 0), ("", 1), ("c.com", 1), ("d.com", 20)], "domain string, seq long")
    assert {r["domain"] for r in P.first_domains(rows, 3).collect()} == {"a.com", "b.com", "c.com"}
    assert P.payload(P.fingerprints(P.first_domains(rows.limit(0)), *logs(spark, [], [], [], []), "t"), "t").first()["fingerprints"] == {}


def test_a_run_that_breaks_off(spark, tmp_path):
    root, made = f"file://{tmp_path}", []

    def make(name, n):
        def run():
            made.append(name)
            return spark.range(n)

        return run

    def broken():
        made.append("broken")
        raise RuntimeError("lost")

    first = G.Run(spark, root, "r")
    assert first.stage("one", make("one", 3)).count() == 3
    with pytest.raises(RuntimeError):
        first.stage("two", broken)
    again = G.Run(spark, root, "r")
    assert again.stage("one", make("one", 99)).count() == 3 and again.stage("two", make("two", 4)).count() == 4 and again.stage("none", make("none", 0)).count() == 0
    assert made == ["one", "broken", "two", "none"] and again.report == [(0, "one", 3, True), (1, "two", 4, False), (2, "none", 0, False)]
    assert G.Run(spark, root, "other").stage("one", make("other", 5)).count() == 5
    third = G.Run(spark, root, "r")
    third.stage("none", broken)  # is whole, with no row
    assert third.report == [(0, "none", 0, True)] and third.summary().count() == 1


def test_stages_hold_what_their_functions_make(spark, data, tmp_path):
    from millrace.plans import evidence as E

    given = G.monitor_inputs(spark, data)
    out = G.monitor(G.Run(spark, f"file://{tmp_path}", "r"), **given)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    assert same(out["entities"], E.entities(given["discovered"](), out["extract"], E.hints(out["extract"])))
    assert out["fingerprint"].filter("partial").count() > 0 and {r["discovery_type"] for r in out["redirects"].collect()} == {"http_redirect", "page_phrase_rebrand"}
    assert {r["bridge_status"] for r in out["bridge"].collect()} >= {"already_known", "net_new"}


def test_seeds(spark, tmp_path):
    def write(name, text):
        with open(f"{tmp_path}/{name}", "w") as out:
            out.write(text)
        return f"file://{tmp_path}/{name}"

    a = write("seeds.txt", "# seeds\nhttps://B.com/x?b=1&a=2\n\n  https://a.com \nmailto:x@y\nhttps://b.com/x?a=2&b=1\n")
    b = write("boot.txt", ".C.com.\nhttps://passed.over/\na.com\n#no\nd.com\n")
    got = [(r["seq"], r["value"], r["source"]) for r in G.seeds(spark, a, b).orderBy("seq").collect()]
    assert got == [(0, "https://b.com/x?a=2&b=1", "seed"), (1, "https://a.com/", "seed"), (2, "https://c.com/", "bootstrap"), (3, "https://d.com/", "bootstrap")]
    assert [r["value"] for r in G.seeds(spark, f"{a}.none", b).orderBy("seq").collect()] == ["https://c.com/", "https://a.com/", "https://d.com/"]


def test_requested_providers(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, ["deterministic"]), (4, [" Claude", "claude", "x", "deterministic"])], "k int, providers array<string>")
    got = {r["k"]: (r["want"], r["others"], r["left_out"], r["run_external"]) for r in G.requested(rows).collect()}
    assert got[1] == got[2] == got[3] == ([], [], ["claude", "gemini", "perplexity"], False) and got[4] == (["claude"], ["x"], ["gemini", "perplexity"], True)
