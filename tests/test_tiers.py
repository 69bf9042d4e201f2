"""The chain of tiers: every branch of its rules, and cuts against plain loops."""

import random

import pytest

from millrace.plans import tiers

JOB = "line long, job_id string, brand string, status_hint string, discovery_source string, entity_type_guess string, redirect_hints array<string>, family_hints array<string>, risk_score double"
ANSWER = "job_id string, tier int, status string, provider_status string, entity_type_guess string, confidence_hint double, extracted_domains array<string>, family_hints array<string>"
PLAIN = {"line": 1, "job_id": "a", "brand": "B", "status_hint": "listed", "discovery_source": "x", "entity_type_guess": "likely_real_operator", "redirect_hints": [], "family_hints": [], "risk_score": 0.0}


def job(**more):
    return PLAIN | more


def one(spark, column, row, schema=JOB):
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("more, want", [
    ({}, 0.0), ({"status_hint": "Coming_Soon"}, 3.0), ({"status_hint": "NEWLY_LISTED"}, 3.0), ({"status_hint": "an EXISTING_FAMILY row"}, 2.5), ({"discovery_source": "Family page"}, 2.5), ({"discovery_source": "a|b"}, 0.0),
    ({"discovery_source": "a|b|c"}, 1.0), ({"entity_type_guess": "unresolved"}, 2.0), ({"entity_type_guess": "likely_redirect_or_rebrand"}, 2.5), ({"entity_type_guess": "likely_noise"}, 0.5), ({"redirect_hints": ["u"]}, 1.5),
    ({"risk_score": 35.0}, 1.0), ({"risk_score": 34.9}, 0.0), ({"status_hint": None, "discovery_source": None, "entity_type_guess": None, "redirect_hints": None, "risk_score": None}, 0.0),
    ({"status_hint": "coming_soon", "discovery_source": "family|b|c", "entity_type_guess": "unresolved", "redirect_hints": ["u"], "risk_score": 99.0}, 11.0),
])
def test_priority(spark, more, want):
    assert one(spark, tiers.priority(), job(**more)) == want


@pytest.mark.parametrize("more, want", [
    ({}, False), ({"status_hint": "New_Social"}, True), ({"status_hint": "coming_soon"}, True), ({"status_hint": "My Family"}, True), ({"discovery_source": "from SWEEPSKINGS"}, True), ({"discovery_source": "family"}, False),
    ({"entity_type_guess": "unresolved"}, True), ({"entity_type_guess": "likely_redirect_or_rebrand"}, True), ({"entity_type_guess": "likely_noise"}, True), ({"entity_type_guess": None}, False), ({"redirect_hints": ["u"]}, True), ({"redirect_hints": None}, False),
])
def test_first_tier(spark, more, want):
    assert one(spark, tiers.first_tier(), job(**more)) is want


def heard(spark, column, first=None, second=None, **more):
    rows = spark.createDataFrame([tuple(job(**more).values())], JOB)
    said = [("a", t, *x) for t, x in ((1, first), (2, second)) if x]
    answers = spark.createDataFrame(said, ANSWER)
    return tiers.answered(tiers.answered(rows, answers, 1), answers, 2).select(column.alias("x")).first()["x"]


OK = ("ok", "ok", "likely_real_operator", 0.9, [], [])
def _with(**more):
    return tuple(more.get(k, v) for k, v in zip(("status", "provider_status", "label", "sure", "sites", "family"), OK))


@pytest.mark.parametrize("first, want", [
    (None, False), (OK, False), (_with(label="unresolved"), True), (_with(label="likely_promoter"), True), (_with(sure=0.54), True), (_with(sure=0.55), False), (_with(sure=None), True),
    (_with(status="error", sure=0.1), True), (_with(status="stub", sure=0.1), False), (_with(status="unavailable", sure=0.1), False), (_with(provider_status="unavailable", sure=0.1), False), (_with(provider_status=None, sure=0.1), True),
])
def test_second_tier(spark, first, want):
    assert heard(spark, tiers.second_tier(), first) is want


@pytest.mark.parametrize("first, second, more, want", [
    (None, None, {}, False), (OK, OK, {}, False), (OK, None, {}, False), (None, None, {"status_hint": "Existing_FAMILY"}, True), (None, None, {"family_hints": ["f"]}, True), (_with(family=["f"]), None, {}, True),
    (OK, _with(family=["f"]), {}, False), (OK, _with(label="likely_noise"), {}, True), (_with(status="error"), _with(label="likely_noise"), {}, False), (OK, _with(label="likely_noise", status="stub"), {}, False),
    (_with(sites=["a", "b"]), _with(sites=["b", "a", "a"]), {}, False), (_with(sites=["a", "b"]), _with(sites=["b"]), {}, True), (_with(sites=["a"]), OK, {}, False), (_with(sites=["a"], status="error"), _with(sites=["b"]), {}, True), (_with(sites=["a"]), None, {}, False),
])
def test_third_tier(spark, first, second, more, want):
    assert heard(spark, tiers.third_tier(), first, second, **more) is want


def test_caps():
    assert tiers.caps("low")[0] == 8 and tiers.caps(" High ")[2] == 25 and tiers.caps("odd") == tiers.caps(None) == tiers.caps("")


def brute(jobs, answers, limits):
    """The chain by lists and dictionaries."""
    jobs = sorted(jobs, key=lambda j: (j["brand"], j["job_id"], j["line"]))
    last, said = {j["job_id"]: j for j in jobs}, {(a[0], a[1]): dict(zip(("status", "provider_status", "label", "sure", "sites", "family"), a[2:])) for a in answers}
    low = lambda j, c: (j[c] or "").lower()

    def score(j):
        h, d, e = low(j, "status_hint"), low(j, "discovery_source"), j["entity_type_guess"]
        return 3 * (h in ("coming_soon", "newly_listed")) + 2.5 * ("existing_family" in h or "family" in d) + (d.count("|") >= 2) + {"unresolved": 2, "likely_redirect_or_rebrand": 2.5, "likely_noise": 0.5}.get(e, 0) + 1.5 * bool(j["redirect_hints"]) + ((j["risk_score"] or 0) >= 35)

    def tier1(j):
        h = low(j, "status_hint")
        return j["entity_type_guess"] in ("unresolved", "likely_redirect_or_rebrand", "likely_noise") or h in ("coming_soon", "newly_listed", "new_social") or "family" in h or "sweepskings" in low(j, "discovery_source") or bool(j["redirect_hints"])

    one = sorted((j for j in jobs if tier1(j)), key=lambda j: -score(j))[: limits[0]]
    first = {j["job_id"]: said.get((j["job_id"], 1)) for j in one}
    two = []
    for i, p in first.items():
        if p and p["provider_status"] != "unavailable" and p["status"] in ("ok", "error") and (p["label"] == "unresolved" or p["label"] != last[i]["entity_type_guess"] or (p["sure"] or 0) < 0.55):
            two.append(last[i])
    two = sorted(two, key=lambda j: -score(j))[: limits[1]]
    second = {j["job_id"]: said.get((j["job_id"], 2)) for j in two}

    def tier3(j):
        p, c = first.get(j["job_id"]), second.get(j["job_id"])
        differ = p and c and p["label"] != c["label"] and p["status"] == c["status"] == "ok"
        sites = p and c and p["sites"] and c["sites"] and set(p["sites"]) != set(c["sites"])
        return "family" in low(j, "status_hint") or differ or bool(j["family_hints"] or (p and p["family"])) or sites

    three = sorted((j for j in jobs if tier3(j)), key=lambda j: -score(j))[: limits[2]]
    return [(t, k, j["line"]) for t, rows in ((1, one), (2, two), (3, three)) for k, j in enumerate(rows, 1)]


@pytest.mark.parametrize("limits", [(8, 5, 3), (25, 15, 8), (60, 50, 40), (200, 200, 200), (1, 1, 1)])
def test_chain_against_loops(spark, limits):
    rng = random.Random(limits[0])
    labels = ["likely_real_operator", "unresolved", "likely_redirect_or_rebrand", "likely_noise", "likely_promoter"]
    jobs, answers = [], []
    for k in range(90):
        i = rng.randrange(70)  # some ids on several lines, with other hints each
        jobs.append(job(line=k, job_id=f"id{i:02}", brand=f"Brand {i % 9}", status_hint=rng.choice(["Coming_Soon", "listed", "My_Family", None, "NEW_SOCIAL"]), discovery_source=rng.choice(["x", "a|b|c", "SweepsKings", "Family", None])))
    for i in {j["job_id"] for j in jobs}:
        det = {"entity_type_guess": rng.choice(labels), "redirect_hints": rng.choice([[], [], ["r"]]), "family_hints": rng.choice([[], [], [], ["f"]]), "risk_score": rng.choice([0.0, 50.0, None])}
        for j in jobs:
            if j["job_id"] == i:
                j |= det
        for t in (1, 2):
            if rng.random() < 0.9:
                answers.append((i, t, rng.choice(["ok", "ok", "ok", "error", "unavailable", "stub"]), rng.choice(["ok", "ok", None, "unavailable"]), rng.choice(labels), rng.choice([None, 0.3, 0.9]), rng.choice([[], ["a"], ["a", "b"], ["b", "a"]]), rng.choice([[], [], ["f"]])))
    got = tiers.tier_chain(spark.createDataFrame([tuple(j.values()) for j in jobs], JOB), spark.createDataFrame(answers, ANSWER), limits)
    assert sorted((r["tier"], r["place"], r["line"]) for r in got.collect()) == sorted(brute(jobs, answers, limits))


def test_empty(spark):
    assert tiers.tier_chain(spark.createDataFrame([], JOB), spark.createDataFrame([], ANSWER), (8, 5, 3)).count() == 0


def test_the_chain_is_a_chain(spark, data):
    """Later tiers hold rows that a cut of the first tier alone would not give."""
    rows = tiers.QUERIES["tier_chain_low"](spark, data).collect()
    of = lambda t: {r["job_id"] for r in rows if r["tier"] == t}
    assert [sum(r["tier"] == t for r in rows) for t in (1, 2, 3)] == list(tiers.caps("low"))
    assert of(2) <= of(1) and of(2) != {r["job_id"] for r in rows if r["tier"] == 1 and r["place"] <= 5}
    for q in ("tier2_eligible", "tier3_eligible"):
        n = tiers.QUERIES[q](spark, data).count()
        assert 0 < n < tiers.mesh_jobs(spark, data).count()
