"""Tiers of expensive opinions under a budget: each tier's cut is made among what the one before left, so later cuts depend on earlier answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..operators import relational as R
from .fixtures import duck, fixture
from .intake import NORMAL, normalized
from .research import DET, det_rows

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = duck(sql)
        return f

    return add


def caps(budget: str | None) -> tuple[int, int, int]:
    """Most rows of the three tiers; an unknown budget is low."""
    return L.CAPS.get((budget or "low").lower().strip(), L.CAPS["low"])


# --- rules ---------------------------------------------------------------------------------------

DOUBTFUL = ["unresolved", "likely_redirect_or_rebrand", "likely_noise"]
FRESH = ["coming_soon", "newly_listed"]
POINTS = {"unresolved": 2.0, "likely_redirect_or_rebrand": 2.5, "likely_noise": 0.5}
_hint = lambda: F.lower(F.coalesce("status_hint", F.lit("")))
_source = lambda: F.lower(F.coalesce("discovery_source", F.lit("")))
_some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))


def priority() -> Column:
    """How much a job deserves an expensive opinion, by its row (status_hint, discovery_source) and its deterministic result."""
    points = lambda c, p: F.when(c, F.lit(p)).otherwise(F.lit(0.0))
    out = points(_hint().isin(FRESH), 3.0) + points(_hint().contains("existing_family") | _source().contains("family"), 2.5)
    out = out + points(F.length(_source()) - F.length(F.replace(_source(), F.lit("|"))) >= 2, 1.0)
    for label, p in POINTS.items():
        out = out + points(F.col("entity_type_guess") == label, p)
    return out + points(_some("redirect_hints"), 1.5) + points(F.coalesce("risk_score", F.lit(0.0)) >= 35, 1.0)


def first_tier() -> Column:
    """Whether a job may get a broad opinion."""
    named = _hint().isin([*FRESH, "new_social"]) | _hint().contains("family") | _source().contains(L.NAMED_SOURCE)
    return F.coalesce(F.col("entity_type_guess").isin(DOUBTFUL), F.lit(False)) | named | _some("redirect_hints")


def second_tier() -> Column:
    """Whether the first opinion (t1_...) asks for a second: it exists, and is unresolved, differs from the deterministic one or is unsure (no confidence is none)."""
    heard = F.col("t1_status").isin("ok", "error") & (F.coalesce("t1_provider_status", F.lit("")) != "unavailable")
    label = F.col("t1_entity_type_guess")
    return F.coalesce(heard, F.lit(False)) & ((label == "unresolved") | ~label.eqNullSafe(F.col("entity_type_guess")) | (F.coalesce("t1_confidence_hint", F.lit(0.0)) < 0.55))


def third_tier() -> Column:
    """Whether two opinions, or what is known of a family, ask for a third."""
    differ = (F.col("t1_status") == "ok") & (F.col("t2_status") == "ok") & ~F.col("t1_entity_type_guess").eqNullSafe(F.col("t2_entity_type_guess"))
    names = lambda c: F.array_sort(F.array_distinct(F.col(c)))
    sites = _some("t1_extracted_domains") & _some("t2_extracted_domains") & (names("t1_extracted_domains") != names("t2_extracted_domains"))
    return _hint().contains("family") | F.coalesce(differ, F.lit(False)) | _some("family_hints") | _some("t1_family_hints") | F.coalesce(sites, F.lit(False))


# --- the chain -----------------------------------------------------------------------------------

ANSWER = ["status", "provider_status", "entity_type_guess", "confidence_hint", "extracted_domains", "family_hints"]


def last_results(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Jobs with the deterministic result of their id: of several rows of an id the last row's. jobs and results share `line`; jobs without a result go."""
    own = R.last_wins(jobs.select("job_id", "line").join(results, "line"), ["job_id"], ["line"]).drop("line")
    return jobs.join(own, "job_id")


def cut(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first `most` rows, written, with their place from 1. The cap bounds what the numbering sees."""
    top = R.top_k(rows, most, order)
    return R.settled(top.withColumn("place", F.row_number().over(Window.orderBy(*order))), "cut")


def answered(asked: DataFrame, answers: DataFrame, tier: int) -> DataFrame:
    """Rows that were asked, with what the tier's provider said; without a record it said nothing."""
    own = answers.filter(F.col("tier") == tier).select("job_id", *(F.col(c).alias(f"t{tier}_{c}") for c in ANSWER))
    return asked.join(own, "job_id", "left")


def tier_chain(jobs: DataFrame, answers: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """tier, place, job_id, line, brand, priority of every row that a provider is asked about.

    jobs: line, job_id, brand, status_hint, discovery_source and the deterministic entity_type_guess, redirect_hints, family_hints, risk_score; rows that share
    an id each take a place in tiers 1 and 3, and are one in tier 2 (the last row, at its first place). answers: job_id, tier (1, 2) and ANSWER. Order: priority,
    then brand, id and line; in tier 2 the place in tier 1."""
    jobs = jobs.withColumn("priority", priority())
    order = [F.desc("priority"), F.col("brand"), F.col("job_id"), F.col("line")]
    one = cut(jobs.filter(first_tier()), order, limits[0])
    asked = one.groupBy("job_id").agg(F.min("place").alias("first"))
    heard = R.settled(answered(R.last_wins(jobs.join(asked, "job_id"), ["job_id"], ["line"]), answers, 1), "heard")
    two = cut(heard.filter(second_tier()), [F.desc("priority"), F.col("first")], limits[1])
    again = R.settled(answered(two.select("job_id"), answers, 2), "heard")
    both = jobs.join(heard.select("job_id", *(f"t1_{c}" for c in ANSWER)), "job_id", "left").join(again, "job_id", "left")
    three = cut(both.filter(third_tier()), order, limits[2])
    of = lambda t, rows: rows.select(F.lit(t).alias("tier"), "place", "job_id", "line", "brand", "priority")
    return of(1, one).unionByName(of(2, two)).unionByName(of(3, three))


# --- queries -------------------------------------------------------------------------------------

#: Hints in several spellings, by moduli of the candidate's key.
ROW_HINTS = """split_part('Coming_Soon|newly_listed|Existing_Family|NEW_SOCIAL|listed|', '|', CAST(k % 6 AS INT) + 1) AS status_hint, split_part('SweepsKings list#x|y|z#Family page#a#a|b#x|Y|z|w', '#', CAST(k % 7 AS INT) + 1) AS discovery_source"""
MESH = f"SELECT *, substr(sha256(brand || '|' || discovery_source), 1, 16) AS job_id FROM (SELECT candidate_id, k AS line, brand, {ROW_HINTS} FROM ({NORMAL}) WHERE brand <> '')"
_points = " + ".join(f"(CASE WHEN {c} THEN {p} ELSE 0 END)" for c, p in [
    (f"lower(status_hint) IN ('{FRESH[0]}', '{FRESH[1]}')", 3), ("contains(lower(status_hint), 'existing_family') OR contains(lower(discovery_source), 'family')", 2.5), ("discovery_source LIKE '%|%|%'", 1),
    *((f"entity = '{x}'", p) for x, p in POINTS.items()), ("len(finals) > 0", 1.5), ("risk >= 35", 1),
])
JOBS = f"""SELECT m.*, d.entity, d.finals, d.risk, CAST({_points} AS DOUBLE) AS priority,
    entity IN {tuple(DOUBTFUL)} OR lower(status_hint) IN ('{FRESH[0]}', '{FRESH[1]}', 'new_social') OR contains(lower(status_hint), 'family') OR contains(lower(discovery_source), '{L.NAMED_SOURCE}') OR len(finals) > 0 AS tier1
    FROM ({MESH}) m JOIN (SELECT job_id, arg_max(candidate_id, line) AS own FROM ({MESH}) GROUP BY 1) l ON l.job_id = m.job_id JOIN ({DET}) d ON d.candidate_id = l.own"""
ANSWERS = f"""SELECT m.job_id, a.* FROM (SELECT job_id, max(line) AS line FROM ({MESH}) GROUP BY 1) m JOIN ({{mesh_answers}}) a ON a.k = m.line"""
_set = lambda c: f"list_sort(list_distinct(list_filter(string_split({c}, '|'), lambda x: x <> '')))"
RULE2 = "coalesce(a.status IN ('ok', 'error') AND coalesce(a.provider_status, '') <> 'unavailable', FALSE) AND (a.entity_type_guess = 'unresolved' OR a.entity_type_guess <> j.entity OR coalesce(a.confidence_hint, 0) < 0.55::DOUBLE)"
RULE3 = f"contains(lower(j.status_hint), 'family') OR coalesce(a.status = 'ok' AND b.status = 'ok' AND a.entity_type_guess <> b.entity_type_guess, FALSE) OR coalesce(a.family_hints, '') <> '' OR coalesce(len({_set('a.domains')}) > 0 AND len({_set('b.domains')}) > 0 AND {_set('a.domains')} <> {_set('b.domains')}, FALSE)"


def chain_sql(budget: str) -> str:
    n = caps(budget)
    return f"""WITH j AS MATERIALIZED ({JOBS}), w AS MATERIALIZED ({ANSWERS}),
    one AS (SELECT *, row_number() OVER (ORDER BY priority DESC, brand, job_id, line) AS place FROM j WHERE tier1 QUALIFY place <= {n[0]}),
    asked AS (SELECT job_id, min(place) AS first FROM one GROUP BY 1),
    two AS (SELECT j.*, row_number() OVER (ORDER BY j.priority DESC, x.first) AS place FROM asked x JOIN j ON j.job_id = x.job_id JOIN w a ON a.job_id = x.job_id AND a.tier = 1
        WHERE j.line = (SELECT max(line) FROM j o WHERE o.job_id = x.job_id) AND ({RULE2}) QUALIFY place <= {n[1]}),
    three AS (SELECT j.*, row_number() OVER (ORDER BY j.priority DESC, j.brand, j.job_id, j.line) AS place FROM j LEFT JOIN (SELECT w.* FROM w JOIN asked ON asked.job_id = w.job_id WHERE tier = 1) a ON a.job_id = j.job_id
        LEFT JOIN (SELECT w.* FROM w JOIN two ON two.job_id = w.job_id WHERE w.tier = 2) b ON b.job_id = j.job_id WHERE {RULE3} QUALIFY place <= {n[2]})
    SELECT 1 AS tier, CAST(place AS INT) AS place, job_id, line, brand, priority FROM one UNION ALL SELECT 2, CAST(place AS INT), job_id, line, brand, priority FROM two UNION ALL SELECT 3, CAST(place AS INT), job_id, line, brand, priority FROM three"""


def mesh_rows(spark, sf_dir) -> DataFrame:
    rows = normalized(fixture(spark, sf_dir, "candidates")).filter("brand <> ''")
    hints = [h.strip() + " AS " + n for h, n in ((ROW_HINTS.split(" AS status_hint, ")[0], "status_hint"), (ROW_HINTS.split(" AS status_hint, ")[1].removesuffix(" AS discovery_source"), "discovery_source"))]
    return rows.selectExpr("candidate_id", "k as line", "brand", *hints).withColumn("job_id", F.substring(F.sha2(F.concat("brand", F.lit("|"), "discovery_source"), 256), 1, 16))


def mesh_jobs(spark, sf_dir) -> DataFrame:
    """Queue rows with the deterministic result of their id."""
    rows = mesh_rows(spark, sf_dir)
    det = det_rows(spark, sf_dir).join(rows.select("candidate_id", "line"), "candidate_id").select("line", "entity_type_guess", "redirect_hints", "risk_score", F.array().cast("array<string>").alias("family_hints"))
    return last_results(rows, det)


def mesh_answers(spark, sf_dir) -> DataFrame:
    """What each provider would say of a job: the record of its last row."""
    rows = mesh_rows(spark, sf_dir).groupBy("job_id").agg(F.max("line").alias("k"))
    each = lambda c: F.filter(F.split(c, r"\|"), lambda x: x != "")
    return fixture(spark, sf_dir, "mesh_answers").join(rows, "k").withColumns({"extracted_domains": each("domains"), "family_hints": each("family_hints")})


def chained(budget: str):
    def run(spark, sf_dir) -> DataFrame:
        return tier_chain(R.settled(mesh_jobs(spark, sf_dir), "jobs"), mesh_answers(spark, sf_dir), caps(budget))

    return run


for _b in L.CAPS:
    query(chain_sql(_b), f"tier_chain_{_b}")(chained(_b))


@query(" UNION ALL ".join(f"SELECT '{b}' AS budget, tier, line, job_id FROM ({chain_sql(b)})" for b in (*L.CAPS, "other")))
def budget_topk(spark, sf_dir):
    """The chain under every budget: rows by tier."""
    jobs, answers = R.settled(mesh_jobs(spark, sf_dir), "jobs"), R.settled(mesh_answers(spark, sf_dir), "answers")
    out = None
    for b in (*L.CAPS, "other"):
        own = tier_chain(jobs, answers, caps(b)).select(F.lit(b).alias("budget"), "tier", "line", "job_id")
        out = own if out is None else out.unionByName(own)
    return out


@query(f"SELECT line, job_id, priority, tier1 FROM ({JOBS})")
def research_jobs(spark, sf_dir):
    return mesh_jobs(spark, sf_dir).select("line", "job_id", priority().alias("priority"), first_tier().alias("tier1"))


@query(f"SELECT line, job_id, priority FROM ({JOBS}) WHERE tier1 ORDER BY priority DESC, brand, job_id, line LIMIT {L.CAPS['medium'][0]}")
def research_priority_topk(spark, sf_dir):
    """Rows for the first expensive opinion, under the budget's cap."""
    rows = mesh_jobs(spark, sf_dir).withColumn("priority", priority()).filter(first_tier())
    return R.top_k(rows, caps("medium")[0], [F.desc("priority"), F.col("brand"), F.col("job_id"), F.col("line")]).select("line", "job_id", "priority")


def all_asked(spark, sf_dir) -> DataFrame:
    """Every job as if both tiers had been asked about it."""
    answers = mesh_answers(spark, sf_dir)
    return answered(answered(mesh_jobs(spark, sf_dir), answers, 1), answers, 2)


_ALL = f"FROM ({JOBS}) j LEFT JOIN ({ANSWERS}) a ON a.job_id = j.job_id AND a.tier = 1 LEFT JOIN ({ANSWERS}) b ON b.job_id = j.job_id AND b.tier = 2"


@query(f"SELECT line FROM (SELECT j.line AS line {_ALL} WHERE {RULE2})")
def tier2_eligible(spark, sf_dir):
    return all_asked(spark, sf_dir).filter(second_tier()).select("line")


@query(f"SELECT line FROM (SELECT j.line AS line {_ALL} WHERE {RULE3})")
def tier3_eligible(spark, sf_dir):
    return all_asked(spark, sf_dir).filter(third_tier()).select("line")
