"""Queries over recorded answers of providers: fields, status cascade, answer cache, joins with jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import lexicon as L
from ..sources import caches
from .fixtures import duck, fixture
from .monitor import sql_list
from .research import JOBS, MEANT, jobs, meaningful

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


LISTS = lambda p, n: f"(list_filter(CASE json_type(j, '$.{p}') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.{p}') AS VARCHAR[]) WHEN 'VARCHAR' THEN [json_extract_string(j, '$.{p}')] ELSE [] END, lambda x: x <> ''))[1:{n}]"
TEXT_OF = lambda p: f"coalesce(json_extract_string(j, '$.{p}'), '')"
FOUND = "CASE WHEN regexp_matches(text, '```') THEN regexp_extract(text, '```(?:json)?\\s*(\\{.*?\\})\\s*```', 1, 'is') WHEN json_valid(regexp_extract(text, '\\{[^{}]*\\}')) THEN regexp_extract(text, '\\{[^{}]*\\}') END"
FIELDS = f"""SELECT *, CASE WHEN list_contains({sql_list(L.ENTITY_LABELS)}, trim({TEXT_OF('entity_type_guess')})) THEN trim({TEXT_OF('entity_type_guess')}) ELSE 'unresolved' END AS label, {LISTS('citations', 30)} AS citations, list_transform({LISTS('extracted_domains', 30)}, lambda x: trim(lower(x))) AS extracted, {LISTS('family_hints', 20)} AS family, {LISTS('footer_or_company_phrases', 10)} AS phrases,
    greatest(0::DOUBLE, least(1::DOUBLE, coalesce(TRY_CAST({TEXT_OF('confidence_hint')} AS DOUBLE), 0.45::DOUBLE))) AS conf, substr({TEXT_OF('notes')}, 1, 2000) AS note, {TEXT_OF('same_backend_or_legal_language_hint')} AS hint FROM (SELECT *, {FOUND} AS j FROM ({{provider_answers}}))"""


@query(f"SELECT candidate_id, tier, label AS entity_type_guess, citations, extracted AS extracted_domains, family AS family_hints, conf AS confidence_hint, note AS notes FROM ({FIELDS}) WHERE j IS NOT NULL")
def answer_fields(spark, sf_dir):
    rows = fixture(spark, sf_dir, "provider_answers").withColumn("j", A.json_object(F.col("text"))).filter("j is not null").withColumn("f", A.fields(F.col("j")))
    return rows.select("candidate_id", "tier", *(f"f.{c}" for c in ("entity_type_guess", "citations", "extracted_domains", "family_hints", "confidence_hint", "notes")))


def results(rows: DataFrame) -> DataFrame:
    """A result for each call (candidate_id, tier, has_key, cached: JSON of fields or null, refresh, error, text): no key, a cached answer, an error, nothing parsed
    (an error of the first tier, unavailable for the others), an empty object (an error), or what was parsed. The last tier adds phrases to the family hints and its
    hint to the notes; what goes to the cache has the former only. to_cache: JSON of the fields of a fresh answer."""
    rows = rows.withColumn("j", A.json_object(F.col("text")))
    hit, got = F.col("cached").isNotNull() & ~F.col("refresh"), F.col("j").isNotNull() & (F.regexp_replace("j", r"\s", "") != "{}")
    state = (
        F.when(~F.col("has_key"), "no_key").when(hit, "cached").when(F.col("error").isNotNull() & F.col("j").isNull(), "failed")
        .when(F.col("j").isNull() & (F.col("tier") > 1), "silent").when(~got, "empty").otherwise("fresh")
    )
    rows = rows.withColumn("state", state).withColumn("f", A.fields(F.when(F.col("state") == "cached", F.col("cached")).when(F.col("state") == "fresh", F.col("j"))))
    status = F.when(F.col("state").isin("cached", "fresh"), "ok").when(F.col("state").isin("no_key", "silent"), "unavailable").otherwise("error")
    last = (F.col("tier") == 3) & (F.col("state") == "fresh")
    family = F.when(last, F.concat("f.family_hints", "f.phrases")).otherwise(F.col("f.family_hints"))
    notes = (
        F.when(F.col("state") == "no_key", "no key").when(F.col("state") == "failed", F.substring("error", 1, 1500)).when(F.col("state") == "silent", "empty").when(F.col("state") == "empty", "empty_parse")
        .when(last & (F.col("f.language_hint") != ""), F.substring(F.concat("f.notes", F.lit(" | "), "f.language_hint"), 1, 2000)).when((F.col("state") == "cached") & (F.col("f.notes") == ""), "cached").otherwise(F.col("f.notes"))
    )
    sure = F.when(F.coalesce("f.confidence_hint", F.lit(0.0)) == 0.0, A.FALLBACK).otherwise(F.col("f.confidence_hint"))
    kept = F.to_json(F.struct("f.citations", F.col("f.confidence_hint"), "f.entity_type_guess", "f.extracted_domains", family.alias("family_hints"), "f.notes", "f.redirect_hints"))
    answered = F.col("state").isin("cached", "fresh")
    none = F.array().cast("array<string>")
    return rows.select(
        "candidate_id", "tier", status.alias("status"), (F.col("state") == "cached").alias("cached"), F.when(answered, F.col("f.entity_type_guess")).otherwise("unresolved").alias("entity_type_guess"), sure.alias("confidence_hint"),
        *(F.when(answered, x).otherwise(none).alias(n) for n, x in (("citations", F.col("f.citations")), ("extracted_domains", F.col("f.extracted_domains")), ("family_hints", family))), notes.alias("notes"), F.when(F.col("state") == "fresh", kept).alias("to_cache"),
    )


def minimal(results: DataFrame) -> DataFrame:
    """What goes on to the next provider of a result: label, domains, ten citations, 500 characters of notes and the confidence, as JSON in column `minimal`."""
    short = F.struct("citations", "confidence_hint", "entity_type_guess", "extracted_domains", "notes")
    cut = results.withColumns({"citations": F.slice("citations", 1, 10), "notes": F.substring("notes", 1, 500)})
    return cut.select("candidate_id", "tier", F.to_json(short).alias("minimal"))


STATE = "CASE WHEN NOT has_key THEN 'no_key' WHEN cached IS NOT NULL AND NOT refresh THEN 'cached' WHEN error IS NOT NULL AND j IS NULL THEN 'failed' WHEN j IS NULL AND tier > 1 THEN 'silent' WHEN j IS NULL OR j = '{}' THEN 'empty' ELSE 'fresh' END"
RESULTS = f"""SELECT candidate_id, tier, CASE WHEN state IN ('cached', 'fresh') THEN 'ok' WHEN state IN ('no_key', 'silent') THEN 'unavailable' ELSE 'error' END AS status, state = 'cached' AS cached, CASE state WHEN 'cached' THEN 'unresolved' WHEN 'fresh' THEN label ELSE 'unresolved' END AS entity_type_guess, CASE WHEN state <> 'fresh' OR conf = 0 THEN 0.45::DOUBLE ELSE conf END AS confidence_hint,
    CASE WHEN state = 'fresh' THEN extracted ELSE [] END AS extracted_domains, CASE WHEN state = 'cached' THEN ['kept'] WHEN state = 'fresh' AND tier = 3 THEN list_concat(family, phrases) WHEN state = 'fresh' THEN family ELSE [] END AS family_hints,
    CASE state WHEN 'no_key' THEN 'no key' WHEN 'failed' THEN substr(error, 1, 1500) WHEN 'silent' THEN 'empty' WHEN 'empty' THEN 'empty_parse' WHEN 'cached' THEN 'cached' ELSE CASE WHEN tier = 3 AND hint <> '' THEN note || ' | ' || hint ELSE note END END AS notes FROM (SELECT *, {STATE} AS state FROM ({FIELDS}))"""


@query(RESULTS)
def provider_results(spark, sf_dir):
    return results(fixture(spark, sf_dir, "provider_answers")).drop("citations", "to_cache")


@query(f"""SELECT candidate_id, tier, CAST(json_object('citations', CASE WHEN status = 'ok' AND NOT cached THEN own ELSE [] END, 'confidence_hint', confidence_hint, 'entity_type_guess', entity_type_guess, 'extracted_domains', extracted_domains, 'notes', substr(notes, 1, 500)) AS VARCHAR) AS minimal
    FROM (SELECT r.*, f.citations[1:10] AS own FROM ({RESULTS}) r JOIN ({FIELDS}) f ON f.candidate_id = r.candidate_id AND f.tier = r.tier)""")
def minimal_results(spark, sf_dir):
    return minimal(results(fixture(spark, sf_dir, "provider_answers")))


@query(f"""SELECT c.candidate_id, c.key IS NOT NULL AND c.k % 5 <> 1 AS hit, CASE WHEN c.k % 5 = 1 THEN NULL WHEN c.k % 5 = 0 THEN 'new' ELSE 'old' END AS payload FROM (SELECT candidate_id, k, candidate_id || '_tier_one_' || substr(sha256(candidate_id || '|tier one|v1|' || brand || '|' || substr('a.com|b.com', 1, 200)), 1, 32) AS key
    FROM (SELECT DISTINCT candidate_id, brand, CAST(substr(candidate_id, 2) AS BIGINT) AS k FROM ({{provider_result}}) WHERE i = 0)) c""")
def answer_cache(spark, sf_dir):
    """Answers set, replaced, dropped and looked up again by key and version."""
    p = fixture(spark, sf_dir, "provider_result").filter("i = 0").select("candidate_id", "brand", F.expr("cast(substr(candidate_id, 2) as bigint)").alias("k")).distinct()
    key = caches.answer_key(F.col("candidate_id"), F.lit("tier one"), "v1", F.concat(F.lit(" "), "brand"), F.array(F.lit("b.com"), F.lit("a.com")))
    p = p.withColumn("key", key)
    old = p.select("key", F.lit("v1").alias("version"), F.lit("old").alias("payload"))
    new = p.filter("k % 5 = 0").select("key", F.lit("v1").alias("version"), F.lit("new").alias("payload"))
    cache = caches.drop_answers(caches.set_answers(old, new), p.filter("k % 5 = 1"))
    got = caches.get_answers(p, cache, "v1")
    return got.select("candidate_id", F.col("payload").isNotNull().alias("hit"), "payload")


@query(f"SELECT j.candidate_id, CAST(count(*) AS BIGINT) AS n_results FROM ({JOBS}) j JOIN ({{provider_result}}) p ON p.candidate_id = j.candidate_id AND p.i > 0 AND p.status <> 'unavailable' WHERE j.tier1 GROUP BY 1")
def jobs_with_results(spark, sf_dir):
    """Jobs of the first tier with the answers they got; jobs without any are out."""
    p = fixture(spark, sf_dir, "provider_result").filter("i > 0 and status <> 'unavailable'")
    return jobs(spark, sf_dir).filter("tier1").select("candidate_id").join(p, "candidate_id").groupBy("candidate_id").agg(F.count("*").alias("n_results"))


@query(f"SELECT candidate_id, coalesce(list_sort(list(DISTINCT d) FILTER (d <> '')), []) AS merged_domains FROM (SELECT candidate_id, unnest(string_split(domains, '|')) AS d FROM ({MEANT})) GROUP BY 1")
def merged_domains(spark, sf_dir):
    """Every domain that any meaningful result names."""
    m = meaningful(fixture(spark, sf_dir, "provider_result")).select("candidate_id", F.explode(F.split("domains", r"\|")).alias("d"))
    return m.groupBy("candidate_id").agg(F.array_sort(F.collect_set(F.when(F.col("d") != "", F.col("d")))).alias("merged_domains"))


@query(f"SELECT candidate_id, string_agg(provider_name || ':' || status || ':' || printf('%.2f', confidence_hint) || ':' || domains, ';' ORDER BY provider_name) AS views FROM ({{provider_result}}) GROUP BY 1")
def provider_views(spark, sf_dir):
    """What each provider said of a candidate: a map from its name to label, status, confidence and domains."""
    one = F.struct("provider_name", F.struct("entity_type_guess", "status", "confidence_hint", F.split("domains", r"\|").alias("domains")).alias("view"))
    views = fixture(spark, sf_dir, "provider_result").groupBy("candidate_id").agg(F.map_from_entries(F.collect_list(one)).alias("m"))
    line = lambda e: F.concat_ws(":", e["key"], e["value"]["status"], F.format_string("%.2f", e["value"]["confidence_hint"]), F.array_join(e["value"]["domains"], "|"))
    return views.select("candidate_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), line), ";").alias("views"))
