"""Queries over guesses and provider opinions: hosts, argmax, jobs, eligibility, consensus, records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..functions import urls as U
from ..sources import network
from .fixtures import duck, fixture
from .intake import NORMAL, normalized
from .monitor import HITS, HOST, TEXT, page_risk, sql_list, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- hosts ---------------------------------------------------------------------------------------

EMBEDDED = "coalesce(regexp_extract(lower(brand), '\\b((?:[a-z0-9][a-z0-9-]*\\.)+[a-z]{2,63})\\b', 1), '')"
SLUG = "substr(regexp_replace(lower(brand), '[^a-z0-9]+', '', 'g'), 1, 48)"
DISTINCT = lambda xs, n: f"list_filter({xs}, lambda x, i: x IS NOT NULL AND x <> '' AND list_position({xs}, x) = i)[1:{n}]"
GUESSES = DISTINCT("[e, CASE WHEN s <> '' THEN s || '.com' END, CASE WHEN s <> '' THEN s || '.net' END, CASE WHEN s <> '' AND contains(lower(brand), 'casino') AND NOT ends_with(s, 'casino') THEN s || 'casino.com' END, CASE WHEN s <> '' THEN 'play' || s || '.com' END]", 4)


@query(f"SELECT candidate_id, {GUESSES} AS hosts FROM (SELECT candidate_id, brand, {EMBEDDED} AS e, {SLUG} AS s FROM ({NORMAL}))")
def guess_hosts(spark, sf_dir):
    return normalized(fixture(spark, sf_dir, "candidates")).select("candidate_id", U.guess_hosts(F.col("brand")).alias("hosts"))


ENDS = ", ".join(f"CASE WHEN {x} <> '' THEN {x} || '{t}' END" for x in ("s", "o") for t in (".com", ".net", ".org", ".us"))
KIND = "len(list_filter(" + sql_list(L.OPERATOR_CONTEXT) + ", lambda q: contains(lower(brand), q))) > 0 AND s <> ''"
MEMBRANE = DISTINCT(f"[e, {ENDS}, CASE WHEN {KIND} AND NOT ends_with(s, 'casino') THEN s || 'casino.com' END, CASE WHEN {KIND} THEN s || 'sweeps.com' END]", 6)


@query(f"SELECT candidate_id, {MEMBRANE} AS hosts FROM (SELECT *, CASE WHEN contains(s, 'winz') THEN regexp_replace(s, 'winz', 'wins') WHEN contains(s, 'wins') AND NOT contains(s, 'casino') THEN regexp_replace(s, 'wins', 'winz') END AS o FROM (SELECT candidate_id, brand, {EMBEDDED} AS e, {SLUG} AS s FROM ({NORMAL})))")
def membrane_hosts(spark, sf_dir):
    return normalized(fixture(spark, sf_dir, "candidates")).select("candidate_id", U.membrane_hosts(F.col("brand"), L.OPERATOR_CONTEXT).alias("hosts"))


FINAL = f"SELECT page_id, CASE WHEN page_id % 5 = 0 THEN {sql_list(['www.' + h for h in L.KNOWN_OPERATORS])}[page_id % {len(L.KNOWN_OPERATORS)} + 1] WHEN page_id % 5 = 1 THEN 'x' || {sql_list(L.KNOWN_OPERATORS)}[page_id % {len(L.KNOWN_OPERATORS)} + 1] ELSE {HOST('url')} END AS host FROM pages"


def known_match(rows: DataFrame, host: str, spark) -> DataFrame:
    """rows with `known`: the operator host that theirs equals or is below (the smallest of several). The list is a constant, small by nature."""
    known = F.broadcast(spark.createDataFrame([(h,) for h in L.KNOWN_OPERATORS], "known string"))
    found = rows.select(F.col(host).alias("__h")).distinct().select("__h", F.explode(U.suffixes(F.col("__h"))).alias("known")).join(known, "known").groupBy("__h").agg(F.min("known").alias("known"))
    return rows.join(found, rows[host] == found["__h"], "left").drop("__h")


@query(f"SELECT f.page_id, f.host, min(k.known) AS known FROM (SELECT page_id, regexp_replace(host, '^www\\.', '') AS host FROM ({FINAL})) f LEFT JOIN (SELECT unnest({sql_list(L.KNOWN_OPERATORS)}) AS known) k ON f.host = k.known OR ends_with(f.host, '.' || k.known) GROUP BY ALL")
def known_family_match(spark, sf_dir):
    known = F.array(*map(F.lit, L.KNOWN_OPERATORS))
    pick = F.get(known, (F.col("page_id") % len(L.KNOWN_OPERATORS)).cast("int"))
    host = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("www."), pick)).when(F.col("page_id") % 5 == 1, F.concat(F.lit("x"), pick)).otherwise(U.domain_from_url(F.col("url")))
    return known_match(table(spark, sf_dir, "pages").select("page_id", U.strip_www(host).alias("host")), "host", spark).select("page_id", "host", "known")


#: Recorded checks of each guessed host, by moduli of the candidate's key and the guess's place.
CHECKED = """split_part('reachable|redirected|unclear|unreachable|other', '|', CAST((k * 3 + pos * 7) % 5 AS INT) + 1) AS status, CAST((k + pos) % 4 AS DOUBLE) / 4 AS score, (k + pos) % 3 AS n_hits, (k * pos) % 2 AS n_policies"""
FINAL_URL = """CASE WHEN status = 'redirected' AND k % 9 = 0 THEN 'https://m.chumba.com/lobby' WHEN status = 'redirected' THEN concat('https://www.x', guess_host, '/') WHEN (k + pos) % 6 = 1 THEN '' WHEN k % 8 = 2 THEN 'https://other.example/' ELSE concat('https://www.', guess_host, '/') END AS final_url"""
HINTS = "CASE WHEN k % 3 = 0 THEN 'newly_listed' ELSE 'listed' END AS status_hint, CASE k % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'a|b' WHEN 2 THEN 'a|b|c' ELSE 'a|b|c|d' END AS discovery_source"
GUESS_ROWS = f"""SELECT *, {FINAL_URL} FROM (SELECT *, {CHECKED} FROM (SELECT candidate_id, brand, k, {HINTS}, CAST(pos AS BIGINT) AS pos, hosts[pos + 1] AS guess_host, len(hosts) AS n_guesses FROM (SELECT *, unnest(range(len(hosts))) AS pos FROM (SELECT candidate_id, brand, k, {GUESSES} AS hosts FROM (SELECT candidate_id, brand, k, {EMBEDDED} AS e, {SLUG} AS s FROM ({NORMAL}))))))"""


def guess_rows(spark, sf_dir) -> DataFrame:
    n = normalized(fixture(spark, sf_dir, "candidates")).withColumn("hosts", U.guess_hosts(F.col("brand")))
    n = n.select("candidate_id", "brand", "k", *map(F.expr, HINTS.split(", CASE k")[:1]), F.expr("CASE k" + HINTS.split(", CASE k")[1]), F.size("hosts").alias("n_guesses"), F.posexplode("hosts").alias("pos", "guess_host")).withColumn("pos", F.col("pos").cast("long"))
    return n.selectExpr("*", *_split(CHECKED)).selectExpr("*", FINAL_URL)


def _split(columns: str) -> list[str]:
    """The columns of a select list, at commas outside parentheses."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[start:i])
            start = i + 1
    return [*out, columns[start:]]


STATUS = {"reachable": 4, "redirected": 3, "unclear": 2, "unreachable": 1}


def best_guess(rows: DataFrame) -> DataFrame:
    """The best guess of each candidate: the domain that its brand spells out, then by status, by a final host like the brand, by score, hits,
    policies, then the earliest; and how many were any good."""
    rank = F.coalesce(*(F.when(F.col("status") == s, n) for s, n in STATUS.items()), F.lit(0))
    embedded = U.embedded_domain(F.col("brand"))
    spelled = F.when((embedded != "") & (F.col("guess_host") == embedded), 1).otherwise(0)
    key = F.struct(spelled, rank, U.resembles_brand(F.col("brand"), F.col("final_url")), "score", "n_hits", "n_policies", -F.col("pos"))
    rest = F.struct(*(c for c in rows.columns if c != "candidate_id"))
    return rows.groupBy("candidate_id").agg(F.max_by(rest, key).alias("r"), F.count_if(rank >= 2).alias("n_good")).select("candidate_id", "r.*", "n_good")


RANK = "CASE status " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in STATUS.items()) + " ELSE 0 END"
ALIKE = f"CASE WHEN length({SLUG}) >= 4 AND contains(replace({HOST('final_url')}, '.', ''), substr({SLUG}, 1, 10)) AND final_url <> '' THEN 1 ELSE 0 END"
BEST = f"SELECT *, CAST(good AS BIGINT) AS n_good FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY CASE WHEN {EMBEDDED} <> '' AND guess_host = {EMBEDDED} THEN 1 ELSE 0 END DESC, {RANK} DESC, {ALIKE} DESC, score DESC, n_hits DESC, n_policies DESC, pos) AS rn, count(*) FILTER ({RANK} >= 2) OVER (PARTITION BY candidate_id) AS good FROM ({GUESS_ROWS})) WHERE rn = 1"


@query(f"SELECT candidate_id, pos, guess_host, status, score, n_good, n_good > 1 AS ambiguous FROM ({BEST})")
def pick_best_guess(spark, sf_dir):
    return best_guess(guess_rows(spark, sf_dir)).select("candidate_id", "pos", "guess_host", "status", "score", "n_good", (F.col("n_good") > 1).alias("ambiguous"))


def annotated(rows: DataFrame, spark) -> DataFrame:
    """rows with the final host, the known operator it belongs to, the redirect target, and notes that name the operator."""
    rows = rows.withColumn("final_host", U.domain_from_url(F.coalesce("final_url", F.lit(""))))
    rows = known_match(rows, "final_host", spark).withColumn("target", U.redirect_target(F.col("guess_host"), F.col("final_url"), F.col("status")))
    note = F.concat(F.coalesce("notes", F.lit("")), F.lit("; known_operator_family:"), F.col("known")) if "notes" in rows.columns else F.concat(F.lit("; known_operator_family:"), F.col("known"))
    return rows.withColumn("notes", F.substring(F.coalesce(note, F.col("notes") if "notes" in rows.columns else F.lit("")), 1, 500))


TARGET = f"CASE WHEN final_url = '' THEN '' WHEN status = 'redirected' OR ({HOST('final_url')} <> '' AND {HOST('final_url')} <> guess_host) THEN substr(final_url, 1, 500) ELSE '' END"
KNOWN = f"(SELECT min(k.known) FROM (SELECT unnest({sql_list(L.KNOWN_OPERATORS)}) AS known) k WHERE {HOST('final_url')} = k.known OR ends_with({HOST('final_url')}, '.' || k.known))"


@query(f"SELECT candidate_id, pos, known, target, substr('n' || pos || coalesce('; known_operator_family:' || known, ''), 1, 500) AS notes FROM (SELECT *, {TARGET} AS target, {KNOWN} AS known FROM ({GUESS_ROWS}))")
def known_redirects(spark, sf_dir):
    """Every guess: redirect target, known operator, note."""
    rows = guess_rows(spark, sf_dir).withColumn("notes", F.concat(F.lit("n"), F.col("pos").cast("string")))
    return annotated(rows, spark).select("candidate_id", "pos", "known", "target", "notes")


# Points and reasons of the rules, in their order.
WEB = [
    ("status = 'reachable'", "80", "'reachable'"),
    ("status = 'redirected'", "55", "'redirected'"),
    ("status = 'unclear'", "25", "'unclear'"),
    ("status NOT IN ('reachable', 'redirected', 'unclear')", "0", "'unreachable'"),
    ("target <> ''", "12", "'has_redirect_target'"),
    ("known IS NOT NULL", "40", "'redirect_to_known_operator_family'"),
    ("embedded <> ''", "18", "'explicit_domain_in_brand'"),
    ("pipes >= 2", "0", "'multi_source_mention'"),
    ("status_hint = 'newly_listed'", "6", "'newly_listed'"),
    ("like_domain", "10", "'brand_looks_like_domain'"),
]
WEB_SCORE = "5 + score * 35 + n_hits * 6 + n_policies * 5 + pipes * 4 + " + " + ".join(f"(CASE WHEN {c} THEN {p} ELSE 0 END)" for c, p, _ in WEB)
WEB_WHY = "concat_ws(';', " + ", ".join(f"CASE WHEN {c} THEN {w} END" for c, _, w in WEB) + ")"
WEB_MANUAL = "CASE WHEN known IS NOT NULL OR target <> '' THEN 'yes' WHEN n_guesses > 1 AND status IN ('unclear', 'redirected') THEN 'yes' ELSE 'maybe' END"
PIPES = "length(discovery_source) - length(replace(discovery_source, '|', ''))"


NO_GUESSES = "no_domain_guesses_generated"


def summaries(brands: DataFrame, guesses: DataFrame, spark) -> DataFrame:
    """A row for each brand (candidate_id, brand and more): its best guess with redirect target, known operator and notes, which name the operator twice (once as one of
    the guesses, once as the winner); brands without guesses are unreachable, with a note that says so."""
    won = annotated(best_guess(annotated(guesses, spark)).drop("final_host", "known", "target"), spark)
    of = ["guess_host", "status", "score", "n_hits", "n_policies", "final_url", "target", "known", "notes", "n_good", "n_guesses"]
    rows = brands.join(won.select("candidate_id", *of), "candidate_id", "left")
    none = {"guess_host": "", "status": "unreachable", "score": 0.0, "n_hits": 0, "n_policies": 0, "final_url": "", "target": "", "notes": NO_GUESSES, "n_good": 0, "n_guesses": 0}
    return rows.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in none.items()})


def brand_rows(spark, sf_dir) -> DataFrame:
    hints = [h if h.startswith("CASE") else h for h in (HINTS.split(", CASE k")[0], "CASE k" + HINTS.split(", CASE k")[1])]
    return normalized(fixture(spark, sf_dir, "candidates")).selectExpr("candidate_id", "brand", "k", *hints)


def brand_summaries(spark, sf_dir) -> DataFrame:
    rows = guess_rows(spark, sf_dir).withColumn("notes", F.concat(F.lit("n"), F.col("pos").cast("string")))
    return summaries(brand_rows(spark, sf_dir), rows, spark)


TWICE = "substr(substr('n' || pos || coalesce('; known_operator_family:' || known, ''), 1, 500) || coalesce('; known_operator_family:' || known, ''), 1, 500)"
SUMMARY = f"""SELECT n.candidate_id, n.brand, n.k, n.status_hint, n.discovery_source, coalesce(b.guess_host, '') AS guess_host, coalesce(b.status, 'unreachable') AS status, coalesce(b.score, 0::DOUBLE) AS score, coalesce(b.n_hits, 0) AS n_hits, coalesce(b.n_policies, 0) AS n_policies,
    coalesce(b.final_url, '') AS final_url, coalesce(b.target, '') AS target, b.known, CASE WHEN b.candidate_id IS NULL THEN '{NO_GUESSES}' ELSE b.notes END AS notes, coalesce(b.n_good, 0) AS n_good, coalesce(b.n_guesses, 0) AS n_guesses
    FROM (SELECT candidate_id, brand, k, {HINTS} FROM ({NORMAL})) n LEFT JOIN (SELECT *, {TWICE} AS notes FROM (SELECT *, {TARGET} AS target, {KNOWN} AS known FROM ({BEST}))) b ON b.candidate_id = n.candidate_id"""


@query(f"SELECT candidate_id, guess_host AS verified_domain_candidate, status AS verification_status, score AS verification_score, notes AS verification_notes, final_url, known IS NOT NULL AS redirects_to_known_operator_family, coalesce(known, '') AS known_operator_host_match, target AS redirect_target_if_any FROM ({SUMMARY})")
def web_summaries(spark, sf_dir):
    return brand_summaries(spark, sf_dir).select(
        "candidate_id", F.col("guess_host").alias("verified_domain_candidate"), F.col("status").alias("verification_status"), F.col("score").alias("verification_score"), F.col("notes").alias("verification_notes"), "final_url",
        F.col("known").isNotNull().alias("redirects_to_known_operator_family"), F.coalesce("known", F.lit("")).alias("known_operator_host_match"), F.col("target").alias("redirect_target_if_any"),
    )


def web_queue(rows: DataFrame) -> DataFrame:
    """Summaries of brands with priority_score (0 to 200), reasons and whether someone must look."""
    rows = rows.withColumns({"embedded": U.embedded_domain(F.col("brand")), "like_domain": F.col("brand").rlike(r"(?i)\.(com|us|cc|net)\b"), "pipes": F.expr(PIPES)})
    return rows.selectExpr("*", f"cast(greatest(0, least(200, {WEB_SCORE})) as double) as priority_score", f"{WEB_WHY} as why_flagged", f"{WEB_MANUAL} as needs_manual")


WEB_ROWS = f"SELECT *, greatest(0, least(200, {WEB_SCORE}))::DOUBLE AS priority_score, {WEB_WHY} AS why_flagged, {WEB_MANUAL} AS needs_manual FROM (SELECT *, {EMBEDDED} AS embedded, regexp_matches(brand, '\\.(com|us|cc|net)\\b', 'i') AS like_domain, {PIPES} AS pipes FROM ({SUMMARY}))"


@query(f"SELECT candidate_id, priority_score, why_flagged, needs_manual FROM ({WEB_ROWS})")
def web_queue_priority(spark, sf_dir):
    return web_queue(brand_summaries(spark, sf_dir)).select("candidate_id", "priority_score", "why_flagged", "needs_manual")


LIST_NOTE = "web_new_candidates seed; not verified"


def web_rows(rows: DataFrame, source_file: str = "web_new_candidates.csv") -> DataFrame:
    """Rows of a web list (line, brand, status_hint, discovery_source; blank brands go) with up to four guesses, each in normal form where it has one, the file and the list's constants."""
    rows = rows.select("line", *(T.strip(F.coalesce(c, F.lit(""))).alias(c) for c in ("brand", "status_hint", "discovery_source"))).filter("brand <> ''")
    guesses = F.transform(U.guess_hosts(F.col("brand")), lambda h: F.coalesce(F.nullif(U.normalize_domain(h), F.lit("")), h))
    return rows.select("*", guesses.alias("guesses"), F.lit(LIST_NOTE).alias("notes"), F.lit("web_new_candidates").alias("intake_channel"), F.lit("needs_review").alias("review_status"), F.lit(source_file).alias("source_file"))


@query(f"SELECT k AS line, b AS brand, status_hint, discovery_source, {GUESSES} AS guesses, '{LIST_NOTE}' AS notes, 'web_new_candidates' AS intake_channel, 'needs_review' AS review_status, 'web_new_candidates.csv' AS source_file FROM (SELECT *, {EMBEDDED.replace('brand', 'b')} AS e, {SLUG.replace('brand', 'b')} AS s FROM (SELECT k, trim(brand) AS b, {HINTS} FROM ({{candidates}})) WHERE b <> '')")
def web_candidate_rows(spark, sf_dir):
    raw = fixture(spark, sf_dir, "candidates").select(F.col("k").alias("line"), F.concat(F.lit(" "), "brand", F.lit("\t")).alias("brand"), "k").selectExpr("line", "brand", *[h if h.startswith("CASE") else h for h in (HINTS.split(", CASE k")[0], "CASE k" + HINTS.split(", CASE k")[1])])
    return web_rows(raw)


def redirect_report(winners: DataFrame, spark) -> DataFrame:
    """brand, status, target and known operator of every verified brand, and the unverified note of its family. Notes are a constant list."""
    notes = F.broadcast(spark.createDataFrame(sorted(L.FAMILY_NOTES.items()), "brand string, family_note string"))
    return winners.join(notes, "brand", "left").withColumn("family_note", F.coalesce("family_note", F.lit("")))


@query(f"SELECT candidate_id, b AS brand, status_hint, discovery_source, guess_host AS verified_domain_candidate, status, target, known, n_good > 1 AS ambiguity, coalesce(family_note, '') AS family_note FROM (SELECT *, CASE k % 50 WHEN 7 THEN 'Zula' WHEN 8 THEN 'Luck Party' ELSE brand END AS b FROM ({SUMMARY})) LEFT JOIN (VALUES {', '.join(chr(40) + repr(b) + ', ' + repr(n) + chr(41) for b, n in L.FAMILY_NOTES.items())}) f(fb, family_note) ON fb = b")
def redirect_hints_report(spark, sf_dir):
    rows = brand_summaries(spark, sf_dir).withColumn("brand", F.expr("CASE k % 50 WHEN 7 THEN 'Zula' WHEN 8 THEN 'Luck Party' ELSE brand END"))
    return redirect_report(rows, spark).select("candidate_id", "brand", "status_hint", "discovery_source", F.col("guess_host").alias("verified_domain_candidate"), "status", "target", "known", (F.col("n_good") > 1).alias("ambiguity"), "family_note")


# --- jobs ----------------------------------------------------------------------------------------

JOBS = """SELECT d.*, d.entity_type_guess IN ('unresolved', 'likely_redirect_or_rebrand', 'likely_noise') OR lower(d.status_hint) IN ('coming_soon', 'newly_listed', 'new_social') OR lower(d.status_hint) LIKE '%family%' OR d.redirect_hints <> '' OR contains(lower(d.discovery_source), 'sweepskings') AS tier1
    FROM ({provider_result}) d WHERE d.i = 0"""


def jobs(spark, sf_dir) -> DataFrame:
    """Candidates with the result of the deterministic provider, and whether they belong to the first tier."""
    hint = F.lower("status_hint")
    tier1 = F.col("entity_type_guess").isin("unresolved", "likely_redirect_or_rebrand", "likely_noise") | hint.isin("coming_soon", "newly_listed", "new_social") | hint.contains("family") | (F.col("redirect_hints") != "") | F.lower("discovery_source").contains(L.NAMED_SOURCE)
    return fixture(spark, sf_dir, "provider_result").filter("i = 0").withColumn("tier1", tier1)


# --- consensus -----------------------------------------------------------------------------------


def meaningful(p: DataFrame) -> DataFrame:
    return p.filter("i = 0 or status not in ('unavailable', 'stub')")


def consensus(p: DataFrame) -> DataFrame:
    """Label of each candidate: what its external opinions agree on, else the deterministic one; unresolved and contested if labels differ."""
    outside = F.array_sort(F.collect_set(F.when((F.col("i") > 0) & (F.col("entity_type_guess") != "unresolved"), F.col("entity_type_guess"))))
    g = meaningful(p).groupBy("candidate_id").agg(
        outside.alias("outside"),
        F.max(F.when(F.col("i") == 0, F.col("entity_type_guess"))).alias("det"),
        F.count_distinct("entity_type_guess").alias("n_labels"),
        F.count("*").alias("n_opinions"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("provider_name", "entity_type_guess")))).alias("views"),
    )
    contested = F.col("n_labels") > 1
    label = F.when(contested | (F.size("outside") > 1), "unresolved").when(F.size("outside") == 1, F.get("outside", F.lit(0))).otherwise(F.col("det"))
    return g.select("candidate_id", label.alias("consensus"), (contested | (F.size("outside") > 1)).alias("contested"), "n_opinions", "views")


MEANT = "SELECT * FROM ({provider_result}) WHERE i = 0 OR status NOT IN ('unavailable', 'stub')"
CONSENSUS = f"""SELECT candidate_id, CASE WHEN n_labels > 1 OR len(o) > 1 THEN 'unresolved' WHEN len(o) = 1 THEN o[1] ELSE det END AS consensus, n_labels > 1 OR len(o) > 1 AS contested, n_opinions, views FROM (SELECT candidate_id, coalesce(list(DISTINCT entity_type_guess) FILTER (i > 0 AND entity_type_guess <> 'unresolved'), []) AS o,
    max(entity_type_guess) FILTER (i = 0) AS det, count(DISTINCT entity_type_guess) AS n_labels, CAST(count(*) AS BIGINT) AS n_opinions, string_agg(provider_name || '=' || entity_type_guess, ';' ORDER BY provider_name) AS views FROM ({MEANT}) GROUP BY 1)"""


@query(f"SELECT * FROM ({CONSENSUS})")
def consensus_merge(spark, sf_dir):
    c = consensus(fixture(spark, sf_dir, "provider_result"))
    return c.withColumn("views", F.array_join(F.transform(F.map_entries("views"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"))


@query(f"SELECT consensus, CAST(count(*) AS BIGINT) AS n FROM ({CONSENSUS}) GROUP BY 1")
def consensus_label_counts(spark, sf_dir):
    return consensus(fixture(spark, sf_dir, "provider_result")).groupBy("consensus").agg(F.count("*").alias("n"))


@query(f"""SELECT candidate_id, 'entity_type_guess' AS topic FROM ({MEANT}) GROUP BY 1 HAVING count(*) >= 2 AND count(DISTINCT entity_type_guess) > 1
    UNION ALL SELECT candidate_id, 'extracted_domains' FROM (SELECT candidate_id, d, count(DISTINCT i) AS c, max(n) AS n FROM (SELECT candidate_id, i, unnest(string_split(domains, '|')) AS d, count(*) OVER (PARTITION BY candidate_id) AS n FROM ({MEANT}) WHERE domains <> '') GROUP BY 1, 2) GROUP BY 1 HAVING max(n) >= 2 AND min(c) < max(n)""")
def disagreements(spark, sf_dir):
    m = meaningful(fixture(spark, sf_dir, "provider_result"))
    labels = m.groupBy("candidate_id").agg(F.count("*").alias("n"), F.count_distinct("entity_type_guess").alias("d")).filter("n >= 2 and d > 1").select("candidate_id", F.lit("entity_type_guess").alias("topic"))
    sets = m.filter("domains <> ''")
    n = sets.groupBy("candidate_id").agg(F.count("*").alias("n")).filter("n >= 2")
    each = sets.select("candidate_id", "i", F.explode(F.split("domains", r"\|")).alias("d")).groupBy("candidate_id", "d").agg(F.count_distinct("i").alias("c"))
    domains = each.join(n, "candidate_id").filter("c < n").select("candidate_id").distinct().select("candidate_id", F.lit("extracted_domains").alias("topic"))
    return labels.unionByName(domains)


@query("SELECT provider_name, CAST(count(*) FILTER (kind = 'cache') AS BIGINT) AS cache_hits, CAST(count(*) FILTER (kind = 'unavailable') AS BIGINT) AS unavailable, CAST(count(*) FILTER (kind = 'error') AS BIGINT) AS errors, CAST(count(*) FILTER (kind = 'live') AS BIGINT) AS live_calls FROM (SELECT provider_name, CASE WHEN cached THEN 'cache' WHEN status = 'unavailable' THEN 'unavailable' WHEN status = 'error' THEN 'error' ELSE 'live' END AS kind FROM ({provider_result})) GROUP BY 1")
def provider_stats(spark, sf_dir):
    kind = F.when(F.col("cached"), "cache").when(F.col("status") == "unavailable", "unavailable").when(F.col("status") == "error", "error").otherwise("live")
    p = fixture(spark, sf_dir, "provider_result").select("provider_name", kind.alias("kind"))
    n = lambda k: F.count_if(F.col("kind") == k)
    return p.groupBy("provider_name").agg(n("cache").alias("cache_hits"), n("unavailable").alias("unavailable"), n("error").alias("errors"), n("live").alias("live_calls"))


LIVE = ["reachable", "redirected", "unclear"]


def deterministic(checks: DataFrame, bodies: DataFrame) -> DataFrame:
    """Each candidate's label from its checks (candidate_id, pos, guess_host, status, final_url, dns_ok) and the risk of its first live page's body
    (candidate_id, pos, body): entity_type_guess, confidence_hint, extracted_domains, redirect_hints, disagreement_flags, risk_score, keyword_hits, digest."""
    live = checks.filter(F.col("status").isin(LIVE)).join(bodies.filter("body <> ''"), ["candidate_id", "pos"]).groupBy("candidate_id").agg(F.min_by("body", "pos").alias("body"))
    risk = live.select("candidate_id", T.hits(T.html_to_text(F.col("body")), list(L.RISK)).alias("keyword_hits"))
    each = F.array_sort(F.collect_list(F.struct("pos", "guess_host", "status", "score", "final_url", "dns_ok")))  # at most eight of a candidate
    rows = checks.groupBy("candidate_id").agg(each.alias("c")).join(risk, "candidate_id", "left")
    rows = rows.withColumn("keyword_hits", F.coalesce("keyword_hits", F.array().cast("array<string>"))).withColumn("risk_score", page_risk(F.col("keyword_hits"), F.lit(0)))
    has = lambda *xs: F.exists("c", lambda x: x["status"].isin(*xs))
    hit = lambda xs: F.arrays_overlap("keyword_hits", F.array(*map(F.lit, xs)))
    label = (
        F.when(has("redirected"), "likely_redirect_or_rebrand").when(has("reachable") & (hit(L.OPERATOR_HITS) | hit(L.CASHIER_HITS)), "likely_real_operator")
        .when(~has(*LIVE), "unresolved").when((F.col("risk_score") >= 40) & ~has("reachable"), "likely_noise").otherwise("unresolved")
    )
    mixed = F.size(F.array_distinct(F.transform("c", lambda x: x["status"]))) > 1
    lines = F.transform(F.slice("c", 1, 6), lambda x: F.concat(x["guess_host"], F.lit(": status="), x["status"], F.lit(" score="), x["score"].cast("string")))
    names = F.concat(F.lit("["), F.array_join(F.transform("keyword_hits", lambda h: F.concat(F.lit("'"), h, F.lit("'"))), ", "), F.lit("]"))
    digest = F.substring(F.array_join(F.concat(lines, F.array(F.concat(F.lit("page_risk_score="), F.col("risk_score").cast("string"), F.lit(" hits="), names))), "\n"), 1, 4000)
    return rows.withColumn("entity_type_guess", label).select(
        "candidate_id", "entity_type_guess", F.when(F.col("entity_type_guess") != "unresolved", 0.55).otherwise(0.35).alias("confidence_hint"),
        F.expr("transform(filter(c, x -> x.dns_ok), x -> x.guess_host)").alias("extracted_domains"), F.expr("transform(filter(c, x -> x.status = 'redirected' and x.final_url <> ''), x -> x.final_url)").alias("redirect_hints"),
        F.when(mixed, F.array(F.lit("mixed_verification_status_across_hosts"))).otherwise(F.array().cast("array<string>")).alias("disagreement_flags"), "risk_score", "keyword_hits", digest.alias("digest"),
    )


def enriched(det: DataFrame) -> DataFrame:
    """What the risk of the page and the redirects say to a reviewer: signup and cashier surfaces, hints joined by `; ` (null without any)."""
    hit = lambda *xs: F.arrays_overlap("keyword_hits", F.array(*map(F.lit, xs)))
    hints = F.concat_ws("; ", F.when(F.col("risk_score") >= 45, "high_page_risk_score"), F.when(F.size("redirect_hints") > 0, "redirect_observed"), F.when(hit("verify identity"), "identity_verification_language"))
    return det.withColumns({
        "likely_signup_surface": F.when(hit("register") & hit("login"), "elevated_register_login_language"),
        "likely_cashier_surface": F.when(hit("cashier", "deposit", "wallet", "card number"), "elevated_payment_cashier_language"),
        "safe_paste_trigger_hint": F.nullif(hints, F.lit("")),
    })


DET_CHECKS = f"SELECT *, status <> 'unreachable' AND k % 10 <> 3 AS dns_ok FROM ({GUESS_ROWS}) WHERE (k * 3) % 7 + 1 > pos"


def det_rows(spark, sf_dir) -> DataFrame:
    checks = guess_rows(spark, sf_dir).filter("(k * 3) % 7 + 1 > pos").withColumn("dns_ok", F.expr("status <> 'unreachable' AND k % 10 <> 3"))
    pages = fixture(spark, sf_dir, "pages_lex").select("page_id", F.col("html").alias("body"))
    n = fixture(spark, sf_dir, "n_pages")
    keyed = checks.crossJoin(F.broadcast(n)).select("candidate_id", "pos", F.expr("(k + pos) % n").alias("page_id"))  # one row
    bodies = keyed.join(pages, "page_id").select("candidate_id", "pos", F.expr("case when page_id % 17 = 0 then '' else body end").alias("body"))
    return deterministic(checks, bodies)


RISK_OF = f"CAST(least(100.0::DOUBLE, round(least(85.0::DOUBLE, coalesce(list_sum(list_transform(hits, lambda h: 4 * (CASE {' '.join(f'WHEN h = {chr(39)}{k}{chr(39)} THEN {w}' for k, w in L.RISK.items())} END)::DOUBLE)), 0)), 2)) AS DOUBLE)"
DET = f"""SELECT *, CASE WHEN redirected THEN 'likely_redirect_or_rebrand' WHEN reachable AND len(list_filter(hits, lambda h: list_contains({sql_list(L.OPERATOR_HITS + L.CASHIER_HITS)}, h))) > 0 THEN 'likely_real_operator' WHEN NOT live THEN 'unresolved' WHEN risk >= 40 AND NOT reachable THEN 'likely_noise' ELSE 'unresolved' END AS entity FROM (SELECT *, {RISK_OF} AS risk FROM (
    SELECT c.candidate_id, c.redirected, c.reachable, c.live, c.mixed, c.extracted, c.finals, coalesce(r.hits, []) AS hits FROM (SELECT candidate_id, bool_or(status = 'redirected') AS redirected, bool_or(status = 'reachable') AS reachable, bool_or(status IN ('reachable', 'redirected', 'unclear')) AS live, count(DISTINCT status) > 1 AS mixed,
    coalesce(list(guess_host ORDER BY pos) FILTER (dns_ok), []) AS extracted, coalesce(list(final_url ORDER BY pos) FILTER (status = 'redirected' AND final_url <> ''), []) AS finals FROM ({DET_CHECKS}) GROUP BY 1) c LEFT JOIN (SELECT candidate_id, list_sort({HITS('t', list(L.RISK))}) AS hits FROM (SELECT candidate_id, {TEXT('min_by(html, pos)')} AS t FROM ({DET_CHECKS}) d
    CROSS JOIN ({{n_pages}}) c JOIN ({{pages_lex}}) p ON p.page_id = (d.k + d.pos) % c.n WHERE status IN ('reachable', 'redirected', 'unclear') AND p.page_id % 17 <> 0 GROUP BY 1)) r ON r.candidate_id = c.candidate_id))"""


@query(f"SELECT candidate_id, entity AS entity_type_guess, CASE WHEN entity <> 'unresolved' THEN 0.55::DOUBLE ELSE 0.35::DOUBLE END AS confidence_hint, extracted AS extracted_domains, finals AS redirect_hints, CASE WHEN mixed THEN ['mixed_verification_status_across_hosts'] ELSE [] END AS disagreement_flags, risk AS risk_score FROM ({DET})")
def deterministic_entity(spark, sf_dir):
    return det_rows(spark, sf_dir).select("candidate_id", "entity_type_guess", "confidence_hint", "extracted_domains", "redirect_hints", "disagreement_flags", "risk_score")


@query(f"""SELECT candidate_id, CASE WHEN list_contains(hits, 'register') AND list_contains(hits, 'login') THEN 'elevated_register_login_language' END AS likely_signup_surface, CASE WHEN len(list_filter(hits, lambda h: list_contains(['cashier', 'deposit', 'wallet', 'card number'], h))) > 0 THEN 'elevated_payment_cashier_language' END AS likely_cashier_surface,
    nullif(concat_ws('; ', CASE WHEN risk >= 45 THEN 'high_page_risk_score' END, CASE WHEN len(finals) > 0 THEN 'redirect_observed' END, CASE WHEN list_contains(hits, 'verify identity') THEN 'identity_verification_language' END), '') AS safe_paste_trigger_hint FROM ({DET})""")
def enrichment_hints(spark, sf_dir):
    return enriched(det_rows(spark, sf_dir)).select("candidate_id", "likely_signup_surface", "likely_cashier_surface", "safe_paste_trigger_hint")


@query(f"""SELECT d.candidate_id, substr(concat_ws(chr(10), lines, 'page_risk_score=' || CAST(risk AS VARCHAR) || ' hits=[' || array_to_string(list_transform(hits, lambda h: chr(39) || h || chr(39)), ', ') || ']'), 1, 4000) AS digest FROM ({DET}) d
    JOIN (SELECT candidate_id, string_agg(guess_host || ': status=' || status || ' score=' || CAST(score AS VARCHAR), chr(10) ORDER BY pos) AS lines FROM ({DET_CHECKS}) WHERE pos < 6 GROUP BY 1) c ON c.candidate_id = d.candidate_id""")
def result_digests(spark, sf_dir):
    return det_rows(spark, sf_dir).select("candidate_id", "digest")


# --- records of the network ----------------------------------------------------------------------


@query("SELECT p_size AS k, array_to_string(list_transform(list_sort(list_distinct([(10 + p_size % 3, 'mx1.' || d), (10 + (p_size + 1) % 2, 'mx2.' || d), (10 + p_size % 3, 'mx1.' || d)])), lambda x: x[1] || ' ' || x[2]), ',') AS mx FROM (SELECT DISTINCT p_size, 'h' || p_size || '.com' AS d FROM part)")
def mx_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_size").distinct()
    r = p.selectExpr("p_size as k", "array(struct(10 + p_size % 3 as priority, concat('MX1.h', p_size, '.com.') as host), struct(10 + (p_size + 1) % 2 as priority, concat('mx2.h', p_size, '.COM') as host), struct(10 + p_size % 3 as priority, concat('mx1.h', p_size, '.com') as host)) as records")
    return r.select("k", F.array_join(F.transform(network.merged_mx(F.col("records")), lambda m: F.concat(m["priority"].cast("string"), F.lit(" "), m["host"])), ",").alias("mx"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS not_after FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 10 = 0")
def cert_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 10 == 0, "no date").otherwise(F.concat(F.date_format("o_orderdate", "MMM  d HH:mm:ss yyyy"), F.lit(" GMT")))
    return o.select("o_orderkey", T.cert_time(raw).alias("not_after"))


@query("SELECT DISTINCT lower(s_name) AS domain FROM supplier UNION SELECT DISTINCT 'key' || (s_suppkey % 7) FROM supplier")
def snapshot_domains(spark, sf_dir):
    """Known domains from snapshot documents: lists of strings or objects, or keys of a map."""
    s = table(spark, sf_dir, "supplier").selectExpr("case s_suppkey % 2 when 0 then to_json(named_struct('domains', array(s_name))) else to_json(named_struct('entities', array(named_struct('domain', s_name)))) end as list_doc", "to_json(map('known_domains', map(concat('key', s_suppkey % 7), 1))) as map_doc")
    lists = s.select(F.from_json("list_doc", "domains array<string>, entities array<struct<domain:string>>").alias("d")).select(F.explode(F.concat(F.coalesce("d.domains", F.array().cast("array<string>")), F.coalesce("d.entities.domain", F.array().cast("array<string>")))).alias("x"))
    maps = s.select(F.from_json("map_doc", "known_domains map<string,int>").alias("d")).select(F.explode(F.map_keys("d.known_domains")).alias("x"))
    return lists.union(maps).select(F.lower("x").alias("domain")).distinct()


@query("""SELECT c_custkey, sha256('{"balance_cents":' || CAST(round(c_acctbal * 100) AS BIGINT) || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}') AS payload_hash FROM customer""")
def payload_hash(spark, sf_dir):
    """SHA-256 of canonical JSON: keys in order, no spaces."""
    c = table(spark, sf_dir, "customer")
    doc = F.to_json(F.struct(F.round(F.col("c_acctbal") * 100).cast("long").alias("balance_cents"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))
    return c.select("c_custkey", F.sha2(doc, 256).alias("payload_hash"))
