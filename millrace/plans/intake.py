"""Queries over candidate lists: tables, bulk lines, normal form, duplicates, buckets, queues, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import lexicon as L
from ..functions import text as T
from ..functions import urls as U
from ..operators import relational as R
from .fixtures import duck, fixture
from .monitor import HITS, HOST, TEXT, URL, sql_list, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = duck(sql)
        return f

    return add


# --- sources -------------------------------------------------------------------------------------


def markdown_rows(lines: DataFrame) -> DataFrame:
    """file, source_set, row_index, cells (map from header to cell). The first row of two or more cells of a file is its header, for all of the file;
    separators and rows of fewer cells go, short rows are padded, long ones cut; of equal header names the last one counts."""
    rows = lines.withColumn("cells", F.when(F.trim("text").startswith("|"), T.table_cells(F.col("text")))).filter("size(cells) >= 2")
    head = rows.groupBy("file").agg(F.min_by(F.struct("pos", "cells"), "pos").alias("head"))
    data = rows.join(head, "file").filter("pos > head.pos").filter(~T.is_separator(F.col("cells")))
    names = F.transform("head.cells", lambda c: F.regexp_replace(F.lower(c), r"\s+", "_"))
    data = data.withColumn("names", names).withColumn("at", F.expr("filter(sequence(1, size(names)), i -> not array_contains(slice(names, i + 1, size(names)), names[i - 1]))"))
    cells = F.map_from_arrays(F.expr("transform(at, i -> names[i - 1])"), F.expr("transform(at, i -> coalesce(try_element_at(cells, i), ''))"))
    data = R.numbered(data.select("file", "pos", cells.alias("cells")), ["file", "pos"], "n")
    first = data.groupBy("file").agg(F.min("n").alias("first"))
    return data.join(first, "file").select("file", source_set(F.col("file")).alias("source_set"), (F.col("n") - F.col("first")).alias("row_index"), "cells")


def source_set(path: Column) -> Column:
    """set2 or set1 if the file's name says so, else the name without its ending, in lower case."""
    stem = F.lower(F.regexp_replace(F.regexp_replace(path.cast("string"), "^.*/", ""), r"(?<=.)\.[^.]*$", ""))
    return F.when(stem.contains("set2"), "set2").when(stem.contains("set1"), "set1").otherwise(stem)


CELLS = r"list_transform(string_split(regexp_replace(regexp_replace(trim(text), '^\|', ''), '\|$', ''), '|'), lambda c: trim(c))"


@query(rf"""WITH k AS (SELECT file, pos, {CELLS} AS cells FROM ({{md_lines}}) WHERE starts_with(trim(text), '|') AND len({CELLS}) >= 2), h AS (SELECT file, min(pos) AS p FROM k GROUP BY file)
    SELECT k.file, CAST(k.file AS VARCHAR) AS source_set, row_number() OVER (PARTITION BY k.file ORDER BY pos) - 1 AS row_index, coalesce(cells[1], '') AS brand, coalesce(cells[2], '') AS primary_domain, coalesce(cells[3], '') AS notes
    FROM k JOIN h ON h.file = k.file AND k.pos > h.p WHERE len(list_filter(cells, lambda c: c <> '' AND NOT regexp_matches(c, '^:?-+:?$'))) > 0""")
def markdown_table_parse(spark, sf_dir):
    r = markdown_rows(fixture(spark, sf_dir, "md_lines"))
    return r.select("file", "source_set", "row_index", *(F.col("cells")[c].alias(c) for c in ("brand", "primary_domain", "notes")))


def content_lines(lines: DataFrame) -> DataFrame:
    """line, t (stripped): without blank, comment and decorative lines."""
    t = T.strip(F.col("text"))
    return lines.select("line", t.alias("t")).filter((F.col("t") != "") & ~F.col("t").startswith("#") & ~F.col("t").rlike(f"(?i){L.SKIP_LINE}"))


def bulk_rows(lines: DataFrame) -> DataFrame:
    """line, kind, brand, raw_domain, domain, notes, fragment and optional fields: each line by the first form of a cascade that gives a domain
    (table row, named fields, URL, cells, host); header and separator rows and lines without a domain give nothing."""
    edges = lambda c, more="": F.regexp_replace(c, rf"^[\s|–—\-{more}]+|[\s|–—\-{more}]+$", "")
    t, cells = F.col("t"), F.col("cells")
    rows = content_lines(lines).withColumn("row", t.rlike(r"^\|.*\|") | t.rlike(r"^\|[^|]+\|")).withColumn("cells", F.when(F.col("row"), T.table_cells(t)))
    gone = (F.size("cells") >= 2) & F.get("cells", F.lit(0)).rlike(r"^(:?-+:?)?$") | F.lower(F.coalesce(F.get("cells", F.lit(0)), F.lit(""))).isin(L.HEADER_WORDS)
    rows = rows.filter(~(F.col("row") & F.coalesce(gone, F.lit(False))))
    rest = F.array_join(F.slice(cells, 2, F.size(cells)), " | ")
    in_table = F.when(F.size(cells) >= 2, T.once(rest, lambda r: F.coalesce(F.nullif(T.first_match(r, L.ANY_URL), F.lit("")), F.nullif(T.first_domain(r), F.lit("")), F.get(cells, F.lit(1)))))
    split = F.filter(F.transform(F.when(t.contains("\t"), F.split(t, "\t")).when(t.contains("|") & ~t.startswith("|"), F.split(t, r"\|")).otherwise(F.array().cast("array<string>")), T.strip), lambda c: c != "")
    rows = rows.select("*", F.coalesce(in_table, F.lit("")).alias("table_domain"), T.first_match(t, L.ANY_URL).alias("url"), T.first_domain(t).alias("host"), split.alias("parts"))
    named = [F.regexp_extract(t, f"(?i){p}", k) for p, k in ((L.BRAND_FIRST, 1), (L.BRAND_FIRST, 2), (L.DOMAIN_FIRST, 2), (L.DOMAIN_FIRST, 1))]
    part = F.coalesce(F.get("parts", F.lit(1)), F.lit(""))
    kind = (
        F.when(F.col("table_domain") != "", "table").when(named[1] != "", "brand_first").when(named[3] != "", "domain_first").when(F.col("url") != "", "url")
        .when(F.size("parts") >= 2, "cells").when(F.col("host") != "", "host")
    )
    rows = rows.withColumn("kind", kind).filter("kind is not null")
    k, at = F.col("kind"), F.position(F.col("url"), t)
    before, after = edges(F.left(t, at - 1)), edges(F.substr(t, at + F.length("url")))
    without_host = edges(F.regexp_replace(t, F.concat(F.lit(r"\Q"), F.col("host"), F.lit(r"\E")), ""), ",:;")
    brand = (
        F.when(k == "table", F.get("cells", F.lit(0))).when(k == "brand_first", named[0]).when(k == "domain_first", named[2]).when(k == "url", F.when(before != "", before).otherwise(after))
        .when(k == "cells", F.get("parts", F.lit(0))).otherwise(without_host)
    )
    domain = F.when(k == "table", F.col("table_domain")).when(k == "brand_first", named[1]).when(k == "domain_first", named[3]).when(k == "url", F.col("url")).when(k == "cells", F.when(T.first_match(part, L.ANY_URL) != "", T.first_match(part, L.ANY_URL)).otherwise(part)).otherwise(F.col("host"))
    notes = F.when(k == "table", F.array_join(F.slice("cells", 3, F.size("cells")), " | ")).when(k == "cells", F.array_join(F.slice("parts", 3, F.size("parts")), " ")).otherwise("")
    rows = rows.withColumns({"d": domain, "b": T.clean_brand(brand)})
    return rows.select(
        "line", "kind", F.substring(F.when(F.col("b") == "", F.col("d")).otherwise(F.col("b")), 1, 300).alias("brand"), F.substring("d", 1, 500).alias("raw_domain"), U.normalize_domain(F.col("d")).alias("domain"),
        F.substring(notes, 1, 2000).alias("notes"), F.substring("t", 1, 500).alias("fragment"), *T.optional_fields(t),
    )


# The same cascade over the same text in SQL
STRIP = lambda x, more="": f"regexp_replace({x}, '^[\\s|–—\\-{more}]+|[\\s|–—\\-{more}]+$', '', 'g')"
CLEAN = lambda x: f"trim(regexp_replace({STRIP(x)}, '\\s+', ' ', 'g'))"
FIRST_HOST = lambda x: f"coalesce(list_filter(regexp_extract_all(replace(lower({x}), '@', '@@'), '@?\\b{L.HOST_TOKEN}\\b@?'), lambda h: length(h) >= 5 AND NOT contains(h, '@') AND NOT list_contains({sql_list(L.NOT_TLDS)}, list_last(string_split(h, '.'))))[1], '')"
URL_IN = lambda x: "regexp_extract(" + x + ", '" + L.ANY_URL.replace("'", "''") + "', 0, 'i')"
PART = lambda p, k: f"regexp_extract(t, '{p}', {k}, 'i')"
BULK = rf"""SELECT line, kind, substr(CASE WHEN b = '' THEN d ELSE b END, 1, 300) AS brand, substr(d, 1, 500) AS raw_domain, notes, t AS fragment, {', '.join(f"trim({PART(p, 1)}) AS {n}" for n, p in L.OPTIONAL.items())} FROM (SELECT *, {CLEAN("CASE kind WHEN 'table' THEN cells[1] WHEN 'brand_first' THEN " + PART(L.BRAND_FIRST, 1) + " WHEN 'domain_first' THEN " + PART(L.DOMAIN_FIRST, 2) + " WHEN 'url' THEN (CASE WHEN " + STRIP("split_part(t, url, 1)") + " <> '' THEN split_part(t, url, 1) ELSE substr(t, strpos(t, url) + length(url)) END) WHEN 'cells' THEN parts[1] ELSE " + STRIP("replace(t, host, '')", ",:;") + " END")} AS b,
    CASE kind WHEN 'table' THEN td WHEN 'brand_first' THEN {PART(L.BRAND_FIRST, 2)} WHEN 'domain_first' THEN {PART(L.DOMAIN_FIRST, 1)} WHEN 'url' THEN url WHEN 'cells' THEN (CASE WHEN {URL_IN('parts[2]')} <> '' THEN {URL_IN('parts[2]')} ELSE parts[2] END) ELSE host END AS d,
    CASE kind WHEN 'table' THEN array_to_string(cells[3:], ' | ') WHEN 'cells' THEN array_to_string(parts[3:], ' ') ELSE '' END AS notes FROM (SELECT *, CASE WHEN td <> '' THEN 'table' WHEN regexp_matches(t, '{L.BRAND_FIRST}', 'i') THEN 'brand_first' WHEN regexp_matches(t, '{L.DOMAIN_FIRST}', 'i') THEN 'domain_first' WHEN url <> '' THEN 'url' WHEN len(parts) >= 2 THEN 'cells' WHEN host <> '' THEN 'host' END AS kind
    FROM (SELECT *, CASE WHEN len(cells) >= 2 THEN (CASE WHEN {URL_IN('rest')} <> '' THEN {URL_IN('rest')} WHEN {FIRST_HOST('rest')} <> '' THEN {FIRST_HOST('rest')} ELSE cells[2] END) ELSE '' END AS td, {URL_IN('t')} AS url, {FIRST_HOST('t')} AS host,
    list_filter(list_transform(CASE WHEN contains(t, chr(9)) THEN string_split(t, chr(9)) WHEN contains(t, '|') AND NOT starts_with(t, '|') THEN string_split(t, '|') ELSE [] END, lambda c: trim(c)), lambda c: c <> '') AS parts FROM (SELECT *, array_to_string(cells[2:], ' | ') AS rest
    FROM (SELECT line, trim(text) AS t, CASE WHEN regexp_matches(trim(text), '^\|.*\|') THEN {CELLS} END AS cells FROM ({{bulk_lines}})) WHERE t <> '' AND NOT starts_with(t, '#') AND NOT regexp_matches(t, '{L.SKIP_LINE}', 'i') AND NOT coalesce(len(cells) >= 2 AND regexp_matches(cells[1], '^(:?-+:?)?$') OR list_contains({sql_list(L.HEADER_WORDS)}, lower(cells[1])), false))))) WHERE kind IS NOT NULL"""


@query(BULK)
def bulk_line_parse(spark, sf_dir):
    return bulk_rows(fixture(spark, sf_dir, "bulk_lines")).drop("domain")


def bulk_counts(lines: DataFrame) -> DataFrame:
    """parsed_rows; skipped_lines_no_extractable_domain: lines of two characters or more that hold no domain (blank, comment and decorative ones don't count)."""
    kinds = content_lines(lines).join(bulk_rows(lines).select("line", "kind"), "line", "left")
    return kinds.agg(F.count("kind").alias("parsed_rows"), F.count_if(F.col("kind").isNull() & (F.length("t") > 1)).alias("skipped_lines_no_extractable_domain"))


@query(f"""SELECT CAST(count(b.kind) AS BIGINT) AS parsed_rows, CAST(count(*) FILTER (b.kind IS NULL AND length(l.t) > 1) AS BIGINT) AS skipped_lines_no_extractable_domain
    FROM (SELECT line, trim(text) AS t FROM ({{bulk_lines}})) l LEFT JOIN ({BULK}) b ON b.line = l.line WHERE l.t <> '' AND NOT starts_with(l.t, '#') AND NOT regexp_matches(l.t, '{L.SKIP_LINE}', 'i')""")
def bulk_stats(spark, sf_dir):
    return bulk_counts(fixture(spark, sf_dir, "bulk_lines"))


@query(f"""SELECT CAST(count(*) FILTER (d <> '') AS BIGINT) AS kept, CAST(count(*) FILTER (d = '') AS BIGINT) AS dropped FROM (SELECT CASE WHEN regexp_matches(dd, '^[a-z0-9.\\-]+$') THEN dd ELSE '' END AS d FROM (SELECT regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(trim(raw_domain), '^.*?://', ''), '[/?#].*$', ''), '^.*@', ''), ':[0-9]+$', '')), '^\\.+|\\.+$', '', 'g'), '^www\\.', '') AS dd FROM ({BULK})))""")
def bulk_valid_domains(spark, sf_dir):
    """Rows whose domain has a normal form, and how many have none."""
    return bulk_rows(fixture(spark, sf_dir, "bulk_lines")).agg(F.count_if(F.col("domain") != "").alias("kept"), F.count_if(F.col("domain") == "").alias("dropped"))


# --- normal form ---------------------------------------------------------------------------------


def normalized(rows: DataFrame) -> DataFrame:
    """Candidates in normal form: squeezed brand, domain, other domains, confidence, stable id of their content."""
    c = T.confidence(F.col("raw_confidence"))
    other = F.filter(F.transform(F.split("other_domains", r"[,;|\n]+"), lambda x: F.trim(x)), lambda x: x != "")
    rows = rows.select("*", T.squeeze(F.col("brand")).alias("b"), U.normalize_domain(F.col("raw_domain")).alias("domain"), c.alias("c"), other.alias("aliases"))
    return rows.select("candidate_id", "k", F.col("b").alias("brand"), "domain", "aliases", F.col("c.label").alias("confidence_label"), F.col("c.value").alias("confidence"), "category", "notes", U.hashed_id("cand_", 16, F.col("b"), F.col("domain"), F.col("category")).alias("content_id"), U.brand_fold(F.col("b")).alias("fold"))


DOMAIN = "CASE WHEN regexp_matches(dd, '^[a-z0-9.\\-]+$') THEN dd ELSE '' END"
NORMAL = f"""SELECT candidate_id, k, b AS brand, d AS domain, list_filter(list_transform(regexp_split_to_array(other_domains, '[,;|\\n]+'), lambda x: trim(x)), lambda x: x <> '') AS aliases,
    CASE WHEN cr IN ('hi', 'high') THEN 'high' WHEN cr IN ('med', 'mid', 'medium') THEN 'medium' WHEN cv >= 0.7::DOUBLE THEN 'high' WHEN cv >= 0.45::DOUBLE THEN 'medium' ELSE 'low' END AS confidence_label,
    CASE WHEN cr IN ('hi', 'high') THEN 0.75::DOUBLE WHEN cr IN ('med', 'mid', 'medium') THEN 0.55::DOUBLE WHEN cv IS NOT NULL THEN round(cv, 4) ELSE 0.35::DOUBLE END AS confidence, category, notes,
    'cand_' || substr(sha256(b || '␟' || d || '␟' || category), 1, 16) AS content_id, regexp_replace(lower(b), '[^a-z0-9]+', '', 'g') AS fold
    FROM (SELECT *, {DOMAIN} AS d, greatest(0::DOUBLE, least(1::DOUBLE, CASE WHEN contains(cr, '%') OR num > 1 THEN num / 100 ELSE num END)) + CASE WHEN num IS NULL THEN NULL ELSE 0 END AS cv FROM
    (SELECT *, trim(regexp_replace(brand, '\\s+', ' ', 'g')) AS b, regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(CASE WHEN contains(trim(raw_domain), '://') THEN regexp_replace(trim(raw_domain), '^.*?://', '') ELSE trim(raw_domain) END, '[/?#].*$', ''), '^.*@', ''), ':[0-9]+$', '')), '^\\.+|\\.+$', '', 'g'), '^www\\.', '') AS dd,
    lower(trim(raw_confidence)) AS cr, CASE WHEN regexp_matches(replace(lower(trim(raw_confidence)), '%', ''), '^[0-9. ]+$') THEN try_cast(replace(raw_confidence, '%', '') AS DOUBLE) END AS num FROM ({{candidates}})))"""


@query(f"SELECT candidate_id, brand, domain, aliases, confidence_label, confidence, content_id FROM ({NORMAL})")
def candidate_normalize(spark, sf_dir):
    return normalized(fixture(spark, sf_dir, "candidates")).select("candidate_id", "brand", "domain", "aliases", "confidence_label", "confidence", "content_id")


#: Confidences in all their forms, out of order keys.
RAW = """CASE CAST(o_orderkey % 13 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'HIGH' WHEN 2 THEN ' mid ' WHEN 3 THEN concat(CAST(o_orderkey % 101 AS VARCHAR(20)), '%') WHEN 4 THEN concat('0.', lpad(CAST(o_orderkey % 10000 AS VARCHAR(20)), 4, '0')) WHEN 5 THEN CAST(o_orderkey % 400 AS VARCHAR(20))
    WHEN 6 THEN '-3' WHEN 7 THEN '1d' WHEN 8 THEN '.5' WHEN 9 THEN '1e-1' WHEN 10 THEN concat(CAST(o_orderkey % 90 AS VARCHAR(20)), '%%') WHEN 11 THEN concat(' ', CAST(o_orderkey % 7 AS VARCHAR(20)), '.25 % ') ELSE '0.69999' END"""


@query(f"""SELECT o_orderkey, CASE m WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE CASE WHEN v >= 0.7::DOUBLE THEN 'high' WHEN v >= 0.45::DOUBLE THEN 'medium' ELSE 'low' END END AS label, CASE m WHEN 1 THEN 0.75::DOUBLE WHEN 2 THEN 0.55::DOUBLE ELSE coalesce(round(v, 4), 0.35::DOUBLE) END AS value
    FROM (SELECT o_orderkey, o_orderkey % 13 AS m, CASE o_orderkey % 13 WHEN 3 THEN (o_orderkey % 101) / 100::DOUBLE WHEN 4 THEN (o_orderkey % 10000) / 10000::DOUBLE WHEN 5 THEN CASE WHEN o_orderkey % 400 > 1 THEN least(1::DOUBLE, (o_orderkey % 400) / 100::DOUBLE) ELSE (o_orderkey % 400)::DOUBLE END
        WHEN 6 THEN 0::DOUBLE WHEN 8 THEN 0.5::DOUBLE WHEN 9 THEN 0.1::DOUBLE WHEN 10 THEN (o_orderkey % 90) / 100::DOUBLE WHEN 11 THEN (o_orderkey % 7 + 0.25::DOUBLE) / 100::DOUBLE WHEN 12 THEN 0.69999::DOUBLE END AS v FROM orders)""")
def parse_confidence_cases(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", T.confidence(F.expr(RAW)).alias("c")).select("o_orderkey", "c.label", "c.value")


@query(f"SELECT candidate_id, domain, CAST(count(*) OVER (PARTITION BY domain) AS BIGINT) AS domain_repeat_count FROM ({NORMAL}) WHERE domain <> ''")
def domain_repeat_count(spark, sf_dir):
    n = normalized(fixture(spark, sf_dir, "candidates")).filter("domain <> ''")
    # an aggregate and a join rather than a window: a hot domain is counted before the shuffle, and its rows can be split
    return n.select("candidate_id", "domain").join(n.groupBy("domain").agg(F.count("*").alias("domain_repeat_count")), "domain")


# --- duplicates ----------------------------------------------------------------------------------


def grouped(rows: DataFrame) -> DataFrame:
    """rows and their group's smallest id (`canonical`). Rows of a domain are one group. Rows of a brand fold of four letters or more are one as far as one of them has no domain, since that one links to all."""
    rows = R.settled(rows, "rows")
    keys = [F.when(F.col("domain") != "", F.concat(F.lit("D:"), "domain")), F.when(F.col("open"), F.concat(F.lit("F:"), "fold"))]
    open_ = rows.filter("length(fold) >= 4 and domain = ''").select("fold").distinct().withColumn("open", F.lit(True))
    labels = R.components_by_key(rows.select("candidate_id", "domain", "fold").join(open_, "fold", "left"), "candidate_id", keys)
    return rows.join(labels, "candidate_id", "left").withColumn("canonical", F.coalesce("label", "candidate_id")).drop("label")


def deduped(rows: DataFrame) -> DataFrame:
    """duplicate_of, duplicate_group_id, merge_notes; the canonical row takes the group's largest confidence. Only that row meets the list of the others."""
    g = grouped(rows)
    first = F.col("candidate_id") == F.col("canonical")
    others = g.filter(~first).groupBy(F.col("canonical").alias("of")).agg(F.max("confidence").alias("top"), F.array_sort(F.collect_list("candidate_id")).alias("ids"))
    g = g.join(others, F.col("candidate_id") == F.col("of"), "left")
    heads = F.col("of").isNotNull()
    value = F.when(heads, F.round(F.greatest("top", "confidence"), 4)).otherwise(F.col("confidence"))
    return g.select(
        "candidate_id", "brand", "domain", "aliases", "category", "notes", "k", "fold",
        F.when(~first, F.col("canonical")).alias("duplicate_of"),
        F.when(heads | ~first, F.concat(F.lit("dg_"), F.substring(F.sha2("canonical", 256), 1, 12))).alias("duplicate_group_id"),
        F.when(heads, F.concat(F.lit("merged_ids="), F.array_join("ids", ","))).when(~first, F.concat(F.lit("duplicate_of="), "canonical")).otherwise("").alias("merge_notes"),
        value.alias("confidence"),
        F.when(heads, T.confidence_label(value)).otherwise(F.col("confidence_label")).alias("confidence_label"),
    )


GROUPED = f"""WITH RECURSIVE n AS (SELECT * FROM ({NORMAL})), k AS (SELECT candidate_id, 'D:' || domain AS x FROM n WHERE domain <> '' UNION SELECT candidate_id, 'F:' || fold FROM n WHERE length(fold) >= 4 AND fold IN (SELECT fold FROM n WHERE domain = '')),
    s AS (SELECT x, min(candidate_id) AS m FROM k GROUP BY x), e AS (SELECT candidate_id AS a, m AS b FROM k JOIN s ON s.x = k.x UNION SELECT m, candidate_id FROM k JOIN s ON s.x = k.x),
    reach(a, b) AS (SELECT candidate_id, candidate_id FROM n UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b), c AS (SELECT a AS candidate_id, min(b) AS canonical FROM reach GROUP BY a)"""


@query(f"{GROUPED} SELECT candidate_id, canonical FROM c")
def dedupe_groups(spark, sf_dir):
    return grouped(normalized(fixture(spark, sf_dir, "candidates"))).select("candidate_id", "canonical")


DEDUPED = f"""{GROUPED}, g AS (SELECT canonical, max(confidence) AS top, count(*) AS size, list_sort(list(n.candidate_id)) AS ids FROM n JOIN c ON c.candidate_id = n.candidate_id GROUP BY 1),
    dd AS (SELECT n.candidate_id, brand, domain, aliases, category, notes, k, fold, CASE WHEN n.candidate_id <> c.canonical THEN c.canonical END AS duplicate_of, CASE WHEN size > 1 THEN 'dg_' || substr(sha256(c.canonical), 1, 12) END AS duplicate_group_id,
    CASE WHEN n.candidate_id = c.canonical AND size > 1 THEN 'merged_ids=' || array_to_string(ids[2:], ',') WHEN n.candidate_id <> c.canonical THEN 'duplicate_of=' || c.canonical ELSE '' END AS merge_notes,
    CASE WHEN n.candidate_id = c.canonical AND size > 1 THEN round(top, 4) ELSE confidence END AS confidence, size,
    CASE WHEN n.candidate_id = c.canonical AND size > 1 THEN CASE WHEN top >= 0.7::DOUBLE THEN 'high' WHEN top >= 0.45::DOUBLE THEN 'medium' ELSE 'low' END ELSE confidence_label END AS confidence_label
    FROM n JOIN c ON c.candidate_id = n.candidate_id JOIN g ON g.canonical = c.canonical)"""


@query(f"{DEDUPED} SELECT candidate_id, duplicate_of, duplicate_group_id, merge_notes, confidence, confidence_label FROM dd")
def dedupe_canonical_confidence(spark, sf_dir):
    return deduped(normalized(fixture(spark, sf_dir, "candidates"))).select("candidate_id", "duplicate_of", "duplicate_group_id", "merge_notes", "confidence", "confidence_label")


@query(f"{DEDUPED} SELECT coalesce(duplicate_of, candidate_id) AS candidate_id, list_sort(list_distinct(list(notes))) AS fragments FROM dd WHERE duplicate_group_id IS NOT NULL GROUP BY 1")
def merged_source_fragments(spark, sf_dir):
    d = deduped(normalized(fixture(spark, sf_dir, "candidates"))).filter("duplicate_group_id is not null")
    return d.groupBy(F.coalesce("duplicate_of", "candidate_id").alias("candidate_id")).agg(F.array_sort(F.collect_set("notes")).alias("fragments"))


# --- buckets and queues --------------------------------------------------------------------------

BUCKETS = L.BUCKETS
NAMES = sorted({b for b, _, _ in BUCKETS} | {"operators"})


def bucketed(d: DataFrame) -> DataFrame:
    """Canonical rows with bucket and entity type hint."""
    hay = F.lower(F.concat_ws(" ", "brand", "category", "notes", "domain", F.array_join("aliases", " ")))
    d = d.filter("duplicate_of is null").withColumns({"hay": hay, "n_aliases": F.size("aliases")})
    found = None
    for bucket, hint, rule in BUCKETS:
        made = F.struct(F.lit(bucket).alias("bucket"), F.lit(hint).alias("hint"))
        condition = F.expr(rule.replace("{m}", "regexp_like").replace("starts_with", "startswith").replace("\\", "\\\\"))
        found = F.when(condition, made) if found is None else found.when(condition, made)
    found = found.otherwise(F.struct(F.lit("operators").alias("bucket"), F.lit("operator").alias("hint")))
    return d.withColumn("found", found).select("*", "found.bucket", "found.hint")


BUCKETED = f"""{DEDUPED}, bb AS (SELECT *, CASE {' '.join(f"WHEN {r.replace('{m}', 'regexp_matches')} THEN '{b}'" for b, _, r in BUCKETS)} ELSE 'operators' END AS bucket, CASE {' '.join(f"WHEN {r.replace('{m}', 'regexp_matches')} THEN '{h}'" for _, h, r in BUCKETS)} ELSE 'operator' END AS hint
    FROM (SELECT *, lower(brand || ' ' || category || ' ' || notes || ' ' || domain || ' ' || array_to_string(aliases, ' ')) AS hay, len(aliases) AS n_aliases FROM dd WHERE duplicate_of IS NULL))"""


def canonical(spark, sf_dir) -> DataFrame:
    return bucketed(deduped(normalized(fixture(spark, sf_dir, "candidates"))))


@query(f"{BUCKETED} SELECT candidate_id, bucket, hint, printf('%.4f', confidence) AS confidence FROM bb")
def bucket_classify(spark, sf_dir):
    return canonical(spark, sf_dir).select("candidate_id", "bucket", "hint", F.format_string("%.4f", "confidence").alias("confidence"))


@query(f"{BUCKETED} SELECT b.bucket, CAST(count(bb.candidate_id) AS BIGINT) AS n FROM (SELECT unnest({sql_list(NAMES + ['empty_bucket'])}) AS bucket) b LEFT JOIN bb ON bb.bucket = b.bucket GROUP BY 1")
def bucket_counts(spark, sf_dir):
    names = spark.createDataFrame([(b,) for b in NAMES + ["empty_bucket"]], "bucket string")
    n = canonical(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"))
    return names.join(n, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def prioritized(rows: DataFrame) -> DataFrame:
    """priority_score (0 to 100), why_flagged, needs_manual_verification. Columns: brand, domain, notes, category, hint, aliases, merge_notes, confidence, channel, repeat."""
    hay = F.lower(F.concat_ws(" ", "brand", "notes", "category"))
    registrable = F.col("domain").rlike(r"\.[a-zA-Z]{2,}$") & ~F.col("domain").rlike(r"\.(localhost|invalid)$")
    many = F.least(F.lit(12.0), F.col("repeat") * 4.0)
    parts = [
        (registrable, F.lit(22.0), F.lit("registrable_domain")),
        (~registrable, F.lit(-10.0), F.lit("weak_domain")),
        (F.col("domain").rlike(r"(?i)\.(com|us|net)\b"), F.lit(5.0), F.lit("tld_com_us_net")),
        (hay.rlike(L.OPERATOR_TERMS) | F.col("domain").rlike(L.OPERATOR_TERMS), F.lit(18.0), F.lit("operator_terms")),
        (F.col("repeat") > 1, many, F.concat(F.lit("repeated_domain_x"), F.col("repeat").cast("string"))),
        (F.col("hint").isin("corporate", "operator"), F.lit(8.0), F.concat(F.lit("bucket_hint_"), "hint")),
        (F.trim("brand").rlike(L.GENERIC_BRANDS) | (F.length(F.trim("brand")) < 3), F.lit(-20.0), F.lit("generic_brand")),
        (F.size("aliases") > 0, F.lit(4.0), F.lit("has_alias_candidates")),
        (F.col("channel") == "markdown", F.lit(3.0), F.lit("curated_markdown")),
    ]
    score = F.lit(15.0)
    for condition, points, _ in parts:
        score = score + F.when(condition, points).otherwise(0.0)
    manual = F.when((F.size("aliases") > 0) | F.col("merge_notes").contains("merged_ids="), "yes").when(F.coalesce("confidence", F.lit(0.0)) < 0.42, "maybe").otherwise("no")
    why = F.concat_ws(";", *(F.when(c, reason) for c, _, reason in parts))
    return rows.withColumns({"priority_score": F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), "why_flagged": why, "needs_manual_verification": manual})


OT = L.OPERATOR_TERMS.removeprefix("(?i)")
RULES = [
    ("reg", "22", "'registrable_domain'"),
    ("NOT reg", "-10", "'weak_domain'"),
    (r"regexp_matches(domain, '\.(com|us|net)\b', 'i')", "5", "'tld_com_us_net'"),
    (f"regexp_matches(hay2, '{OT}', 'i') OR regexp_matches(domain, '{OT}', 'i')", "18", "'operator_terms'"),
    ("repeat > 1", "least(12, 4 * repeat)", "'repeated_domain_x' || repeat"),
    ("hint IN ('corporate', 'operator')", "8", "'bucket_hint_' || hint"),
    (f"regexp_matches(trim(brand), '{L.GENERIC_BRANDS.removeprefix('(?i)')}', 'i') OR length(trim(brand)) < 3", "-20", "'generic_brand'"),
    ("len(aliases) > 0", "4", "'has_alias_candidates'"),
    ("channel = 'markdown'", "3", "'curated_markdown'"),
]
PRIORITY = rf"""{BUCKETED}, rr AS (SELECT domain AS dom, count(*) AS rep FROM ({NORMAL}) WHERE domain <> '' GROUP BY 1), qq AS (SELECT *, greatest(0, least(100, 15 + {' + '.join(f'(CASE WHEN {c} THEN {p} ELSE 0 END)' for c, p, _ in RULES)}))::DOUBLE AS priority_score, concat_ws(';', {', '.join(f'CASE WHEN {c} THEN {w} END' for c, _, w in RULES)}) AS why_flagged,
    CASE WHEN len(aliases) > 0 OR contains(merge_notes, 'merged_ids=') THEN 'yes' WHEN confidence < 0.42::DOUBLE THEN 'maybe' ELSE 'no' END AS needs_manual_verification
    FROM (SELECT *, coalesce(rep, 0) AS repeat, CASE WHEN k % 2 = 0 THEN 'markdown' ELSE 'bulk' END AS channel, lower(brand || ' ' || notes || ' ' || category) AS hay2, regexp_matches(domain, '\.[a-zA-Z]{{{{2,}}}}$') AND NOT regexp_matches(domain, '\.(localhost|invalid)$') AS reg FROM bb LEFT JOIN rr ON dom = domain))"""
PRIORITY = PRIORITY.replace("{{2,}}", "{2,}")


def queue(spark, sf_dir) -> DataFrame:
    n = normalized(fixture(spark, sf_dir, "candidates")).filter("domain <> ''").groupBy("domain").agg(F.count("*").alias("repeat"))
    rows = canonical(spark, sf_dir).join(n, "domain", "left").withColumns({"repeat": F.coalesce("repeat", F.lit(0)), "channel": F.when(F.col("k") % 2 == 0, "markdown").otherwise("bulk")})
    return prioritized(rows)


@query(f"{PRIORITY} SELECT candidate_id, priority_score, why_flagged, needs_manual_verification FROM qq")
def verification_priority(spark, sf_dir):
    return queue(spark, sf_dir).select("candidate_id", "priority_score", "why_flagged", "needs_manual_verification")


@query(f"{PRIORITY} SELECT candidate_id, domain, priority_score FROM (SELECT * FROM qq ORDER BY priority_score DESC, domain, candidate_id LIMIT 50) WHERE domain <> ''")
def verification_queue_topk(spark, sf_dir):
    """The report's 50 first rows; blank domains are dropped after the cut."""
    return R.top_k(queue(spark, sf_dir), 50, [F.desc("priority_score"), F.col("domain"), F.col("candidate_id")]).filter("domain <> ''").select("candidate_id", "domain", "priority_score")


# --- verification --------------------------------------------------------------------------------


def policy_links(links: Column, limit: int = 20) -> Column:
    """Links that look like policies in any case: sorted, distinct, the first 20."""
    return F.slice(F.array_sort(F.array_distinct(F.filter(links, lambda u: F.lower(u).rlike(L.VERIFY_POLICY)))), 1, limit)


def verified(log: DataFrame) -> DataFrame:
    """verification_score (0 to 1), verification_status, hits, policy links and notes of recorded fetches. An unknown dns_ok is false."""
    final, own = U.domain_from_url(F.coalesce("final_url", F.lit(""))), U.domain_from_url(F.col("url"))
    base = F.when(F.coalesce("final_url", F.lit("")) == "", F.col("url")).otherwise(F.col("final_url"))
    rows = log.withColumns({"hits": T.hits(T.html_to_text(F.col("body")), L.VERIFY), "final_host": final, "moved": (own != "") & (final != "") & (own != final), "dns_ok": F.coalesce("dns_ok", F.lit(False)), "policies": policy_links(H.page_links(F.col("body"), base))})
    fine = F.col("status").between(200, 399)
    points = lambda c, p: F.when(c, F.lit(p)).otherwise(F.lit(0.0))
    score = points(F.col("dns_ok"), 0.15) + points(fine, 0.25) + points(F.col("moved"), 0.05) + F.least(F.lit(0.35), F.size("hits") * F.lit(0.07)) + F.least(F.lit(0.2), F.size("policies") * F.lit(0.04))
    score = F.when(F.col("error").isNotNull() & (F.col("body") == ""), score * 0.5).otherwise(score)
    status = F.when(~F.col("dns_ok"), "unreachable").when(F.col("moved"), "redirected").when(fine & (F.col("body") != ""), "reachable").otherwise("unclear")
    notes = F.concat_ws("; ", F.concat(F.lit("fetch:"), F.substring("error", 1, 120)), F.when(F.col("moved"), F.concat(F.lit("redirect->"), "final_host")), F.concat(F.lit("keywords:"), F.size("hits")), F.concat(F.lit("policy_links:"), F.size("policies")))
    return rows.withColumns({"verification_score": F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4), "verification_status": status, "verification_notes": notes})


LINK = lambda h, base: f"(CASE WHEN starts_with({h}, '/') THEN regexp_extract({base}, '^([a-zA-Z]+://[^/?#]*)', 1) || replace({h}, '&amp;', '&') ELSE replace({h}, '&amp;', '&') END)"
VERIFIED = f"""SELECT *, round(greatest(0::DOUBLE, least(1::DOUBLE, CASE WHEN error IS NOT NULL AND body = '' THEN raw * 0.5::DOUBLE ELSE raw END)), 4) AS verification_score, CASE WHEN NOT dns THEN 'unreachable' WHEN moved THEN 'redirected' WHEN status BETWEEN 200 AND 399 AND body <> '' THEN 'reachable' ELSE 'unclear' END AS verification_status,
    concat_ws('; ', 'fetch:' || error, CASE WHEN moved THEN 'redirect->' || {HOST('final_url')} END, 'keywords:' || len(hits), 'policy_links:' || policies) AS verification_notes
    FROM (SELECT *, (CASE WHEN dns THEN 0.15::DOUBLE ELSE 0 END) + (CASE WHEN status BETWEEN 200 AND 399 THEN 0.25::DOUBLE ELSE 0 END) + (CASE WHEN moved THEN 0.05::DOUBLE ELSE 0 END) + least(0.35::DOUBLE, len(hits) * 0.07::DOUBLE) + least(0.2::DOUBLE, policies * 0.04::DOUBLE) AS raw
    FROM (SELECT *, coalesce(dns_ok, false) AS dns, {HITS('t', L.VERIFY)} AS hits, final_url <> '' AND {HOST('final_url')} <> {HOST('url')} AS moved, least(20, len(list_distinct(list_filter(list_transform(hrefs, lambda h: {URL('h')}), lambda u: u IS NOT NULL AND regexp_matches(lower(u), '{L.VERIFY_POLICY}'))))) AS policies
    FROM (SELECT *, list_transform(raw_hrefs, lambda r: {LINK('r', 'base')}) AS hrefs FROM (SELECT *, {TEXT('body')} AS t, CASE WHEN final_url = '' THEN url ELSE final_url END AS base, regexp_extract_all(body, '<(?:a|area)\\s[^>]*?href="([^"]*)"', 1, 'i') AS raw_hrefs FROM ({{fetch_log}})))))"""


@query(f"SELECT page_id, verification_score, verification_status, verification_notes, CAST(len(hits) AS BIGINT) AS n_hits, CAST(policies AS BIGINT) AS n_policies FROM ({VERIFIED})")
def verify_score_status(spark, sf_dir):
    return verified(fixture(spark, sf_dir, "fetch_log")).select("page_id", "verification_score", "verification_status", "verification_notes", F.size("hits").cast("long").alias("n_hits"), F.size("policies").cast("long").alias("n_policies"))


@query(f"SELECT verification_status, CAST(count(*) AS BIGINT) AS n FROM ({VERIFIED}) GROUP BY 1")
def verification_status_counts(spark, sf_dir):
    return verified(fixture(spark, sf_dir, "fetch_log")).groupBy("verification_status").agg(F.count("*").alias("n"))


@query(f"""WITH v AS (SELECT {HOST('url')} AS domain, arg_max(verification_status, page_id) AS s, arg_max(verification_score, page_id) AS x, arg_max(array_to_string(list_sort(hits), ', '), page_id) AS h FROM ({VERIFIED}) GROUP BY 1)
    SELECT p.page_id, {HOST('p.url')} AS domain, coalesce(v.s, '') AS verification_status, coalesce(CAST(v.x AS VARCHAR), '') = '' AS missing, coalesce(v.h, '') AS keyword_hits FROM ({{queue_pages}}) p LEFT JOIN v ON v.domain = {HOST('p.url')}""")
def verify_queue_merge(spark, sf_dir):
    v = verified(fixture(spark, sf_dir, "fetch_log")).select(U.domain_from_url(F.col("url")).alias("domain"), "verification_status", "verification_score", F.array_join("hits", ", ").alias("h"), "page_id")
    v = R.last_wins(v, ["domain"], ["page_id"]).drop("page_id")
    q = fixture(spark, sf_dir, "queue_pages").select("page_id", U.domain_from_url(F.col("url")).alias("domain"))
    return q.join(v, "domain", "left").select("page_id", "domain", F.coalesce("verification_status", F.lit("")).alias("verification_status"), F.col("verification_score").isNull().alias("missing"), F.coalesce("h", F.lit("")).alias("keyword_hits"))
