"""The contract queries, and SQL for those that SQL expresses."""

from __future__ import annotations

from .audio import op2_audio_features
from .bpe import op9_bpe_round_trip
from .decontaminate import op1_benchmark_decontamination
from .language import op3_language_id
from .licenses import op6_license_scan
from .ngram_join import op7_ngram_jaccard
from .ranking import op12_quality_ranking
from .repeats import op4_suffix_dedup
from .secrets import op10_secret_scan
from .token_files import op5_token_files
from .variants import op11_spelling_variants
from .vector_codes import op13_vector_codes
from .warc import op8_warc_revisits

QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_audio_features,
        op3_language_id,
        op4_suffix_dedup,
        op5_token_files,
        op6_license_scan,
        op7_ngram_jaccard,
        op8_warc_revisits,
        op9_bpe_round_trip,
        op10_secret_scan,
        op11_spelling_variants,
        op12_quality_ranking,
        op13_vector_codes,
    )
}


def _vector_codes_sql(rounds: int = 4) -> str:
    """Every distance to every entry, as exact sums of products of whole numbers."""
    near = """assign{k} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min(struct_pack(d := CAST(list_inner_product(p.y, p.y) - 2 * list_inner_product(p.y, b.y) + list_inner_product(b.y, b.y) AS BIGINT), e := b.entry)) AS a
  FROM p JOIN book{k} b ON b.part = p.part GROUP BY ALL)"""
    mean = """sums{k} AS (
  SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS c
  FROM (SELECT p.part, a.a.e AS entry, unnest(range(len(p.y))) AS pos, unnest(p.y)::BIGINT AS v FROM assign{k} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part) GROUP BY ALL
), book{next} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.y, b.y) AS y FROM book{k} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % c) + c) % c) // c AS DOUBLE) ORDER BY pos) AS y FROM sums{k} GROUP BY ALL) m ON m.part = b.part AND m.entry = b.entry)"""
    steps = [near.format(k=0)]
    for k in range(rounds):
        steps += [mean.format(k=k, next=k + 1), near.format(k=k + 1)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS y FROM v, (SELECT unnest(range(4)) AS part)
), book0 AS MATERIALIZED (
  SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, y FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256)
), {", ".join(steps)}, final AS (
  SELECT vec_id, string_agg(lpad(to_hex(a.e), 2, '0'), '' ORDER BY part) AS code, sum(a.d)::BIGINT AS error FROM assign{rounds} GROUP BY vec_id
)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(CAST(CAST(t.x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM (SELECT part, entry, unnest(range(len(y))) AS pos, unnest(y) AS x FROM book{rounds}) t) AS codebooks_sha256
FROM final JOIN v USING (vec_id)
"""


ORACLE = {
    "op7_ngram_jaccard": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS gs FROM w
), s AS (
  SELECT doc_id, unnest(gs) AS x FROM g
), n AS (
  SELECT doc_id, len(gs) AS n FROM g
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, m.component_id
FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = n.doc_id
""",
    "op8_warc_revisits": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h || '0', CAST(5 * i // 4 AS INT) + 1, 2) AS INT) >> CAST(3 - 5 * i % 4 AS INT)) & 31), 1)), '') AS payload_digest FROM p
), r AS (
  SELECT payload_digest, max(page_id) AS first FROM d GROUP BY 1
)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN r ON d.payload_digest = r.payload_digest
""",
    "op13_vector_codes": _vector_codes_sql(),
}
