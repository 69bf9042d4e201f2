"""Questions to name servers and what is passed on of results."""

import json

from pyspark.sql import functions as F

from millrace.plans.providers import minimal
from millrace.sources.network import answers_of, name_at, question_of


def test_questions():
    message, error = question_of("Bücher.Example.", "MX", 0xABCD)
    assert error is None and message[:12] == bytes.fromhex("abcd01000001000000000000") and name_at(message, 12)[0] == "xn--bcher-kva.example" and message[-4:] == bytes.fromhex("000f0001")
    assert question_of("", "NS", 1)[0][12:] == bytes.fromhex("0000020001") and question_of(None, "NS", 1)[0] == question_of("...", "NS", 1)[0]
    for bad in ("a..b", "a" * 64 + ".com", "é" * 60):
        assert question_of(bad, "NS", 1) == (None, "a label is empty or too long")
    assert answers_of(message, "MX") == ([], None)  # a question has no answers, and is well formed


def test_minimal_results(spark):
    long = [str(k) for k in range(25)]
    rows = spark.createDataFrame([("a", 1, long, 0.5, "unresolved", ["x.com"], "n" * 900), ("b", 2, [], None, "likely_noise", [], "é\n\"q\"")], "candidate_id string, tier int, citations array<string>, confidence_hint double, entity_type_guess string, extracted_domains array<string>, notes string")
    got = {r["candidate_id"]: json.loads(r["minimal"]) for r in minimal(rows.withColumn("more", F.lit(1))).collect()}
    assert got["a"] == {"citations": long[:10], "confidence_hint": 0.5, "entity_type_guess": "unresolved", "extracted_domains": ["x.com"], "notes": "n" * 500}
    assert got["b"] == {"citations": [], "entity_type_guess": "likely_noise", "extracted_domains": [], "notes": "é\n\"q\""}
