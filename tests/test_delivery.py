"""Fetch attempts against loops, lines of split files, tables in total orders over many parts, versions under broken and rival writers."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.sinks import files as W
from millrace.sinks.ordered import MANIFEST, read_ordered, write_ordered
from millrace.sinks.versions import Conflict, Versions
from millrace.sources import attempts as A
from millrace.sources import caches, files

ATTEMPT = "url string, attempt int, status int, final_url string, content_type string, body binary, error string"


def fold(url, tries, retries):
    """One URL's attempts, one after another, as a fetcher would go."""
    waited = 0.0
    held = {a[1]: a for a in tries}
    error, n = "unknown", 0
    for k in range(retries + 1):
        if k not in held:
            break
        n += 1
        _, _, status, final, kind, body, e = held[k]
        if status is not None:
            return (url, status, final or url, kind, (body or b"")[: A.BODY_BYTES], e, n, round(waited, 3))
        error = e or ""
        if k < retries:
            waited += 0.4 * (k + 1)
    return (url, None, url, None, b"", error, n, round(waited, 3))


@pytest.mark.parametrize("retries", [0, 1, 2, 4])
def test_attempts_against_loops(spark, retries):
    rng, log = random.Random(retries), {}
    for u in range(120):
        url = f"https://u{u}.com/"
        log[url] = [(url, k, *rng.choice([(None, None, None, None, f"timeout {k}"), (None, None, None, None, f"reset {k}"), (200, rng.choice([url, None, "", "https://moved/"]), "text/html", b"page", None), (404, url, "text/html", b"gone", "HTTP Error 404"), (503, None, None, None, "HTTP Error 503")])) for k in range(rng.randint(1, 6))]
    rows = [a for tries in log.values() for a in tries]
    rng.shuffle(rows)
    got = {r["url"]: (r["url"], r["status"], r["final_url"], r["content_type"], bytes(r["body"]), r["error"], r["tries"], r["waited"]) for r in A.folded(spark.createDataFrame(rows, ATTEMPT).repartition(5), retries).collect()}
    assert got == {url: fold(url, tries, retries) for url, tries in log.items()}


def test_cache_first_body_limit_and_unknown_urls(spark):
    long = b"\xc3\xa9" * 1_000_001
    log = spark.createDataFrame([("a", 0, 200, "a", "t", b"new", None), ("b", 0, 200, "", "t", long, None), ("c", 0, None, None, None, None, "refused")], ATTEMPT)
    held = caches.cached_pages(spark.createDataFrame([("a", 200, "text/html", "a/held", "old")], "url string, status int, content_type string, final_url string, body string"))
    got = {r["url"]: r for r in A.fetched(spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "url string"), log, held).collect()}
    assert len(got) == 4 and (got["a"]["source"], bytes(got["a"]["body"]), got["a"]["to_cache"], got["a"]["tries"]) == ("cache", b"old", False, 0)
    assert len(got["b"]["body"]) == A.BODY_BYTES and got["b"]["to_cache"] and got["b"]["final_url"] == "b"
    assert (got["c"]["status"], got["c"]["error"], got["c"]["to_cache"]) == (None, "refused", False) and (got["d"]["error"], got["d"]["tries"], bytes(got["d"]["body"])) == ("unknown", 0, b"")


def test_lines_whatever_the_split(spark, tmp_path):
    rng = random.Random(3)
    texts = {"a.txt": [f"{k} " + "x" * rng.randint(0, 90) for k in range(3000)], "b.txt": ["only"], "c.txt": [], "d.txt": ["", "", "é" * 5000, ""]}
    for name, lines in texts.items():
        with open(f"{tmp_path}/{name}", "w", newline="") as out:
            out.write("".join(line + ("\r\n" if name == "d.txt" else "\n") for line in lines))
    want = {(name, i, line) for name, lines in texts.items() for i, line in enumerate(lines)}
    for size in (None, 100_000, 7_001, 1_000):
        got = files.numbered_lines(spark, f"{tmp_path}/*.txt", size)
        assert {(os.path.basename(r["file"]), r["pos"], r["text"]) for r in got.collect()} == want and got.count() == len(want)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"
    assert files.numbered_lines(spark, f"{tmp_path}/none/*.txt").count() == 0


def test_lines_of_parts(spark, tmp_path):
    rows = spark.range(5000).select("id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"))
    rows.repartitionByRange(9, "id").sortWithinPartitions("id").select("value").write.text(f"{tmp_path}/dump")
    got = files.numbered_lines(spark, f"{tmp_path}/dump", 4_000).collect()
    assert sorted((r["pos"], r["text"]) for r in got) == [(k, f"line {k}") for k in range(5000)] and len({r["file"] for r in got}) == 1


@pytest.mark.parametrize("order", [["a"], ["-a", "b"], ["b is null", "b", "a"]])
def test_ordered_parts(spark, tmp_path, order):
    rng = random.Random(7)
    rows = [(k, rng.choice([None, "x", "y", "zz"]), rng.random()) for k in range(4000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "a long, b string, c double").repartition(6)
    assert write_ordered(df, f"{tmp_path}/t", [F.expr(o) for o in order], 11) == 4000
    assert len([f for f in os.listdir(f"{tmp_path}/t") if f.endswith(".parquet")]) > 3 and os.path.exists(f"{tmp_path}/t{MANIFEST}")
    key = {"a": lambda r: r[0], "-a": lambda r: -r[0], "b": lambda r: (r[1] is not None, r[1] or ""), "b is null": lambda r: r[1] is None}
    want = sorted(rows, key=lambda r: [key[o](r) for o in order] + [r[0]])
    assert [tuple(r)[:3] for r in sorted(read_ordered(spark, f"{tmp_path}/t").collect(), key=lambda r: r["at"])] == want
    assert sorted(r["at"] for r in read_ordered(spark, f"{tmp_path}/t").collect()) == list(range(4000))


def test_ordered_empty(spark, tmp_path):
    assert write_ordered(spark.range(0), f"{tmp_path}/t", ["id"]) == 0
    assert read_ordered(spark, f"{tmp_path}/t").count() == 0


@pytest.fixture
def many_parts(spark):
    """Small parts stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_json_parts_are_one_array(spark, tmp_path, many_parts):
    rows = [{"k": k, "name": f"é {k}", "tags": [str(k), None], "of": {"b": k / 4, "a": None}} for k in range(700)]
    df = spark.createDataFrame([(r["k"], r["name"], r["tags"], (r["of"]["b"], None)) for r in rows], "k long, name string, tags array<string>, of struct<b:double,a:string>").repartition(5)
    W.write_json(df, f"{tmp_path}/t.json", [F.desc("k")])
    parts = sorted(f for f in os.listdir(f"{tmp_path}/t.json") if f.startswith("part-"))
    text = "".join(open(f"{tmp_path}/t.json/{p}").read() for p in parts)
    assert len(parts) > 1 and text == W.json_text(rows[::-1]) and json.loads(text) == rows[::-1]
    back = files.read_json_array(spark, f"{tmp_path}/t.json", df.schema, strict=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    W.write_json(df.limit(0), f"{tmp_path}/none.json", ["k"])
    assert files.read_json_array(spark, f"{tmp_path}/none.json", df.schema, strict=True).count() == 0


def test_csv_parts_in_order(spark, tmp_path, many_parts):
    df = spark.createDataFrame([(f"{k:04}", 'quo"ted,\nline', None) for k in range(900)], "k string, v string, n string").repartition(7)
    W.write_csv(df, f"{tmp_path}/t.csv", ["k"])
    assert len([f for f in os.listdir(f"{tmp_path}/t.csv") if f.endswith(".csv")]) > 1
    assert [r["k"] for r in files.read_csv(spark, f"{tmp_path}/t.csv", limit=450).collect()] == [f"{k:04}" for k in range(450)]
    assert {tuple(r) for r in files.read_csv(spark, f"{tmp_path}/t.csv").collect()} == {(f"{k:04}", 'quo"ted,\nline', "") for k in range(900)}


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "k long, seq long, v string")


def held_in(versions):
    return sorted(tuple(r) for r in versions.read().select("k", "seq", "v").collect())


def test_versions(spark, tmp_path):
    held = Versions(spark, f"file://{tmp_path}/t")
    assert held.read() is None and held.latest() is None
    held.upsert(rows_of(spark, (1, 1, "a"), (2, 1, "b"), (2, 2, "c")), ["k"], ["seq"], "one")
    assert held_in(held) == [(1, 1, "a"), (2, 2, "c")]
    held.write(rows_of(spark, (9, 9, "broken off")))  # no commit
    assert held_in(held) == [(1, 1, "a"), (2, 2, "c")]
    held.upsert(rows_of(spark, (2, 1, "older"), (3, 1, "d"), (1, 1, "new of equal order")), ["k"], ["seq"], "two")
    want = [(1, 1, "new of equal order"), (2, 2, "c"), (3, 1, "d")]
    assert held_in(held) == want
    again = held.upsert(rows_of(spark, (4, 1, "never")), ["k"], ["seq"], "two")  # a run that was begun anew
    assert held_in(held) == want and again["number"] == 1 and [c["run"] for c in held.commits()] == ["one", "two"]
    assert held.latest()["rows"] == 3


def test_two_writers(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    first, rival, seen = Versions(spark, root), Versions(spark, root), []

    def between():
        if not seen:
            seen.append(1)
            rival.upsert(rows_of(spark, (1, 5, "rival"), (7, 1, "rival's own")), ["k"], ["seq"], "rival")

    done = first.upsert(rows_of(spark, (1, 4, "mine"), (2, 1, "mine")), ["k"], ["seq"], "mine", between)
    assert held_in(first) == [(1, 5, "rival"), (2, 1, "mine"), (7, 1, "rival's own")] and done["number"] == 1
    folder = first.write(rows_of(spark, (0, 0, "late")))
    with pytest.raises(Conflict):
        first.commit(folder, 0)
    assert len(first.commits()) == 2 and not [f for f in os.listdir(f"{tmp_path}/t/log") if f.startswith("_")]
