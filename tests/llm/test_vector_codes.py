"""Vector codes against plain loops and SQL."""

import duckdb
import numpy as np
import pytest

from millrace.llm import vector_codes as V
from millrace.llm.common import read
from millrace.llm.queries import ORACLE, QUERIES


def brute(vectors, rounds=4):
    """{key: (code, error)} and codebooks; vectors: lists of whole numbers in order."""
    d = len(vectors[0]) // 4
    parts = [[v[p * d : (p + 1) * d] for v in vectors] for p in range(4)]
    books = [[list(v) for v in x[:256]] for x in parts]

    def nearest(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            own = [[] for _ in books[p]]
            for v in parts[p]:
                own[nearest(books[p], v)[1]].append(v)
            books[p] = [[sum(c) // len(x) for c in zip(*x)] if x else e for x, e in zip(own, books[p])]
    got = [[nearest(books[p], parts[p][i]) for p in range(4)] for i in range(len(vectors))]
    return [([k for _, k in g], sum(e for e, _ in g)) for g in got], books


def frame(spark, rows):
    return spark.createDataFrame([(k, v, lab, "x", 1) for k, v, lab in rows], "vec_id long, embedding array<float>, label int, code string, error int")


def test_against_loops(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.normal(size=(700, 8)), 1).astype(np.float32)  # many ties
    v[300:420] = v[3]
    rows = [(k, v[k].tolist(), int(k % 3) if k % 7 else None) for k in range(700)]
    out, books = V.compress(frame(spark, rows))
    got = {r["vec_id"]: (list(r["code"]), r["error"]) for r in V.with_label_errors(out).collect()}
    want, entries = brute([[int(np.floor(1024 * float(x))) for x in row] for row in v.tolist()])
    assert [b.tolist() for b in books] == entries
    assert got == dict(enumerate(want))
    sums = {}
    for (k, _, lab), (_, e) in zip(rows, want):
        sums[lab] = sums.get(lab, 0) + e
    assert {r["vec_id"]: r["label_error"] for r in V.with_label_errors(out).collect()} == {k: sums[lab] for k, _, lab in rows}


@pytest.mark.parametrize("bits", [0, 1, 3, 5])
@pytest.mark.parametrize("scale", [3, 1000, V.LIMIT])
def test_cells_lose_no_nearest_entry(bits, scale):
    rng = np.random.default_rng(bits)
    for n, d in ((1, 4), (7, 1), (256, 6), (30, 0)):
        book, x = (rng.integers(-scale, scale + 1, (k, d)) for k in (n, 300))
        index, error = V.Cells(book, bits).nearest(x)
        every = np.square(x[:, None] - book).sum(axis=2)
        assert (error == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()


def test_cells_leave_most_entries_out():
    rng = np.random.default_rng(1)
    book = rng.normal(0, 100, (256, 4)).astype(np.int64)
    assert V.Cells(book).candidates(rng.normal(0, 100, (500, 4)).astype(np.int64)).mean() < 0.25


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(9, [1.0] * 8, 1), (1, None, 1), (2, [1.0, None] * 4, 1), (3, [nan] * 8, 1), (4, [inf] * 8, None), (5, [-inf] + [0.0] * 7, 2), (6, [], 1), (7, [1.0] * 5, 1)]
    rows += [(8, [3e38] * 8, None), (8, [3e38] * 8, None), (9, [1.0] * 8, 1), (None, [-0.0001] * 8, 5), (10, [-0.0001] * 8, None)]
    out, books = V.compress(frame(spark, rows))
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, list(r["code"]), r["error"]) for r in V.with_label_errors(out).collect())
    # entries in order of vec_id (null last): 8, 8, 9, 9, 10, null; of equal ones the lower index
    assert got == [(False, 8, [0] * 4, 0)] * 2 + [(False, 9, [2] * 4, 0)] * 2 + [(False, 10, [4] * 4, 0), (True, 0, [4] * 4, 0)]
    assert books[0][0].tolist() == [V.LIMIT] * 2 and books[0][4].tolist() == [-1, -1]


def test_length_that_four_does_not_divide(spark):
    out, books = V.compress(frame(spark, [(k, [float(k)] * 6, 0) for k in range(5)]))
    assert [b.shape for b in books] == [(5, 2)] * 4 and not books[3].any()
    assert {r["vec_id"]: list(r["code"]) for r in out.collect()} == {k: [k, k, k, 0] for k in range(5)}


def test_empty_and_one(spark, data, tmp_path):
    read(spark, data, "embeddings").limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op13_vector_codes"](spark, str(tmp_path)).count() == 0
    out, _ = V.compress(frame(spark, [(1, [0.5] * 4, None)]))
    assert [(list(r["code"]), r["error"]) for r in out.collect()] == [([0] * 4, 0)]
    out, _ = V.compress(frame(spark, [(1, [], None)]))
    assert out.count() == 1


def test_query_against_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    df = QUERIES["op13_vector_codes"](spark, data)
    rel = con.sql(ORACLE["op13_vector_codes"]).select(", ".join(df.columns))
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())
