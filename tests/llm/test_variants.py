"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import variants
from millrace.llm.common import read
from millrace.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_counts(docs):
    n = Counter()
    for k, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(docs, one=lambda a, b: distance(a, b) == 1):
    n = brute_counts(docs)
    out = {}
    for w in n:
        near = [v for v in n if abs(len(v) - len(w)) <= 1 and one(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = [best if best and n[best] >= 2 * n[w] else None, len(near)]
    rows = {}
    for w, (form, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n[w], near, form and n[form])
    return rows


def got(df):
    rows = [r.asDict() for r in df.collect()]
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in rows}


def frame(spark, docs):
    return spark.createDataFrame([(k, t, "w", 3, "x") for k, t in docs], "doc_id long, text string, word string, n int, form string")


@pytest.fixture(scope="module")
def edited():
    """Few letters, so that many words are near one another, share halves and tie; some far beyond ASCII."""
    rng, docs = random.Random(11), []
    base = ["".join(rng.choice("abé×ÿÀ") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["über" * 3, "a" * 40]
    for k in range(300):
        words = []
        for _ in range(30):
            w = rng.choice(base[: 1 + rng.randrange(len(base))])
            if rng.random() < 0.4:
                i = rng.randrange(len(w))
                w = rng.choice((w[:i] + w[i + 1 :], w[:i] + rng.choice("abéZ") + w[i:], w[:i] + rng.choice("abé") + w[i + 1 :]))
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((k, rng.choice((" ", ", ", "1", "漢", "ā")).join(words)))
    docs += [(400 + k, " ".join("chainedxyzuv"[: 7 + k] for _ in range(3 << k))) for k in range(6)]
    return docs + [(300, None), (301, ""), (302, " \n"), (5, docs[5][1]), (5, docs[5][1]), (None, docs[7][1])]


def test_one_edit():
    rng = random.Random(2)
    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert variants.one_edit(a, b) == (distance(a, b) == 1)


@pytest.mark.parametrize("few, shard", [(12, 100_000), (0, 5)])
def test_against_all_pairs(spark, edited, monkeypatch, few, shard):
    monkeypatch.setattr(variants, "FEW", few)
    words = variants.word_counts(frame(spark, edited).select("doc_id", "text"))
    near = {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in variants.near_words(words, 7, shard).collect()}
    want, n = brute(edited), brute_counts(edited)
    assert {w: k for w, (k, _, _) in near.items()} == {w: r[3] for w, r in want.items() if r[3]}
    for w, (_, m, best) in near.items():
        assert best == min((v for v in n if distance(w, v) == 1), key=lambda v: (-n[v], v)) and m == n[best]


def test_forms_and_roots(spark, edited):
    found, want = got(variants.spelling_variants(frame(spark, edited))), brute(edited)
    assert found == want and len(want) > 100
    depth = defaultdict(int)
    for w in want:
        x = w
        while want[x][0]:
            x, depth[w] = want[x][0], depth[w] + 1
    assert max(depth.values()) >= 5


def test_query(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, data, "documents").collect()]
    # one edit, told without distances: equal but for one place, or one longer by one place
    one = lambda a, b: a != b and any(a[:i] == b[:i] and (a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]) for i in range(max(len(a), len(b))))
    n = brute_counts(docs)
    by_piece = defaultdict(set)
    for w in n:  # words one edit apart agree when one code point is left out of the longer, or of both
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_piece[x].add(w)
    want = {w: set() for w in n}
    for group in by_piece.values():
        for a in group:
            want[a] |= {b for b in group if one(a, b)}
    found = got(QUERIES["op11_spelling_variants"](spark, data))
    assert {w: r[2] for w, r in found.items()} == n
    assert {w: r[3] for w, r in found.items()} == {w: len(x) for w, x in want.items()}
    for w, (form, root, _, _, form_n) in found.items():
        best = min(want[w], key=lambda v: (-n[v], v), default=None)
        best = best if best and n[best] >= 2 * n[w] else None
        assert form == best and form_n == (best and n[best])
        assert root == (found[form][1] if form else w)


def test_a_hot_half_and_a_long_text(spark):
    """Thousands of words share a half; one text is above 2 MiB, in one run of letters and in many."""
    rng = random.Random(5)
    words = sorted({"shared" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)})
    docs = [(1, " ".join(words * 3)), (2, "x" * 3_000_000 + " " + "longer word " * 200_000), (3, "Longer")]
    rows = got(variants.spelling_variants(frame(spark, docs)))
    n = brute_counts(docs)
    assert {w: r[2] for w, r in rows.items()} == n and n["longer"] >= 200_000
    by_piece = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by_piece[i, w[:i] + w[i + 1 :]].add(w)
    for w in rng.sample(words, 300):
        if w in n:
            same = set().union(*(by_piece[i, w[:i] + w[i + 1 :]] for i in range(len(w)))) - {w}
            assert rows[w][3] >= len(same)


def test_empty(spark, data, tmp_path):
    read(spark, data, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_spelling_variants"](spark, str(tmp_path)).count() == 0
    assert got(variants.spelling_variants(frame(spark, [(1, None), (2, "a b"), (None, "")]))) == {}
