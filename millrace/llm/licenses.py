"""License scans: exact set-similarity join of text blocks with license templates.

Blocks are the lines of a text and its runs of at most REACH times as many words as the template has, across line breaks; a block meets a
template if it holds at least `threshold` of the template's distinct words. A run is told only if it holds more of the template than each
line found that it overlaps. Paragraphs of any length are no blocks: prose holds the few words of a short template far apart.
Tokens are ordered by their number of documents over the whole corpus, rarest first. A block is compared with a template only if it holds
one of the template's first words in that order (prefix), is long enough (length), and its first such word stands early enough for the
threshold to be still in reach (position): no pair that meets the threshold is lost. What the text as a whole doesn't meet, no block of it does.
Templates are whole short licenses and the notices of long ones (license_texts.py).

Null and empty texts have no words, labels or score; rows that repeat a doc_id each give a row; of equal counts the words' own order counts. Extra
columns are not read. Time follows a text's length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, table, texts
from .license_texts import TEMPLATES

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
THRESHOLD, REACH = 0.8, 2
#: A-Z to lower case; what is no word character becomes a space, line breaks stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in b"\n" or 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def needed(n: int, threshold: float) -> int:
    """Fewest common words for the threshold; exact for thresholds of up to six decimals."""
    return -(-n * round(threshold * 1_000_000) // 1_000_000)


class Index:
    """Templates by the words of their prefixes in the global order."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[str, int], threshold: float) -> None:
        self.rank = {w: i for i, (_, w) in enumerate(sorted((counts.get(w.decode(), 0), w) for w in {w for _, t in templates for w in words_of(t.encode())}))}
        self.sets = [(label, sorted(set(words_of(t.encode())), key=self.rank.__getitem__)) for label, t in templates]
        self.reach = [REACH * len(words_of(t.encode())) for _, t in templates]
        self.need = [needed(len(ws), threshold) for _, ws in self.sets]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for k, (_, ws) in enumerate(self.sets):
            for i, w in enumerate(ws[: len(ws) - self.need[k] + 1]):
                self.prefix.setdefault(w, []).append((k, i))

    def of_block(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of all that meet the threshold."""
        own = set(words)
        best: dict[int, int] = {}
        for w in own & self.prefix.keys():
            for k, i in self.prefix[w]:
                if len(own) >= self.need[k]:
                    best[k] = min(i, best.get(k, i))
        out = []
        for k, i in best.items():
            ws = self.sets[k][1]
            if len(ws) - i >= self.need[k] and (n := sum(w in own for w in ws[i:])) >= self.need[k]:
                out.append((k, n / len(ws)))
        return out


def template_counts(df: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Number of documents that hold each template word, over the whole corpus. At most as many rows as the templates have words."""
    vocab = frozenset(w for _, t in templates for w in words_of(t.encode()))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, docs in slices(batches):
            for data in docs:
                total.update(vocab.intersection(words_of(data)))
        yield table(schema, word=[w.decode() for w in total], n=list(total.values()))

    rows = texts(df, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"]: r["n"] for r in rows}


def runs(words: list[bytes], template: set[bytes], reach: int, need: int) -> Iterator[tuple[int, int, int]]:
    """(first word, end, distinct template words) of runs of at most `reach` words that hold `need`: of those that overlap, the first with most."""
    at = [(i, w) for i, w in enumerate(words) if w in template]
    held: Counter = Counter()
    left, best = 0, None
    for p, w in at:
        held[w] += 1
        while p - at[left][0] >= reach or held[at[left][1]] > 1:
            held[at[left][1]] -= 1
            if not held[at[left][1]]:
                del held[at[left][1]]
            left += 1
        if best and at[left][0] >= best[1]:
            yield best
            best = None
        if len(held) >= need and (best is None or len(held) > best[2]):
            best = (at[left][0], p + 1, len(held))
    if best:
        yield best


def text_blocks(folded: bytes, words: list[bytes], near: list[tuple[int, float]], index: Index) -> list[tuple[int, int, str, float]]:
    """Blocks of a text that as a whole meets the templates `near`."""
    out: dict[int, list[tuple[int, int, float]]] = {k: [] for k, _ in near}
    first = 0
    for part in folded.split(b"\n"):
        own = part.split()
        for k, c in index.of_block(own):
            out[k].append((first, first + len(own), c))
        first += len(own)
    for k, lines in out.items():
        own = index.sets[k][1]
        found = [(a, e, n / len(own)) for a, e, n in runs(words, set(own), index.reach[k], index.need[k])]
        lines += [(a, e, c) for a, e, c in found if not any(x < e and a < y and c <= old for x, y, old in lines)]
    return sorted((a, e - a, index.sets[k][0], c) for k, found in out.items() for a, e, c in found)


def scan(data: bytes, index: Index) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, float]]]:
    """Number of words; (first word, label) of each place of a phrase; (first word, number of words, label, containment) of each block found."""
    folded = data.translate(FOLD)
    words = folded.split()
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in PHRASES.items():
        key, at, word, done = b" " + phrase.encode() + b" ", 0, 0, 0
        while (at := line.find(key, at)) >= 0:
            word, done = word + line.count(b" ", done, at), at
            places.append((word, label))
            at += 1
    near = index.of_block(words)
    return len(words), sorted(places), text_blocks(folded, words, near, index) if near else []


def license_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, places array<struct<word, label>>, blocks array<struct<word, n_words, label, containment>>: one row per input row, no shuffle of texts."""
    index = Index(templates, template_counts(df, templates, id_col, text_col), threshold)
    place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", place), ("blocks", block)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, docs in slices(batches):
            got = [scan(d, index) for d in docs]
            yield table(
                schema,
                doc_id=ids,
                n_words=[g[0] for g in got],
                places=[[{"word": w, "label": x} for w, x in g[1]] for g in got],
                blocks=[[dict(zip(("word", "n_words", "label", "containment"), b)) for b in g[2]] for g in got],
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, places array<struct<word:long,label:string>>, blocks array<struct<word:long,n_words:long,label:string,containment:double>>")


def op6_license_scan(spark, sf_dir) -> DataFrame:
    """Contract query. score: 1 where a phrase stands, else the largest containment of a block, 0 without any."""
    joined = lambda *xs: F.array_join(F.array_sort(F.array_distinct(F.concat(*xs))), ",")
    base, more = F.col("places.label"), F.col("blocks.label")
    n = F.size("places")
    return license_blocks(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        n.cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base, more).alias("labels"),
        F.when(n > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"),
    )
