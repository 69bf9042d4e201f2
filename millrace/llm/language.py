"""Language ID by word-first backoff.

A word (run of letters, Unicode's categories L, in lower case) that stands in the training texts scores by its log frequency in each language; an unseen word falls back to
the mean log frequency of its known character n-grams of the greatest length that has any, from GRAMS[0] letters down to one (`<` and `>` mark the
word's ends); a word without known n-grams says nothing. Frequencies are smoothed by half a count:

    word:   log((n + 1/2) / (N + V/2))          N words of the language, V distinct words of all
    n-gram: log((n + 1/2) / (S + Z/2))          S n-grams of that length in the language, Z distinct ones of all

Words are counted over all training rows, n-grams over all those words; the tables of both stay whole, as Parquet in the shared folder, and grow
with the corpus. Only a cache is sent to the workers: the counts of the most frequent words, at most HOT_WORDS of them, and HOT_BYTES of counts (`hot_words`). What a text holds beside these is joined to the tables, each distinct word once, so the cache changes no result.

A text's language is that of the greatest sum, score its posterior under equal priors (rounded to 9 decimals); of equal sums the first language in
code-point order. Texts that are null or hold no letter are `und` with score 0, and so is every text if there are no training rows. Rows that
repeat a doc_id, or have none, are predicted each by itself. Extra columns are not read. More than MAX_LANGS languages are an error.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, settle, slices, small_batches, table, texts

#: Runs of letters, and of numbers that are no decimal digits (fractions, superscripts, circled and Roman numerals): these are cut out of the words afterwards.
LETTERS = re.compile(r"[^\W\d_]+")
GRAMS = (5, 4, 3, 2, 1)
#: Words whose counts are sent to the workers, at most, and bytes of these counts.
HOT_WORDS, HOT_BYTES = 100_000, 64 << 20
#: Counts that a task holds before it gives them on.
HELD = 500_000
MAX_LANGS = 10_000
#: Letters of a text that are cut into words at once, about.
PIECE = 1 << 20
UNKNOWN = "und"


def word_counter(text: str) -> Counter:
    text, out, at = text.lower(), Counter(), 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if m := LETTERS.match(text, end):
            end = m.end()
        out.update(LETTERS.findall(text, at, end))
        at = end
    for word in [w for w in out if not w.isalpha()]:
        n = out.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split(" "):
            if part:
                out[part] += n
    return out


def word_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, word, n over all rows with text and lang. Counted in each task first."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in total.items():
                rest = iter(c.items())
                while part := list(islice(rest, 20_000)):
                    yield table(schema, lang=[lang] * len(part), word=[w for w, _ in part], n=[n for _, n in part])
            total.clear()

        for langs, docs in slices(batches, keep=""):
            for lang, data in zip(langs, docs):
                total[lang].update(word_counter(data.decode()))
            if sum(map(len, total.values())) > HELD:
                yield from flush()
        yield from flush()

    small_batches(df.sparkSession)
    rows = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def grams_of(word: str, size: int) -> Counter:
    marked = f"<{word}>"
    return Counter(marked[i : i + size] for i in range(len(marked) - size + 1))


def gram_counts(words: DataFrame) -> DataFrame:
    """gram, l, n over all words (word, c: array of struct<l, n>)."""
    schema = pa.schema([("gram", pa.string()), ("l", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in total.items():
                rest = iter(c.items())
                while part := list(islice(rest, 20_000)):
                    yield table(schema, gram=[g for g, _ in part], l=[lang] * len(part), n=[n for _, n in part])
            total.clear()

        for batch in (b.slice(at, 2_000) for b in batches for at in range(0, b.num_rows, 2_000)):
            for word, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marked = f"<{word}>"
                for c in counts:
                    own, n = total[c["l"]], c["n"]
                    for size in GRAMS:
                        for i in range(len(marked) - size + 1):
                            own[marked[i : i + size]] += n
            if sum(map(len, total.values())) > HELD:
                yield from flush()
        yield from flush()

    return words.select("word", "c").mapInArrow(run, "gram string, l int, n long").groupBy("gram", "l").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """langs in code-point order; words, grams: every known word and n-gram with its counts (c: struct<l, n> of each language that has it); base:
    what an unseen word (0) or n-gram (its length) scores in each language; hot: words of the cache and log(2 n + 1) of theirs by language."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    base: dict[int, np.ndarray]
    hot: tuple[str, np.ndarray]


def hot_words(words: DataFrame, most: int, langs: int) -> tuple[str, np.ndarray]:
    """The words with at least 2**k places, for the least k that leaves `most` of them at most. (Found by a histogram of the logarithms; no sort.)"""
    sizes = {r["k"]: r["n"] for r in words.groupBy(F.floor(F.log2("total")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    k, left = max(sizes, default=0) + 1, most
    while k - 1 in range(64) and sizes.get(k - 1, 0) <= left:
        left -= sizes.get(k - 1, 0)
        k -= 1
    rows = words.filter(F.col("total") >= 2**k).select("word", "c").collect()
    scores = np.zeros((len(rows), langs))
    for i, r in enumerate(rows):
        for c in r["c"]:
            scores[i, c["l"]] = np.log(2 * c["n"] + 1)
    return "\n".join(r["word"] for r in rows), scores


def train(df: DataFrame, hot: int = HOT_WORDS) -> Model:
    """Counts of all rows of df that have a text and a lang."""
    spark = df.sparkSession
    counts = settle(word_counts(df), "counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(totals) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(totals)
    index = spark.createDataFrame(list(zip(langs, range(len(langs)))), "lang string, l int")
    each = F.collect_list(F.struct("l", "n")).alias("c")  # one of each language
    words = settle(counts.join(F.broadcast(index), "lang").groupBy("word").agg(each, F.sum("n").alias("total")), "words")
    grams = settle(gram_counts(words).groupBy("gram").agg(each).withColumn("size", F.length("gram")), "grams")
    of_size = grams.select("size", F.explode("c").alias("c")).groupBy("size", "c.l").agg(F.sum("c.n").alias("n")).collect()
    distinct = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = {0: np.log(0.5 / (np.array([totals[x] for x in langs], float) + 0.5 * words.count()))}
    for size, z in distinct.items():
        sums = np.zeros(len(langs))
        for r in of_size:
            if r["size"] == size:
                sums[r["l"]] = r["n"]
        base[size] = np.log(0.5 / (sums + 0.5 * z))
    return Model(langs, words, grams, base, hot_words(words, min(hot, HOT_BYTES // (8 * max(1, len(langs)))), len(langs)))


def first_scores(df: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, h, n_words, sums (of the cache's words, by language), rest (the other words and how often they stand there)."""
    word = pa.struct([("word", pa.string()), ("n", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_words", pa.int64()), ("sums", pa.list_(pa.float64())), ("rest", pa.list_(word))])
    shared = df.sparkSession.sparkContext.broadcast(model.hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, scores = shared.value
        index = {w: i for i, w in enumerate(words.split("\n"))} if len(scores) else {}
        for batch in batches:
            hashed, done = batch.column(2), 0
            for ids, docs in slices([batch.select([0, 1])], keep=""):
                total, sums, rest = [], [], []
                for data in docs:
                    at, times, other, counts = [], [], [], word_counter(data.decode())
                    for w, n in counts.items():
                        i = index.get(w)
                        if i is None:
                            other.append({"word": w, "n": n})
                        else:
                            at.append(i)
                            times.append(n)
                    total.append(counts.total())
                    sums.append(np.array(times, float) @ scores[at] if at else np.zeros(scores.shape[1]))
                    rest.append(other)
                yield table(schema, doc_id=ids, h=hashed.slice(done, len(ids)), n_words=total, sums=sums, rest=rest)
                done += len(ids)

    out = df.mapInArrow(run, "doc_id long, h long, n_words long, sums array<double>, rest array<struct<word:string,n:int>>")
    return settle(out.select(F.monotonically_increasing_id().alias("row"), "*"), "scores")


def _log(n: str) -> str:
    return f"ln(2.0D * {n} + 1.0D)"


def backoff(unseen: DataFrame, grams: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """w, kind, v: for words (w, word) with a known n-gram of these lengths, the greatest such length, and the mean of log(2 n + 1) by language."""
    schema = pa.schema([("w", pa.int64()), ("gram", pa.string()), ("times", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, str, int]] = []
            for w, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for size in sizes:
                    held += [(w, g, n) for g, n in grams_of(word, size).items()]
                if len(held) > HELD:
                    yield table(schema, **{c: [h[k] for h in held] for k, c in enumerate(("w", "gram", "times"))})
                    held = []
            yield table(schema, **{c: [h[k] for h in held] for k, c in enumerate(("w", "gram", "times"))})

    found = unseen.select("w", "word").mapInArrow(run, "w long, gram string, times int").join(grams.filter(F.col("size").isin(*sizes)), "gram")
    parts = F.expr(f"concat(array(struct(-1 as l, cast(times as double) as v)), transform(c, x -> struct(x.l as l, times * {_log('x.n')} as v)))")
    sums = found.select("w", "size", F.explode(parts).alias("p")).groupBy("w", "size", "p.l").agg(F.sum("p.v").alias("v"))
    best = sums.groupBy("w", "size").agg(F.collect_list(F.struct("l", "v")).alias("v")).groupBy("w").agg(F.max_by(F.struct("size", "v"), "size").alias("b"))
    times = F.expr("filter(b.v, x -> x.l = -1)[0].v")
    return best.select("w", F.col("b.size").alias("kind"), times.alias("times"), "b.v").select("w", "kind", F.expr("transform(filter(v, x -> x.l >= 0), x -> struct(x.l as l, x.v / times as v))").alias("v"))


#: In place of a language: words that are unseen, by the length of their n-grams (NOTHING: without known n-grams).
NOTHING = 0


def resolved(words: DataFrame, model: Model) -> DataFrame:
    """word, v: of all distinct words, struct<l, v> of each language that has the word or its n-grams; of an unseen one also l = -1 - the length of
    the n-grams it is known by, v = 1."""
    joined = settle(words.distinct().join(model.words.select("word", "c"), "word", "left"), "looked-up")
    known = joined.filter("c is not null").select("word", F.expr(f"transform(c, x -> struct(x.l as l, {_log('x.n')} as v))").alias("v"))
    unseen = settle(joined.filter("c is null").select(F.monotonically_increasing_id().alias("w"), "word"), "unseen")
    long = settle(backoff(unseen, model.grams, GRAMS[:1]), "backoff", narrow=True)
    short = settle(backoff(unseen.join(long.select("w"), "w", "left_anti"), model.grams, GRAMS[1:]), "backoff", narrow=True)
    parts = F.expr(f"concat(array(struct(-1 - coalesce(kind, {NOTHING}) as l, 1.0D as v)), coalesce(v, array()))")
    return known.unionByName(unseen.join(long.unionByName(short), "w", "left").select("word", parts.alias("v")))


def scored(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, h, lang_pred, score of every row (doc_id, text, h)."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    first = first_scores(df, model)
    pairs = first.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    said = pairs.join(resolved(pairs.select("word"), model), "word").select("row", "n", F.explode("v").alias("p")).select("row", "p.l", (F.col("n") * F.col("p.v")).alias("v"))
    more = said.repartition("row").groupBy("row", "l").agg(F.sum("v").alias("v")).groupBy("row").agg(F.collect_list(F.struct("l", "v")).alias("more"))
    langs, base = model.langs, model.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 2_000) for b in batches for at in range(0, b.num_rows, 2_000)):
            pred, score = [], []
            for n_words, sums, entries in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                if not n_words or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                total, known = np.array(sums), n_words
                for e in entries or ():
                    if e["l"] >= 0:
                        total[e["l"]] += e["v"]
                        continue
                    known -= e["v"]
                    if e["l"] != -1 - NOTHING:
                        total += e["v"] * base[-1 - e["l"]]
                total = np.round(total + known * base[0], 9)
                p = np.exp(total - total.max())
                pred.append(langs[int(total.argmax())])
                score.append(round(float(p.max() / p.sum()), 9))
            yield table(schema, doc_id=batch.column(0), h=batch.column(1), lang_pred=pred, score=score)

    rows = first.drop("rest").join(more, "row", "left").select("doc_id", "h", "n_words", "sums", "more")
    return rows.mapInArrow(run, "doc_id long, h long, lang_pred string, score double")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, one row per input row. Texts are not shuffled; words beside the cache are."""
    return scored(texts(df, id_col, text_col).withColumn("h", text_hash(F.col("text"))), model).drop("h")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op3_language_id(spark, sf_dir) -> DataFrame:
    """Contract query: learned from the rows that are not held out, predicted for all."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
