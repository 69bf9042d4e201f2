"""Stages that drop or change rows of documents and keep all their columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, maybe_among, release, settle, small_batches, texts, trim
from .language import UNKNOWN, Model, scored, text_hash
from .secrets import automaton, redacted, scan

LEAST_SCORE = 0.5


def each_text(df: DataFrame, make: Callable[[], Callable[[bytes | None], tuple[bool, str | None]]], text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """make() is called once in a task and gives a function from a text to (whether the row stays, its new text or None for the old one). Where a text changes, length_col follows, if there is one."""
    at = df.columns.index(text_col)
    length = df.columns.index(length_col) if length_col in df.columns else None

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start = size = 0
        for i, value in enumerate(batch.column(at)):
            size += len(value.as_py() or "")
            if size > SLICE_BYTES:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        one = make()
        for batch in batches:
            for part in parts(batch):
                got = [one(None if x is None else x.encode()) for x in part.column(at).to_pylist()]
                if any(t is not None for _, t in got):
                    columns = list(part.columns)
                    new = [old if t is None else t for (_, t), old in zip(got, part.column(at).to_pylist())]
                    columns[at] = pa.array(new, columns[at].type)
                    if length is not None:
                        sizes = [old if t is None else len(t) for (_, t), old in zip(got, columns[length].to_pylist())]
                        columns[length] = pa.array(sizes, columns[length].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part.filter(pa.array([k for k, _ in got]))
        batch = part = got = one = None
        trim()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def keep_languages(df: DataFrame, model: Model, least: float = LEAST_SCORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows whose language is told with a posterior of at least `least`: null texts and texts without letters go. A row is known by its id and its
    text's hash; rows that repeat both share one decision. All columns stay; only rows that may go are shuffled."""
    rows = texts(df, id_col, text_col).withColumn("h", text_hash(F.col("text")))
    gone = scored(rows, model).filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).select("doc_id", "h").distinct()
    gone = settle(gone, "gone", narrow=True)
    inside = maybe_among(text_hash(F.col(text_col)), gone.select(F.col("h").alias("id")))
    maybe, drop = df.filter(inside), gone.select(F.col("doc_id").alias("id"), "h").alias("gone")
    same = maybe[id_col].cast("long").eqNullSafe(F.col("gone.id")) & (text_hash(maybe[text_col]) == F.col("gone.h"))
    return maybe.join(drop, same, "left_anti").unionByName(df.filter(~inside))


def redact_secrets(df: DataFrame, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """All rows, with the spans found replaced by the mark (of spans that overlap, their union). Null and empty texts stay as they are."""

    def make():
        auto = automaton()

        def one(data: bytes | None) -> tuple[bool, str | None]:
            found = scan(data, auto) if data else []
            return True, redacted(data, found, mark) if found else None

        return one

    return each_text(df, make, text_col)


def without(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is not among the ids (one column, `id`); rows without an id stay. Only rows that may be among them are shuffled."""
    ids = settle(ids.distinct(), "gone", narrow=True)
    inside = F.coalesce(maybe_among(F.col(id_col).cast("long"), ids), F.lit(False))
    maybe, drop = df.filter(inside), ids.alias("gone")
    return maybe.join(drop, maybe[id_col] == F.col("gone.id"), "left_anti").unionByName(df.filter(~inside))


ROW = "__row"


def without_rows(df: DataFrame, gone: Callable[[DataFrame], DataFrame], id_col: str = "doc_id") -> DataFrame:
    """Rows but those that gone(df) names (ids in a column `id`). Where an id is repeated or null, gone() gets a number for each row in its place, so that every row is
    judged by itself and none goes for another's sake. All columns stay."""
    if df.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty():
        return without(df, gone(df), id_col)
    rows = settle(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    return without(rows, gone(rows.withColumn(id_col, F.col(ROW)).drop(ROW)), ROW).drop(ROW)
