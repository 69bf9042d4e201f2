"""Vector code compression: product quantisation whose nearest entries are found by a vector approximation file.

Vectors of integers (floor of 1024 x) are cut into PARTS consecutive parts; each part has a codebook of at most ENTRIES entries, improved by ROUNDS rounds
of assigning and averaging. For an assignment, the entries' coordinates are quantised to 2**BITS cells each. A block of parts gets a table of the least and
greatest squared distance from each coordinate to each cell; sums over an entry's cells bound its distance from below and above, and entries
whose lower bound is within the least upper bound are compared by integers. Of equal distances the lower index is taken, so the filter never changes
a code.

Every task sums its own parts by entry; what comes to the driver are codebooks, ENTRIES x dimension numbers, whatever the table's size. Errors by label are
summed in tasks first and joined in SALTS parts, as a label may hold a third of all rows.

Rows whose vector is null or holds null or non-finite components are dropped, and so are rows of another length than the commonest (of several, the
greatest). A length that PARTS doesn't divide is filled up with zeros. Components beyond LIMIT count as LIMIT, so that sums of squares fit in a long. Rows
that repeat count each by itself; the first entries come from the rows in order of vec_id (null last) and vector. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, settle, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BITS, BLOCK = 3, 2048
LIMIT = 1 << 27
SALTS = 32


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, x (integers) of the rows that are kept."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    x = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("long"))
    rows = settle(df.filter(whole).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), x.alias("x")), "vectors")
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return rows
    more = F.array_repeat(F.lit(0).cast("long"), -size["d"] % PARTS)
    return rows.filter(F.size("x") == size["d"]).withColumn("x", F.concat("x", more))


class Cells:
    """A codebook with its entries' coordinates quantised: each coordinate's values are cut at quantiles, a cell reaches from its least to its greatest."""

    def __init__(self, book: np.ndarray, bits: int = BITS) -> None:
        n, d = book.shape
        cells = 1 << bits
        self.book, self.low, self.high = book, np.zeros((d, cells)), np.zeros((d, cells))
        self.pick = np.zeros((d, cells, n))  # 1 where an entry lies in a cell
        for j in range(d):
            edges = np.unique(np.quantile(book[:, j], np.arange(1, cells) / cells, method="lower"))
            at = np.searchsorted(edges, book[:, j], side="left")
            for c in np.unique(at):
                own = book[at == c, j]
                self.low[j, c], self.high[j, c] = own.min(), own.max()
            self.pick[j, at, np.arange(n)] = 1
        self.pick = self.pick.reshape(d * cells, n)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """For each row of x, which entries may be the nearest."""
        q = x[:, :, None].astype(float)
        below, above = q - self.low, self.high - q
        least = np.square(np.maximum(np.maximum(-below, -above), 0)).reshape(len(x), -1) @ self.pick
        most = np.square(np.maximum(below, above)).reshape(len(x), -1) @ self.pick
        return least * (1 - 1e-9) <= most.min(axis=1, keepdims=True) * (1 + 1e-9)  # sums of squares beyond 2**53 are rounded

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry to each row of x, the lower index of equal ones."""
        index, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        for at in range(0, len(x), BLOCK):
            part = x[at : at + BLOCK]
            row, entry = np.nonzero(self.candidates(part))
            distance = np.square(part[row] - self.book[entry]).sum(axis=1)
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            least = np.minimum.reduceat(distance, first)
            hit = np.flatnonzero(distance == least[row])
            _, pick = np.unique(row[hit], return_index=True)  # entries come in ascending order
            index[at : at + BLOCK], error[at : at + BLOCK] = entry[hit[pick]], least
        return index, error


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def improved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry is replaced by the floored mean of the parts that are nearest to it; an entry without any stays."""
    n, d = books[0].shape
    schema = pa.schema([("slot", pa.int64()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        total = np.zeros((PARTS, n, d + 1), np.int64)  # sums, and the number of parts
        for batch in batches:
            x = matrix(batch.column(0), PARTS * d)
            for p in range(PARTS):
                own = x[:, p * d : (p + 1) * d]
                index, _ = cells[p].nearest(own)
                np.add.at(total[p, :, :d], index, own)
                total[p, :, d] += np.bincount(index, minlength=n)
        used = np.flatnonzero(np.repeat(total[:, :, d].ravel() > 0, d + 1))
        yield table(schema, slot=used, value=total.ravel()[used])

    total = np.zeros(PARTS * n * (d + 1), np.int64)
    for r in rows.select("x").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        total[r["slot"]] = r["value"]
    total = total.reshape(PARTS, n, d + 1)
    count = total[:, :, d :]
    return [np.where(count[p] > 0, total[p, :, :d] // np.maximum(count[p], 1), books[p]) for p in range(PARTS)]


def compress(df: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): vec_id, label, code (array of an index a part), error of each row that is kept."""
    rows = integer_vectors(df, id_col, vector_col, label_col)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    d = len(first[0]["x"]) // PARTS if first else 0
    whole = np.array([r["x"] for r in first], np.int64).reshape(len(first), PARTS * d)
    books = [whole[:, p * d : (p + 1) * d] for p in range(PARTS)]
    for _ in range(rounds if first else 0):
        books = improved(rows, books)
    label = rows.schema["label"].dataType
    code, error = pa.field("code", pa.list_(pa.int32())), pa.field("error", pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        for batch in batches:
            x = matrix(batch.column(2), PARTS * d)
            got = [cells[p].nearest(x[:, p * d : (p + 1) * d]) for p in range(PARTS)]
            codes = np.stack([i for i, _ in got], axis=1).astype(np.int32)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * PARTS)
            arrays = [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())), pa.array(sum(e for _, e in got))]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(0), batch.schema.field(1), code, error]))

    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id long, label {label.simpleString()}, code array<int>, error long"), books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def with_label_errors(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """rows with label_error: the sum of error over equal labels, nulls together."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.least(F.sum(F.col("error").cast("decimal(19,0)")), most).cast("long").alias("label_error"))
    sums = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    return salted.join(sums, salted["label"].eqNullSafe(sums["of"]) & (salted["salt"] == sums["part"])).drop("of", "part", "salt")


def op13_vector_codes(spark, sf_dir) -> DataFrame:
    """Contract query."""
    rows, books = compress(read(spark, sf_dir, "embeddings"))
    rows = with_label_errors(settle(rows, "codes"))
    code = F.lower(F.concat_ws("", F.transform("code", lambda i: F.lpad(F.hex(i), 2, "0"))))
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
