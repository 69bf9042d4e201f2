"""Tables as files: deterministic JSON and CSV in sorted parts, one folder a bucket, reports of runs. Only reports, of one row, are written by the driver."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import numbered, settled


def json_text(value) -> str:
    """Sorted keys, two blanks a level, ASCII, a final line feed."""
    return json.dumps(value, indent=2, sort_keys=True, ensure_ascii=True) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file, in whatever store Spark writes: under another name first, then moved into place."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    store.delete(target, False)
    store.rename(part, target)


def _element(row: Column) -> Column:
    """A row as an element of a JSON array in the deterministic form, two blanks in."""

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: "  " + json.dumps(json.loads(r), indent=2, sort_keys=True, ensure_ascii=True).replace("\n", "\n  "))

    return text(F.to_json(row, {"ignoreNullFields": "false"}))


def write_json(df: DataFrame, path: str, order: list[Column | str]) -> None:
    """The rows as one deterministic JSON array in a total order: a folder of sorted parts, which put together in order of name are the array's text. Each part
    holds whole elements; no task and no driver sees all of them."""
    columns = df.columns
    rows = numbered(df, order, "__at")
    n = rows.count()
    if not n:
        write_text(df.sparkSession, f"{path}/part-00000.json", "[]\n")
        return
    text = F.concat(F.when(F.col("__at") == 0, "[\n").otherwise(""), _element(F.struct(*columns)), F.when(F.col("__at") == n - 1, "\n]").otherwise(","))
    rows.select("__at", text.alias("value")).repartitionByRange("__at").sortWithinPartitions("__at").select("value").write.text(path)


def write_csv(df: DataFrame, path: str, order: list[Column | str]) -> None:
    """A folder of CSV parts, each with a header and quotes where needed, sorted within and among parts. Nulls are blank."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))
    rows.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", lineSep="\n")


def write_buckets(df: DataFrame, path: str, column: str, names: list[str], order: list[Column | str]) -> dict[str, int]:
    """A CSV folder for each name, also for those without rows; returns their numbers of rows. Rows of other names are an error."""
    df = settled(df, "buckets")
    counts = {r[column]: r["n"] for r in df.groupBy(column).agg(F.count("*").alias("n")).limit(len(names) + 1).collect()}
    if set(counts) - set(names):
        raise ValueError(f"unknown buckets: {sorted(set(counts) - set(names))}")
    for name in names:
        write_csv(df.filter(F.col(column) == name).drop(column), f"{path}/{name}.csv", order)
    return {name: counts.get(name, 0) for name in names}


def patch_json(spark: SparkSession, path: str, **values) -> dict:
    """A JSON object in a file with some values set anew; a missing file stays missing."""
    from ..sources.files import exists

    if not exists(spark, path):
        return {}
    held = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())) | values
    write_text(spark, path, json_text(held))
    return held


def report_name(kind: str, run_at: str) -> str:
    return f"{kind}-{run_at.replace(':', '-')}.json"


def write_report(df: DataFrame, folder: str, kind: str, run_at: str) -> str:
    """The one row of counters of a run as a JSON file named by kind and time; returns its path."""
    path = f"{folder}/{report_name(kind, run_at)}"
    row = df.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a report is one row")
    write_text(df.sparkSession, path, json_text({"run_at": run_at, **row[0].asDict(True)}))
    return path
