"""Tables in a total order, in as many sorted parts as there are ranges: no task and no driver sees all rows. A manifest names the parts in order with their numbers of rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import json_text, write_text

#: Beside the folder of the parts: within it, Spark would take the manifest for a part, or pass it over.
MANIFEST = "-order.json"


def write_ordered(df: DataFrame, path: str, order: list[Column | str], parts: int | None = None) -> int:
    """Range-partitioned, sorted within parts; returns the number of rows. `order` should be total: rows that it leaves equal may change places in a rerun."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)
    counts = df.sparkSession.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("rows")).collect()  # a row a part
    listed = [{"name": r["name"], "rows": r["rows"]} for r in sorted(counts, key=lambda r: r["name"])]  # named by the number of their range
    write_text(df.sparkSession, f"{path}{MANIFEST}", json_text({"parts": listed}))
    return sum(p["rows"] for p in listed)


def read_ordered(spark: SparkSession, path: str, at: str = "at") -> DataFrame:
    """The rows with their place from 0: the rows of the parts before, and the row's own place in its part."""
    held = json.loads("\n".join(r["value"] for r in spark.read.text(f"{path}{MANIFEST}").collect()))
    rows = spark.read.parquet(path)
    names, before = [], 0
    for p in held["parts"]:
        names.append((p["name"], before))
        before += p["rows"]
    if not names:
        return rows.withColumn(at, F.lit(0).cast("long"))
    first = F.broadcast(spark.createDataFrame(names, "__name string, __before long"))  # a row a part
    rows = rows.select("*", F.col("_metadata.file_name").alias("__part"), F.col("_metadata.row_index").alias("__row"))
    return rows.join(first, F.col("__part") == F.col("__name")).withColumn(at, F.col("__before") + F.col("__row")).drop("__name", "__before", "__part", "__row")
