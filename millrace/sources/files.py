"""Files as tables: line lists, JSON arrays, CSV, markdown folders; and where they lie."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import strip
from ..operators.relational import settled


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path names anything, in whatever store Spark reads."""
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(0).collect()
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: stripped lines, without blank ones and comments. A missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path).select(strip(F.col("value")).alias("value")).filter((F.col("value") != "") & ~F.col("value").startswith("#"))


def read_json_array(spark: SparkSession, path: str, schema: str | StructType, strict: bool = False) -> DataFrame:
    """Rows of a JSON array of objects, in one file or in the parts that write_json leaves (each is read by its own task). What is no array, no JSON or missing has no rows, or is an error if strict."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not strict and not exists(spark, path):
        return spark.createDataFrame([], fields)
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"), F.col("_metadata.file_path").rlike(r"/part-[^/]*$").alias("part"))
    part = F.concat(F.lit("["), F.regexp_replace("value", r"^\[|[\],]$", ""), F.lit("]"))
    items = F.when(F.col("part"), F.from_json(part, ArrayType(fields))).when(F.col("value").startswith("["), F.from_json("value", ArrayType(fields)))
    if strict:
        items = F.coalesce(items, F.raise_error(F.lit(f"no JSON array: {path}")))
    return text.select(F.explode(items).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Rows of a CSV file, or of its parts, with headers: all strings, stripped, blank for missing; the first `limit` in the file's order."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    columns = [strip(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in rows.columns]
    rows = rows.select(*columns) if limit is None else rows.select(*columns, F.col("_metadata.file_name").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    if limit is None:
        return rows
    at = ("__file", "__at")  # a file of quoted lines isn't split, so ids follow its lines; parts are in order of name
    return rows.orderBy(*at).limit(limit).drop(*at)


def numbered_lines(spark: SparkSession, pattern: str, split_bytes: int | None = None) -> DataFrame:
    """file, pos, text: the lines of all files of a pattern, numbered from 0 within their file. Files are read in splits (of split_bytes) by many tasks and written down
    with their split; lines are counted by split, and a line's place is the lines of the splits before and its own place in its split. A folder of parts that
    Spark wrote is one file, its parts in order of name. The driver gets one row a split. No file, no rows."""
    none = spark.createDataFrame([], "file string, pos long, text string")
    if not exists(spark, pattern):
        return none
    name, kept = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split_bytes:
            spark.conf.set(name, str(split_bytes))
        rows = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("block"))
        rows = settled(rows.withColumn("id", F.monotonically_increasing_id()), "lines")
    finally:
        spark.conf.set(name, kept)
    before: dict[str, int] = {}
    splits = []
    for r in sorted(rows.groupBy("part", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).collect(), key=lambda r: (r["part"], r["block"])):
        file = re.sub(r"/part-[^/]*$", "", r["part"])
        splits.append((r["part"], r["block"], file, before.get(file, 0), r["first"]))
        before[file] = before.get(file, 0) + r["n"]
    if not splits:
        return none
    at = F.broadcast(spark.createDataFrame(splits, "part string, block long, file string, before long, first long"))  # a row a split
    return rows.join(at, ["part", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("pos"), F.col("value").alias("text"))


class Layout:
    """Where the tables of one root lie."""

    FOLDERS = {"seeds": "data/seeds", "cache": "data/cache", "candidates": "data/candidates", "reports_discovery": "reports/discovery", "reports_extraction": "reports/extraction", "reports_fingerprinting": "reports/fingerprinting", "reports_monitoring": "reports/monitoring"}
    LISTS = ("seed_urls", "allow_domains", "deny_domains", "bootstrap_domains")
    TABLES = ("discovered_domains", "discovered_pages", "discovered_redirects", "extracted_signals", "proposed_entities", "proposed_relationships", "domain_fingerprints")

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        if name in self.FOLDERS:
            return f"{self.root}/{self.FOLDERS[name]}"
        if name in self.LISTS:
            return f"{self.root}/data/seeds/{name}.txt"
        if name in self.TABLES:
            return f"{self.root}/data/candidates/{name}.json"
        raise KeyError(name)

    def find(self, spark: SparkSession, path: str) -> str:
        """An input as it is named, or of that name among the candidates (a web queue stands in for a missing queue), else below the root."""
        name = PurePosixPath(path).name
        among = self.path("candidates")
        for place in (path, f"{among}/{name}", f"{among}/web_new_verification_queue.csv" if name == "verification_queue.csv" else ""):
            if place and exists(spark, place):
                return place
        return f"{self.root}/{path}"
