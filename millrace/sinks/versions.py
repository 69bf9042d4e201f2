"""Tables that are replaced as a whole: versions in folders of their own, and a log of numbered commits that say which one counts.

A commit is a small file that appears at once under the next number, or not at all where another writer took that number; that writer's version is then read, and the
change is made again upon it. A write that is broken off leaves a folder that no commit names. A run that commits twice under one id commits once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import last_wins
from .files import json_text, write_text

TRIES = 20


class Conflict(RuntimeError):
    pass


class Versions:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _numbers(self) -> list[int]:
        folder = self._path("log")
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(folder):
            return []
        names = (s.getPath().getName() for s in store.listStatus(folder))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def commits(self) -> list[dict]:
        """All commits in order: number, folder, run, rows."""
        return [self._commit(n) for n in self._numbers()]

    def _commit(self, n: int) -> dict:
        text = "\n".join(r["value"] for r in self.spark.read.text(f"{self.root}/log/{n:012}.json").collect())
        return {"number": n} | json.loads(text)

    def latest(self) -> dict | None:
        numbers = self._numbers()
        return self._commit(numbers[-1]) if numbers else None

    def read(self) -> DataFrame | None:
        """The version that counts, or none."""
        held = self.latest()
        return None if held is None else self.spark.read.parquet(f"{self.root}/{held['folder']}")

    def write(self, df: DataFrame) -> str:
        """A new folder that counts for nothing yet."""
        folder = f"version-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        return folder

    def commit(self, folder: str, after: int, run: str = "") -> dict:
        """The folder as the commit after number `after` (-1: the first). Raises Conflict where another one has that number."""
        rows = self.spark.read.parquet(f"{self.root}/{folder}").count()
        value = {"folder": folder, "run": run, "rows": rows}
        name = f"log/{after + 1:012}.json"
        part = f"log/_{uuid.uuid4().hex}"
        write_text(self.spark, f"{self.root}/{part}", json_text(value))
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("log").toUri(), self.spark._jsc.hadoopConfiguration())
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE  # an existing file is no target
        try:
            files.rename(self._path(part), self._path(name), options)
        except Exception as e:  # noqa: BLE001
            if "FileAlreadyExists" in str(e) or after + 1 in self._numbers():
                files.delete(self._path(part), False)
                raise Conflict(f"{self.root} has a commit {after + 1}") from e
            raise
        return {"number": after + 1} | value

    def upsert(self, new: DataFrame, keys: list[str], order: list[str], run: str = "", between=None) -> dict:
        """The rows on file with the new ones in their place: the last of each key by `order`, new rows after old ones of equal order. `between` is called before
        each commit (tests)."""
        for _ in range(TRIES):
            log = self.commits()
            if run and (mine := [c for c in log if c["run"] == run]):
                return mine[-1]
            old = self.read()
            rows = new.withColumn("__new", F.lit(1))
            if old is not None:
                rows = old.withColumn("__new", F.lit(0)).unionByName(rows, allowMissingColumns=True)
            folder = self.write(last_wins(rows, keys, [*order, "__new"]).drop("__new"))
            if between is not None:
                between()
            try:
                return self.commit(folder, log[-1]["number"] if log else -1, run)
            except Conflict:
                continue
        raise Conflict(f"{self.root}: another writer was first {TRIES} times")
