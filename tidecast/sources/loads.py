"""A table that bulk loads fill, each staged file once.

Every load writes its rows and the list of its files into folders of its own and publishes both by
one entry of a commit log. So a load that dies adds nothing, and a file counts as loaded exactly
when its rows are there. A file is known by path, size and time of change: loaded again only when
it has changed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.session import materialize_observed
from tidecast.sources.commits import CommitLog, Conflict
from tidecast.sources.staging import PARQUET_PATTERN, brief_listing, files_below

LEDGER = "NAME string, SIZE long, CHANGED timestamp, LOAD string"
FILES_PER_READ = 10_000
BYTES_PER_TASK = 128 << 20
ATTEMPTS = 5


class LoadedTable:
    """Rows of ``schema`` under ``root``; columns of staged files match by name in any case."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.root}/_commits")

    def loads(self) -> list[str]:
        """The loads that count: all since the last one that truncated."""
        return self._counting(self.log.entries())

    @staticmethod
    def _counting(entries: list[dict]) -> list[str]:
        first = max((k for k, e in enumerate(entries) if e["truncate"]), default=0)
        return [load for e in entries[first:] for load in e["loads"]]

    def rows(self) -> DataFrame:
        return self._read("data", self.schema, self.loads())

    def ledger(self) -> DataFrame:
        """The files whose rows are in the table, with the load that brought them."""
        return self._read("files", T.StructType.fromDDL(LEDGER), self.loads())

    def _read(self, kind: str, schema: T.StructType, loads: list[str]) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{kind}/{load}" for load in loads])

    def staged(self, path: str, pattern: str = PARQUET_PATTERN) -> DataFrame:
        """Files below ``path`` whose path matches; contents are not read."""
        return files_below(self.spark, path).filter(F.col("NAME").rlike(f"^{pattern}$"))

    def load(self, path: str, pattern: str = PARQUET_PATTERN, truncate_first: bool = False) -> int:
        """Adds the rows of files not loaded yet, or with ``truncate_first`` replaces all by those of
        every file; returns the number of files read. A load that meets another one starts again."""
        for _ in range(ATTEMPTS):
            try:
                return self._load(path, pattern, truncate_first)
            except Conflict:
                continue
        raise Conflict(f"{ATTEMPTS} loads into {self.root} were overtaken by others")

    def _load(self, path: str, pattern: str, truncate_first: bool) -> int:
        before = self.log.entries()
        files = self.staged(path, pattern)
        if not truncate_first:
            known = self._read("files", T.StructType.fromDDL(LEDGER), self._counting(before))
            # A ledger small enough for a broadcast would come to the driver first.
            files = files.join(known.hint("merge"), ["NAME", "SIZE", "CHANGED"], "left_anti")
        load = uuid.uuid4().hex
        new, seen = materialize_observed(files, "files-to-load", n=F.count("*"))
        n = seen["n"] or 0
        if not n and not truncate_first:
            return 0
        made = [load] if n else []
        # Names come to the driver a portion at a time, as a reader must be given them.
        portion: list[str] = []
        for row in new.select("NAME").repartition(max(1, -(-n // FILES_PER_READ)), "NAME").toLocalIterator():
            portion.append(row["NAME"])
            if len(portion) == FILES_PER_READ:
                self._read_in(portion, load)
                portion = []
        if portion:
            self._read_in(portion, load)
        if made:
            new.withColumn("LOAD", F.lit(load)).write.parquet(f"{self.root}/files/{load}")

        def check(earlier: list[dict]) -> None:
            if len(earlier) != len(before):
                raise Conflict("another load came first")

        self.log.append({"loads": made, "truncate": truncate_first}, check)
        return n

    def _read_in(self, names: list[str], load: str) -> None:
        """Adds the rows of the files to those of the load, small files many to a task."""
        with brief_listing(self.spark):
            rows = self.spark.read.schema(self.schema).parquet(*names)
        size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        tasks = max(4 * self.spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_TASK))
        rows.coalesce(tasks).write.mode("append").parquet(f"{self.root}/data/{load}")
