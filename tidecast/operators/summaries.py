"""Counts of a growing panel, kept so that an appended day costs only itself.

A summary has one cell per series and calendar bucket: its rows and its first and last instant.
Cells of new rows are added by one commit; cells of one series and bucket are summed up when they
are read, and ``compact`` writes them as one. Counts, the data summary and the split points all
follow from cells. Only the one bucket of a series that a cutoff falls into is read from the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.ranking import with_bucket
from tidecast.operators.split import label_rows, split_points
from tidecast.session import MAX_TASK_ROWS
from tidecast.sources.commits import CommitLog, Conflict
from tidecast.spec import PanelSpec


class PanelStore:
    """A panel stored by calendar bucket, with its summary, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: PanelSpec, schema: T.StructType):
        self.spark, self.root, self.spec, self.schema = spark, root.rstrip("/"), spec, schema
        self.log = CommitLog(spark, f"{self.root}/_commits")

    @staticmethod
    def _standing(entries: list[dict]) -> tuple[list[str], list[str]]:
        """Row folders and cell folders that count."""
        rows, cells = [], []
        for e in entries:
            rows += e["rows"]
            cells = [c for c in cells if c not in e["replaced"]] + e["cells"]
        return rows, cells

    def append(self, rows: DataFrame) -> None:
        """Adds rows and their cells at once; rows without a series are left out."""
        name = uuid.uuid4().hex
        placed = with_bucket(rows.select(*self.schema.names), self.spec)
        placed.withColumnRenamed("_bucket", "BUCKET").write.partitionBy("BUCKET").parquet(f"{self.root}/rows/APPEND={name}")
        written = self._rows([name])
        cells = with_bucket(written, self.spec).groupBy(self.spec.grain, "_bucket").agg(
            F.count("*").alias("_n"), F.min(self.spec.time).alias("_first"), F.max(self.spec.time).alias("_last")
        )
        cells.write.parquet(f"{self.root}/cells/{name}")
        self.log.append({"rows": [name], "cells": [name], "replaced": []})

    def _rows(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        folders = T.StructType([*self.schema, T.StructField("APPEND", T.StringType()), T.StructField("BUCKET", T.LongType())])
        parts = [f"{self.root}/rows/APPEND={n}" for n in names]
        found = self.spark.read.schema(folders).option("basePath", f"{self.root}/rows").parquet(*parts)
        return found.drop("APPEND", "BUCKET")

    def rows(self) -> DataFrame:
        return self._rows(self._standing(self.log.entries())[0])

    def _read_cells(self, names: list[str]) -> DataFrame:
        kind = self.schema[self.spec.time].dataType
        schema = T.StructType([
            self.schema[self.spec.grain], T.StructField("_bucket", T.LongType()), T.StructField("_n", T.LongType()),
            T.StructField("_first", kind), T.StructField("_last", kind),
        ])
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/cells/{n}" for n in names])

    def cells(self) -> DataFrame:
        """grain, _bucket, _n, _first and _last, one row per series and bucket."""
        found = self._read_cells(self._standing(self.log.entries())[1])
        return self._summed(found)

    def _summed(self, cells: DataFrame) -> DataFrame:
        return cells.groupBy(self.spec.grain, "_bucket").agg(
            F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
        )

    def compact(self) -> None:
        """Writes the cells of all appends as one; an append meanwhile stays beside them."""
        before = self._standing(self.log.entries())[1]
        if len(before) < 2:
            return
        name = uuid.uuid4().hex
        self._summed(self._read_cells(before)).write.parquet(f"{self.root}/cells/{name}")

        def check(earlier: list[dict]) -> None:
            if not set(before) <= set(self._standing(earlier)[1]):
                raise Conflict("another compaction came first")

        self.log.append({"rows": [], "cells": [name], "replaced": before}, check)

    def summary(self) -> DataFrame:
        """One row, as ``generate.summary`` has it, without reading a row of the panel."""
        names = ("TOTAL_ROWS", "PARTITIONS", "MIN_DATE", "MAX_DATE")
        values = (F.coalesce(F.sum("_n"), F.lit(0)), F.count_distinct(self.spec.grain), F.min("_first"), F.max("_last"))
        return self.cells().agg(*[v.alias(n) for v, n in zip(values, names)])

    def partition_counts(self) -> DataFrame:
        return self.cells().groupBy(self.spec.grain).agg(F.sum("_n").alias("PARTITION_COUNT"))

    def split(self, test_pct: float = 0.1, max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
        """The panel plus IS_TRAIN, as ``time_split`` has it; the cutoffs come from the cells."""
        df = self.rows()
        points = split_points(df, self.spec, test_pct, max_task_rows, self.cells().select(self.spec.grain, "_bucket", "_n"))
        return label_rows(df, points, self.spec)
