"""Series too long for one task, and how their rows are spread."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.session import MAX_TASK_ROWS, materialize_observed, task_count

BROADCAST_SERIES = 20_000  # series of a table that is sent to all tasks


def long_series(rows: DataFrame, grain: str, max_task_rows: int) -> tuple[DataFrame, int, int]:
    """Series of more than ``max_task_rows`` rows with the number of ``_parts`` they need, the
    largest such number (0 if there are none), and the rows of all series. Only the grain column is read."""
    sizes = rows.groupBy(grain).agg(F.count("*").alias("_rows"))
    all_rows = Observation(f"series-{uuid.uuid4().hex}")
    sizes = sizes.observe(all_rows, F.sum("_rows").alias("total"))
    parts = F.ceil(F.col("_rows") / F.lit(max_task_rows)).cast("int").alias("_parts")
    large, seen = materialize_observed(
        sizes.filter(F.col("_rows") > max_task_rows).select(grain, "_rows", parts),
        "large-series",
        most=F.max("_parts"),
    )
    return large, seen["most"] or 0, all_rows.get["total"] or 0


def join_series(rows: DataFrame, table: DataFrame, grain: str, max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """Inner join of ``rows`` with the one row per series of the stored ``table``.

    A table of up to BROADCAST_SERIES series goes to the rows. For a larger one the rows are
    shuffled; those of a long series are then dealt to several tasks by their hash, each with a
    copy of the series' row in ``table``, so that no session setting is needed against hot series.
    """
    if table.count() <= BROADCAST_SERIES:
        return rows.join(F.broadcast(table), grain)
    large, most, _ = long_series(rows, grain, max_task_rows)
    if not most:
        return rows.join(table, grain)
    named = large.select(F.col(grain).alias("_series"), "_parts")
    if large.count() <= BROADCAST_SERIES:
        named = F.broadcast(named)
    odd = (T.MapType, T.VariantType)
    own = F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema if not isinstance(f.dataType, odd)])
    salted = rows.join(named, F.col(grain) == F.col("_series"), "left").withColumn(
        "_salt", F.coalesce(F.pmod(own, F.col("_parts")), F.lit(0)).cast("int")
    )
    copies = table.join(named, F.col(grain) == F.col("_series"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    joined = salted.drop("_series", "_parts").join(copies.drop("_series", "_parts"), [grain, "_salt"])
    return joined.drop("_salt")


def in_parts(rows: DataFrame, grain: str, max_task_rows: int) -> tuple[DataFrame, DataFrame | None, DataFrame, int]:
    """Rows of short series, rows of long ones with their ``_part``, the table of long series, and
    the number of tasks that all rows are worth.

    Rows without a series count as one series. The parts come from a round-robin shuffle, which Spark repeats exactly after a lost
    task and which also spreads exact copies of one row.
    """
    large, most, total = long_series(rows, grain, max_task_rows)
    tasks = task_count(rows.sparkSession, total)
    if not most:
        return rows, None, large, tasks
    named = large.select(F.col(grain).alias("_series"), "_parts")
    same = F.col(grain).eqNullSafe(F.col("_series"))
    spread = (
        rows.join(named, same)
        .drop("_series")
        .repartition(max(most, tasks))
        .withColumn("_part", F.pmod(F.spark_partition_id(), F.col("_parts")))
        .drop("_parts")
    )
    return rows.join(named, same, "left_anti"), spread, large, tasks
