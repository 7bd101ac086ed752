"""Row numbers inside each series, without ever holding a series in one task.

A window over the grain would send a series that owns a third of the data to a
single task. Here a small histogram of (grain, calendar bucket) counts gives each
bucket its starting row number, and only rows inside one bucket are ordered
together. Should even one bucket be too large for a task, rows are range
partitioned on their full order instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.calendar import time_bucket
from tidecast.session import MAX_TASK_ROWS, materialize, materialize_observed, task_count
from tidecast.spec import PanelSpec

COPY_CHUNK = 100_000


def with_bucket(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of named series with their bucket; a row without a series is dropped."""
    return df.filter(F.col(spec.grain).isNotNull()).withColumn(
        "_bucket", time_bucket(F.col(spec.time), spec.bucket)
    )


def bucket_counts(df: DataFrame, spec: PanelSpec, counts: DataFrame | None = None) -> DataFrame:
    """Rows per (grain, bucket) with the running and the total count of the grain.

    The windows see one row per bucket, a number set by the calendar, not the data. ``counts``
    (grain, _bucket, _n) are taken as they are, if given, and ``df`` is not read.
    """
    by_time = Window.partitionBy(spec.grain).orderBy("_bucket")
    if counts is None:
        counts = (
            with_bucket(df.select(spec.grain, spec.time), spec)
            .groupBy(spec.grain, "_bucket")
            .agg(F.count("*").alias("_n"))
        )
    return counts.select(
        spec.grain,
        "_bucket",
        "_n",
        F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("_through"),
        F.sum("_n").over(Window.partitionBy(spec.grain)).alias("PARTITION_COUNT"),
    )


def range_ends(runs: DataFrame, grain: str, key: str, copies: str, rows: int = 0) -> DataFrame:
    """Running sum of ``copies`` per grain in ``key`` order, by range partitioning of at most ``rows`` rows.

    ``runs`` holds one row per distinct key, so the ranges can always be cut small.
    """
    spark = runs.sparkSession
    placed = materialize(
        runs.repartitionByRange(task_count(spark, rows), F.col(grain), F.col(key)).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranges",
    )
    earlier = Window.partitionBy(grain).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(grain, "_range")
        .agg(F.sum(copies).alias("_in_range"))
        .select(grain, "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy(grain, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.withColumn("_end", F.sum(copies).over(inside))
        .join(offsets, [grain, "_range"])
        .withColumn("_end", F.col("_end") + F.col("_offset"))
        .drop("_range", "_offset")
    )


def repeat_rows(df: DataFrame, copies: str, index: str, rows: int = 0) -> DataFrame:
    """Each row ``copies`` times, about ``rows`` in all, numbered from 1, with long runs spread over tasks."""
    last_chunk = ((F.col(copies) - 1) / F.lit(COPY_CHUNK)).cast("long")
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    first = F.col("_chunk") * COPY_CHUNK + 1
    last = F.least(F.col(copies), (F.col("_chunk") + 1) * COPY_CHUNK)
    return (
        chunks.repartition(task_count(df.sparkSession, rows))
        .withColumn(index, F.explode(F.sequence(first, last)))
        .drop("_chunk")
    )


def rank_in_time(
    df: DataFrame, spec: PanelSpec, max_task_rows: int = MAX_TASK_ROWS
) -> DataFrame:
    """``df`` plus ROW_NUM, the position of the row in its series, from 1."""
    columns = df.columns
    cells, seen = materialize_observed(bucket_counts(df, spec), "bucket-counts", largest=F.max("_n"), total=F.sum("_n"))
    total = seen["total"] or 0
    if (seen["largest"] or 0) <= max_task_rows:
        inside = Window.partitionBy(spec.grain, "_bucket").orderBy(spec.order_key(df))
        before = cells.select(spec.grain, "_bucket", (F.col("_through") - F.col("_n")).alias("_before"))
        return (
            with_bucket(df, spec)
            .withColumn("_local", F.row_number().over(inside))
            .join(before, [spec.grain, "_bucket"])
            .select(*columns, (F.col("_before") + F.col("_local")).alias("ROW_NUM"))
        )
    whole_key = PanelSpec(spec.grain, spec.time, spec.target, spec.tiebreak).order_key(df)
    named = with_signs(df.filter(F.col(spec.grain).isNotNull()))
    runs = collapse_copies(named, spec.grain, whole_key, "_minus")
    ends = range_ends(runs, spec.grain, "_key", "_copies", total)
    return (
        repeat_rows(ends, "_copies", "_i", total)
        .select(spec.grain, "_minus", "_key.*", (F.col("_end") - F.col("_copies") + F.col("_i")).alias("ROW_NUM"))
        .select(*original(df), "ROW_NUM")
    )


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() in ("float", "double")]


def with_signs(df: DataFrame) -> DataFrame:
    """``df`` plus _minus, which tells for each floating column whether it holds -0.0.

    A grouping writes such zeros as 0.0; grouped by _minus too, rows keep what they held.
    """
    signs = [F.coalesce(F.col(c).cast("string") == "-0.0", F.lit(False)) for c in _floating(df)]
    return df.withColumn("_minus", F.array(*signs).cast("array<boolean>"))


def original(df: DataFrame) -> list[Column]:
    """The columns of ``df`` taken from grouped rows with their _minus."""
    at = {c: i for i, c in enumerate(_floating(df))}

    def value(c: str) -> Column:
        if c not in at:
            return F.col(c)
        return F.when(F.col("_minus")[at[c]], F.lit(-0.0).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    return [value(c) for c in df.columns]


def collapse_copies(df: DataFrame, grain: str, key: Column, *per_grain: str) -> DataFrame:
    """One row per distinct (grain, key) with its number of copies, combined before the shuffle.

    ``per_grain`` are further columns to group by, kept as they are.
    """
    keyed = df.select(grain, *per_grain, key.alias("_key"))
    return keyed.groupBy(grain, *per_grain, "_key").agg(F.count("*").alias("_copies"))
