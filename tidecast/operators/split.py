"""Chronological train/test split of every series.

A row trains when its position in its series is at most
``floor(count * (1 - test_pct))``. The position itself is never computed for all
rows: per series it is enough to know the row at the cutoff. Most buckets lie
wholly on one side of it, so only the bucket that contains the cutoff is ordered.
The labelled table is then one scan of the input joined with one row per series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.ranking import (
    bucket_counts,
    collapse_copies,
    original,
    range_ends,
    repeat_rows,
    with_signs,
    with_bucket,
)
from tidecast.operators.skew import join_series
from tidecast.session import MAX_TASK_ROWS, materialize, materialize_observed
from tidecast.spec import PanelSpec


def partition_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(spec.grain).agg(F.count("*").alias("PARTITION_COUNT"))


@dataclass(frozen=True)
class SplitPoints:
    """``table`` has one row per series: its count, its cutoff and the row at the cutoff."""

    table: DataFrame
    cuts_copies: bool


def split_points(
    df: DataFrame, spec: PanelSpec, test_pct: float, max_task_rows: int = MAX_TASK_ROWS, counts: DataFrame | None = None
) -> SplitPoints:
    """Where to split each series; ``counts`` are known rows per (grain, bucket), see ``bucket_counts``.

    ``_full`` is the last bucket that trains as a whole. ``_mixed`` is the bucket cut
    in two, with ``_key`` its last training row, ``_copies`` the number of exact copies
    of that row and ``_taken`` how many of them train.
    """
    cutoff = F.floor(F.col("PARTITION_COUNT") * F.lit(1.0 - test_pct)).cast("long")
    cells = bucket_counts(df, spec, counts).withColumn("TRAIN_CUTOFF", cutoff)
    before = F.col("_through") - F.col("_n")
    is_mixed = (before < F.col("TRAIN_CUTOFF")) & (F.col("_through") > F.col("TRAIN_CUTOFF"))
    points, seen = materialize_observed(
        cells.groupBy(spec.grain).agg(
            F.max("PARTITION_COUNT").alias("PARTITION_COUNT"),
            F.max("TRAIN_CUTOFF").alias("TRAIN_CUTOFF"),
            F.max(F.when(F.col("_through") <= F.col("TRAIN_CUTOFF"), F.col("_bucket"))).alias("_full"),
            F.max(F.when(is_mixed, F.col("_bucket"))).alias("_mixed"),
            F.max(F.when(is_mixed, F.col("TRAIN_CUTOFF") - before)).alias("_need"),
            F.max(F.when(is_mixed, F.col("_n"))).alias("_mixed_rows"),
        ),
        "split-cells",
        largest=F.max("_mixed_rows"),
        total=F.sum("_mixed_rows"),
    )

    wanted = points.filter(F.col("_mixed").isNotNull()).select(
        spec.grain, F.col("_mixed").alias("_bucket"), "_need"
    )
    columns = list(dict.fromkeys([spec.grain, *spec.order_columns(df)]))
    undecided = with_bucket(df.select(*columns), spec).join(wanted, [spec.grain, "_bucket"])
    runs = collapse_copies(undecided, spec.grain, spec.order_key(df), "_need")
    if (seen["largest"] or 0) <= max_task_rows:
        upto = Window.partitionBy(spec.grain).orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
        ends = runs.withColumn("_end", F.sum("_copies").over(upto))
    else:
        ends = range_ends(runs, spec.grain, "_key", "_copies", seen["total"])
    taken = F.col("_need") - F.col("_end") + F.col("_copies")
    at_cutoff = ends.filter((taken > 0) & (taken <= F.col("_copies"))).select(
        spec.grain, "_key", "_copies", taken.alias("_taken")
    )
    table, seen = materialize_observed(
        points.drop("_need", "_mixed_rows").join(at_cutoff, spec.grain, "left"),
        "split-points",
        cut=F.count_if(F.col("_copies") > F.col("_taken")),
    )
    if seen["cut"] and spec.unique:
        raise ValueError(f"({spec.grain}, {', '.join(spec.order_columns(df))}) is not unique at a cutoff")
    return SplitPoints(table, seen["cut"] > 0)


def label_rows(df: DataFrame, points: SplitPoints, spec: PanelSpec) -> DataFrame:
    """``df`` plus IS_TRAIN, by comparing each row with the split point of its series."""
    columns = df.columns
    key = spec.order_key(df)
    cut = points.table.select(spec.grain, "_full", "_mixed", "_key", "_copies", "_taken")
    side = join_series(with_bucket(df, spec), cut, spec.grain)
    is_train = F.coalesce(
        F.when(F.col("_bucket") == F.col("_mixed"), key <= F.col("_key")).otherwise(
            F.col("_bucket") <= F.col("_full")
        ),
        F.lit(False),
    )
    if not points.cuts_copies:
        return side.select(*columns, is_train.alias("IS_TRAIN"))

    is_cut_copy = F.coalesce(
        (F.col("_bucket") == F.col("_mixed"))
        & (F.col("_copies") > F.col("_taken"))
        & (key == F.col("_key")),
        F.lit(False),
    )
    plain = side.filter(~is_cut_copy).select(*columns, is_train.alias("IS_TRAIN"))
    # Copies differ in the signs of zeros at most; the window sees one row per such variant.
    cut_copies = side.filter(is_cut_copy).select(*columns, "_taken")
    variants = collapse_copies(with_signs(cut_copies), spec.grain, key, "_taken", "_minus")
    upto = Window.partitionBy(spec.grain).orderBy("_minus").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_copies").over(upto), F.lit(0))
    flat = variants.select(spec.grain, "_minus", "_copies", "_taken", before.alias("_before"), "_key.*")
    copies = repeat_rows(materialize(flat, "cut-copies"), "_copies", "_i").select(
        *original(df), (F.col("_before") + F.col("_i") <= F.col("_taken")).alias("IS_TRAIN")
    )
    return plain.unionByName(copies)


def time_split(
    df: DataFrame, spec: PanelSpec, test_pct: float = 0.1, max_task_rows: int = MAX_TASK_ROWS
) -> DataFrame:
    """``df`` without unnamed series, plus IS_TRAIN."""
    return label_rows(df, split_points(df, spec, test_pct, max_task_rows), spec)


def train_test(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides with the original columns only."""
    return (
        labelled.filter(F.col("IS_TRAIN")).drop("IS_TRAIN"),
        labelled.filter(~F.col("IS_TRAIN")).drop("IS_TRAIN"),
    )
