"""Joins and numberings that no hot key can slow down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.session import materialize, materialize_observed

# A group with more than one row in so many is hot; there can be no more hot groups than this.
HOT_GROUPS = 1000
SALTS = 1 << 20
ROWS_PER_TASK = 200_000


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def attach(rows: DataFrame, groups: DataFrame, key: str, total: int, *by: Column | str) -> DataFrame:
    """Left join of ``rows`` with the one row per ``key`` of ``groups``, whose ``n`` counts its rows.

    Groups with over 1/HOT_GROUPS of all ``total`` rows, at most HOT_GROUPS of them, are
    broadcast; their rows are spread by the columns ``by`` in the shuffle that the others need.
    The columns of ``groups`` other than the key must be named unlike those of ``rows``.
    """
    values = [c for c in groups.columns if c != key]
    hot = F.col("n") * HOT_GROUPS > total
    few = groups.filter(hot).select(F.col(key).alias("_attach_hot"), F.struct(*values).alias("_hot"))
    rest = groups.filter(~hot).select(
        F.col(key).alias("_attach_key"), F.struct(*values).alias("_rest"), F.lit(0).alias("_salt")
    )
    own = F.when(F.col("_hot").isNotNull(), 1 + F.pmod(F.xxhash64(*by), F.lit(SALTS))).otherwise(F.lit(0))
    joined = (
        rows.join(F.broadcast(few), F.col(key) == F.col("_attach_hot"), "left")
        .withColumn("_own", own.cast("int"))
        .join(rest, (F.col(key) == F.col("_attach_key")) & (F.col("_own") == F.col("_salt")), "left")
    )
    found = F.coalesce("_hot", "_rest")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in values])


def one_each(rows: DataFrame, key: str, again: DataFrame, column: str = "_row") -> DataFrame:
    """``column`` of ``rows``, of those with a key in ``again`` (one row per key) only one.

    It is the row with the smallest hash; copies meet inside each task first.
    """
    again, seen = materialize_observed(again.select(F.col(key).alias("_again")), "tied", n=F.count("*"))
    if not seen["n"]:
        return rows.select(column)
    same = F.col(key) == F.col("_again")
    tied = rows.join(again, same, "left_semi").groupBy(key).agg(F.min_by(column, F.xxhash64(column)).alias(column))
    return rows.join(again, same, "left_anti").select(column).unionAll(tied.select(column))


def number_rows(df: DataFrame, rows: int, *order: Column | str, name: str = "row_no") -> DataFrame:
    """``df`` with the position of each row in ``order``, from 0 and without gaps.

    Rows are range partitioned, so no task holds more than its share; only the row count of each
    range, one number for ROWS_PER_TASK rows, is gathered. Rows that are equal in ``order`` are
    parted by where they were read.
    """
    spark = df.sparkSession
    df_columns, df = df.columns, df.withColumn("_read_at", F.monotonically_increasing_id())
    order = (*order, "_read_at")
    tasks = max(1, -(-rows // ROWS_PER_TASK), min(rows // 1000, spark.sparkContext.defaultParallelism))
    placed = materialize(
        df.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("_serial", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_serial", 33))
        .withColumn("_local", F.col("_serial").bitwiseAND((1 << 33) - 1)),
        "numbered",
    )
    offsets, seen = [], 0
    for r in placed.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect():
        offsets.append((r["_range"], seen))
        seen += r["n"]
    starts = spark.createDataFrame(offsets, "_range long, _start long")
    return placed.join(F.broadcast(starts), "_range").select(
        *df_columns, (F.col("_start") + F.col("_local")).alias(name)
    )
