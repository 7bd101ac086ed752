"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# One Python worker holds at most this many rows of one series; series beyond it
# take the distributed way of each operator.
MAX_TASK_ROWS = 1_000_000
# A fit holds several arrays of (feature, row), so it is bounded by their cells.
MAX_TASK_CELLS = 10_000_000


def build_session(
    app: str = "tidecast", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """Session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A hot series is split in a join even if a grouping above it then needs a shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        # Listing one folder per series must not cost one task per series.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "256")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidecast-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path; all of an application lie in one folder, to be removed after it."""
    folder = f"tidecast-{spark.sparkContext.applicationId}"
    return os.path.join(shared_dir(spark), folder, f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer the
    real size of the table, so that joins with it are broadcast only when small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, with aggregates of the rows taken while they are written."""
    watch = Observation(f"{label}-{uuid.uuid4().hex}")
    kept = materialize(df.observe(watch, *[v.alias(k) for k, v in metrics.items()]), label)
    return kept, watch.get


def task_count(spark: SparkSession, rows: int = 0) -> int:
    """Partitions for stages that spend their time in Python, of a table of so many ``rows``.

    An explicit number keeps adaptive execution from merging them: their input is
    small in bytes but expensive in CPU. No task gets more than MAX_TASK_ROWS on average.
    """
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * spark.sparkContext.defaultParallelism,
        -(-rows // MAX_TASK_ROWS),
    )
