"""Spark's own event logs, read as a history of queries and the tags they ran under.

A log names the tags of a job, the stages the job may run, and the end of every task. Here these
lines meet in joins: tasks are summed up per stage, a stage counts for the first job that lists it
(later jobs skip what has run), and jobs of one SQL execution are one query. Lines of other kinds
are dropped while the files are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.sources.artifacts import store_of
from tidecast.sources.staging import list_files

# How a session marks the tags of its threads, and its own marks among them.
TAG_PREFIX = r"^spark-session-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(-thread-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})?-?"
OWN_TAG = r"^(execution-root-id-\d+|broadcast exchange \(runId [0-9a-f-]+\))?$"
KINDS = ("SparkListenerJobStart", "SparkListenerJobEnd", "SparkListenerTaskEnd")
SUFFIXES = {".zstd": "zstd", ".zst": "zstd", ".gz": "gzip", ".bz2": "bz2"}
EVENT = (
    "Event string, `Job ID` long, `Submission Time` long, `Completion Time` long, `Stage IDs` array<long>, "
    "Properties map<string,string>, `Job Result` struct<Result:string>, `Stage ID` long, "
    "`Task Info` struct<`Launch Time`:long, `Finish Time`:long>, "
    "`Task Metrics` struct<`Executor Run Time`:long, `Executor CPU Time`:long>"
)
LINES = 4_096


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of the kinds above, of one file after the other, a portion at a time."""
    marks = tuple(f'{{"Event":"{kind}"'.encode() for kind in KINDS)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, at = store_of(path)
            if store.get_file_info(at).type != fs.FileType.File:
                continue
            codec = next((c for end, c in SUFFIXES.items() if at.removesuffix(".inprogress").endswith(end)), None)
            held: list[str] = []
            rest = b""
            with store.open_input_stream(at, compression=codec) as f:
                while True:
                    try:
                        block = f.read(1 << 20)
                    except OSError:  # a log that is still written may end within a compressed block
                        block = b""
                    lines = (rest + block).split(b"\n")
                    rest = lines.pop()
                    if not block and rest:
                        lines.append(rest)
                    held += [x.decode("utf-8", "replace") for x in lines if x.replace(b'": "', b'":"', 1).startswith(marks)]
                    if len(held) >= LINES or (held and not block):
                        yield pa.RecordBatch.from_pydict({"_file": [at] * len(held), "_line": held})
                        held = []
                    if not block:
                        break


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """APP and the fields of every job start, job end and task end in the logs below ``path``.

    Plain and compressed logs (zstd, gzip, bzip2), whole and rolled ones; a torn last line is left out.
    """
    files = list_files(spark, path).select("NAME").filter(~F.col("NAME").rlike(r"/(appstatus_|\.)[^/]*$"))
    tasks = max(1, files.count())
    lines = files.repartition(tasks).mapInArrow(_wanted, "_file string, _line string")
    name = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), r"(\.(zstd|zst|gz|bz2|lz4|inprogress|txt))+$", "")
    app = F.regexp_replace(name, r"^events_\d+_", "")
    return lines.select(app.alias("APP"), F.from_json("_line", EVENT).alias("e")).filter("e.Event IS NOT NULL").select("APP", "e.*")


def tags_of(properties: Column) -> Column:
    """The tags a user gave, without the marks of the session."""
    bare = F.transform(F.split(properties["spark.job.tags"], ","), lambda t: F.regexp_replace(t, TAG_PREFIX, ""))
    return F.array_distinct(F.filter(bare, lambda t: ~t.rlike(OWN_TAG)))


def queries(events: DataFrame) -> DataFrame:
    """APP, QUERY_ID, QUERY_TAG, STARTED, ENDED, EXECUTION_TIME, TASK_TIME, CPU_TIME, JOBS and FAILED.

    One row per query and tag; times in milliseconds, ENDED and EXECUTION_TIME of what has ended.
    A query is a SQL execution with all it started, or else a job. Work without a tag is left out.
    """
    starts = events.filter(F.col("Event") == KINDS[0])
    ends = events.filter(F.col("Event") == KINDS[1]).groupBy("APP", "Job ID").agg(
        F.max("Completion Time").alias("_end"), F.max(F.col("Job Result.Result") != "JobSucceeded").alias("_failed")
    )
    stages = starts.select("APP", "Job ID", F.explode("Stage IDs").alias("Stage ID")).groupBy("APP", "Stage ID").agg(F.min("Job ID").alias("Job ID"))
    tasks = events.filter(F.col("Event") == KINDS[2]).groupBy("APP", "Stage ID").agg(
        F.sum("Task Metrics.Executor Run Time").alias("_ms"), F.sum("Task Metrics.Executor CPU Time").alias("_ns")
    )
    # Each side has a row per job or stage: left to itself, Spark sends millions of these through the driver,
    # as it takes their size from the bytes of a compressed shuffle.
    work = tasks.join(stages.hint("merge"), ["APP", "Stage ID"]).groupBy("APP", "Job ID").agg(F.sum("_ms").alias("_ms"), F.sum("_ns").alias("_ns"))
    p = F.col("Properties")
    own = F.coalesce(p["spark.sql.execution.root.id"], p["spark.sql.execution.id"], F.concat(F.lit("job-"), F.col("Job ID")))
    jobs = starts.select("APP", "Job ID", F.col("Submission Time").alias("_start"), own.alias("QUERY_ID"), F.explode(tags_of(p)).alias("QUERY_TAG"))
    joined = jobs.join(ends.hint("merge"), ["APP", "Job ID"], "left").join(work.hint("merge"), ["APP", "Job ID"], "left")
    start, end = F.min("_start"), F.max("_end")
    return joined.groupBy("APP", "QUERY_ID", "QUERY_TAG").agg(
        F.timestamp_millis(start).alias("STARTED"),
        F.timestamp_millis(end).alias("ENDED"),
        F.greatest(end - start, F.lit(0)).alias("EXECUTION_TIME"),
        F.coalesce(F.sum("_ms"), F.lit(0)).alias("TASK_TIME"),
        F.floor(F.coalesce(F.sum("_ns"), F.lit(0)) / 1_000_000).alias("CPU_TIME"),
        F.count("*").alias("JOBS"),
        F.coalesce(F.max("_failed"), F.lit(False)).alias("FAILED"),
    )


def query_log(spark: SparkSession, path: str, warehouse_size: str) -> DataFrame:
    """The queries in the logs below ``path`` as ``plans.jobs.cost`` takes them, run on a warehouse of this size."""
    return queries(read_events(spark, path)).withColumn("WAREHOUSE_SIZE", F.lit(warehouse_size))
