"""Parquet files laid out by series, and loading files into a table by column name."""

from __future__ import annotations

import contextlib
import functools
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.skew import in_parts
from tidecast.session import MAX_TASK_ROWS, materialize, materialize_observed, task_count
from tidecast.sources.artifacts import store_of

# The size limit of a staged file and the default name pattern of a load.
MAX_FILE_BYTES = 15_728_640
PARQUET_PATTERN = r".*[.]parquet"


# What Spark's writer percent-encodes in the name of a partition's folder, and its name for none.
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Types that Arrow writes as Spark does.
PLAIN = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
VALUE_BYTES = 20  # a value counts this much at least, for its levels, pages, dictionary and statistics

WIDTHS = 4  # rows of one write differ in width by this factor at most
LIST_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LIST_CACHE = "spark.sql.hive.manageFilesourcePartitions"
GLOB = set("{}[]*?\\")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row before encoding: eight for a number or time, as they are for text and bytes,
    those of its JSON for anything nested."""

    def width(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 4
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 4
        return F.lit(8)

    return functools.reduce(lambda a, b: a + b, [width(f) for f in df.schema], F.lit(0))


def width_classes(df: DataFrame) -> list[tuple[int, int]]:
    """Classes of row widths with the largest width of each: a power of WIDTHS, in rising order."""
    if all(isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) for f in df.schema):
        return [(0, 8 * len(df.schema))]
    sized = df.select(row_bytes(df).alias("_w"))
    found = sized.groupBy(_class(F.col("_w")).alias("_c")).agg(F.max("_w").alias("_most")).collect()
    return sorted((r["_c"], r["_most"]) for r in found)


def _class(width: Column) -> Column:
    return F.floor(F.log(float(WIDTHS), width.cast("double"))).cast("int")


def folder_of(value: str) -> str:
    """The folder of a series, named as Spark names that of a partition: NULL and "" share one."""
    name = ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE
    return f"SERIES={name}"


def _write_files(batches: Iterator[pa.RecordBatch], path: str, mark: str, most_rows: int) -> Iterator[pa.RecordBatch]:
    """Writes rows that come series by series, named in their last column, and lists the hidden files."""
    store, root = store_of(path)
    task = TaskContext.get()
    name = f"part-{task.partitionId():05d}-{mark}"
    hidden = f".{name}.{task.taskAttemptId()}"
    held: list[pa.RecordBatch] = []
    series, rows, number = None, 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal held, rows, number
        folder, end = f"{root}/{folder_of(series)}", f".c{number:03d}.snappy.parquet"
        store.create_dir(folder, recursive=True)
        pq.write_table(pa.Table.from_batches(held), f"{folder}/{hidden}{end}", filesystem=store, compression="snappy", store_schema=False)
        held, rows, number = [], 0, number + 1
        return pa.RecordBatch.from_pydict({"_from": [f"{folder}/{hidden}{end}"], "_to": [f"{folder}/{name}{end}"]})

    for batch in batches:
        names = batch.column(batch.num_columns - 1).to_pylist()
        values = batch.select(range(batch.num_columns - 1))
        at = 0
        while at < len(names):
            if names[at] != series or rows == most_rows:
                if rows:
                    yield flush()
                number = number if names[at] == series else 0
                series = names[at]
            end = at + 1
            while end < len(names) and names[end] == series and rows + end - at < most_rows:
                end += 1
            held.append(values.slice(at, end - at))
            rows, at = rows + end - at, end
    if rows:
        yield flush()


def _publish(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Gives files their names. What an earlier attempt of the task has renamed stays."""
    store, _ = store_of(path)
    for batch in batches:
        for old, new in zip(*(c.to_pylist() for c in batch.columns)):
            if store.get_file_info(new).type != fs.FileType.File:
                store.move(old, new)
        yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})


def export_by_series(
    df: DataFrame,
    path: str,
    key: str,
    max_file_bytes: int = MAX_FILE_BYTES,
    max_task_rows: int = MAX_TASK_ROWS,
) -> None:
    """Replace ``path`` by Snappy Parquet files, one folder per value of ``key``.

    Files keep the key column, so each is complete by itself. A series is written by one
    task, a long one by several. No file has more rows than fit ``max_file_bytes`` at the width of
    its widest: rows of very different widths are written one class of widths after the other, so a
    few wide ones do not cut the others into small files. Only a row wider than that is alone.

    Tasks write columns of plain types by Arrow under hidden names, which are replaced once all tasks
    have ended; readers skip what a failed attempt leaves. Spark's own writer takes other types: on a
    local disk it starts a few processes per file to set permissions, too many for a file per series.
    """
    spark = df.sparkSession
    short, spread, _, tasks = in_parts(df, key, max_task_rows)
    gathered = short.repartition(tasks, key)
    if spread is not None:
        gathered = gathered.unionByName(spread.repartition(tasks, key, "_part").drop("_part"))
    classes = width_classes(df) or [(0, 1)]
    plain = all(isinstance(f.dataType, PLAIN) for f in df.schema) and not isinstance(df.schema[key].dataType, T.BinaryType)
    if plain:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.delete(target, True)
        store.mkdirs(target)
    for k, (number, most) in enumerate(classes):
        rows = gathered if len(classes) == 1 else gathered.filter(_class(row_bytes(df)) == number)
        most_rows = max(1, max_file_bytes // max(most, VALUE_BYTES * len(df.columns)))
        if plain:
            named = rows.withColumn("_series", F.coalesce(F.col(key).cast("string"), F.lit(""))).sortWithinPartitions("_series")
            write = functools.partial(_write_files, path=path, mark=uuid.uuid4().hex, most_rows=most_rows)
            made = materialize(named.mapInArrow(write, "_from string, _to string"), "exported")
            made.mapInArrow(functools.partial(_publish, path=path), "n long").agg(F.sum("n")).collect()
            continue
        (
            rows.withColumn("SERIES", F.col(key))
            .write.mode("append" if k else "overwrite")
            .partitionBy("SERIES")
            .option("compression", "snappy")
            .option("maxRecordsPerFile", most_rows)
            .parquet(path)
        )
    if plain:
        store.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"), True).close()


def load_by_name(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = PARQUET_PATTERN
) -> DataFrame:
    """All files below ``path`` whose path matches, as rows of ``schema``.

    Columns match by name in any case; further columns are ignored, absent ones are NULL.
    """
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .parquet(path)
        .filter(F.col("_metadata.file_path").rlike(f"^{pattern}$"))
    )


def load_into(namespace, table: str, path: str, pattern: str = PARQUET_PATTERN, truncate_first: bool = True) -> DataFrame:
    """Bulk load staged files into an existing table."""
    schema = namespace.table(table).schema
    rows = load_by_name(namespace.spark, path, schema, pattern)
    mode = "overwrite" if truncate_first else "append"
    rows.write.mode(mode).insertInto(namespace.qualified(table))
    return namespace.table(table)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and size of every file below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("NAME"), F.col("length").alias("SIZE"))
    )


@contextlib.contextmanager
def brief_listing(spark: SparkSession) -> Iterator[None]:
    """Readers made meanwhile list their paths in some tasks per core, and their files are not cached.

    By default Spark takes up to 10 000 tasks, one per path. The driver keeps a record of each, and up to
    250 MB of files that were listed.
    """
    wanted = {LIST_TASKS: str(4 * spark.sparkContext.defaultParallelism), LIST_CACHE: "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _passed_over(name: str, folder: bool) -> bool:
    """Whether Spark's readers skip a file or folder of that name."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


ENTRY = "_at string, SIZE long, CHANGED timestamp, _folder boolean"
LISTED = 10_000  # entries of a batch


def _list_folders(path: str) -> Callable:
    """What the folders hold that come as paths relative to ``path``; empty files are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(path)
        root = root.rstrip("/")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(root + folder, allow_not_found=True))
                for start in range(0, len(found), LISTED):
                    rows = []
                    for f in found[start : start + LISTED]:
                        inner = f.type == fs.FileType.Directory
                        if (inner or (f.type == fs.FileType.File and f.size)) and not _passed_over(f.base_name, inner):
                            changed = (f.mtime_ns or 0) // 1_000_000 * 1000  # whole milliseconds, as Hadoop has them
                            rows.append((f"{folder}/{f.base_name}", 0 if inner else f.size, changed, inner))
                    if rows:
                        at, size, changed, inner = zip(*rows)
                        columns = [pa.array(at), pa.array(size, pa.int64()), pa.array(changed, pa.timestamp("us", "UTC")), pa.array(inner)]
                        yield pa.RecordBatch.from_arrays(columns, names=["_at", "SIZE", "CHANGED", "_folder"])

    return run


def files_below(spark: SparkSession, path: str) -> DataFrame:
    """NAME, SIZE and CHANGED of the files below ``path`` that Spark's readers find; contents are not read.

    Tasks list the folders, level by level, and write what they find, so the driver holds no list of files.
    Stores that ``pyarrow.fs`` does not reach, patterns and single files are left to Spark's own listing,
    which gathers all names on the driver.
    """
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    here = target.toUri().getPath()
    try:
        store, root = store_of(path)
        by_tasks = store.get_file_info(root).type == fs.FileType.Directory
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        by_tasks = False
    if not by_tasks or GLOB & set(path) or not root.rstrip("/").endswith(here.strip("/")):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return found.select(
            F.col("path").alias("NAME"), F.col("length").alias("SIZE"), F.col("modificationTime").alias("CHANGED")
        )
    shown = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString().rstrip("/")
    folders, files = spark.createDataFrame([("",)], "_at string"), None
    while True:
        listed, seen = materialize_observed(
            folders.mapInArrow(_list_folders(path), ENTRY), "listed", folders=F.count_if("_folder")
        )
        level = listed.filter("NOT _folder").select(F.concat(F.lit(shown), "_at").alias("NAME"), "SIZE", "CHANGED")
        files = level if files is None else files.unionAll(level)
        n = seen["folders"] or 0
        if not n:
            return files
        folders = listed.filter("_folder").select("_at").repartition(min(n, task_count(spark, n)))
