"""Model artifacts: one file per series, in the folder that the catalog names.

``write_artifacts`` is a data source whose tasks put files into the series' folders, each under a
name of this write alone, and list them in a manifest part per task. Only when all tasks are done
does the driver write one marker that names the manifest parts. Readers go by the marker: a write
that ended midway is invisible, and one that replaces another does so at once. The driver handles
one name per task, never one per series.

``read_artifacts`` reads a whole run, or of it only the series asked for; ``open_artifacts`` opens
the folders that the rows of a catalog name.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

NAME = "tidecast_artifacts"
MARKER, MANIFESTS = "_COMMITTED", "_manifest"
MAGIC = b"TCM1"
SCHEMA = (
    "SERIES string, STAGE_PATH string, ALGORITHM string, FEATURE_COLS array<string>, METRICS string, MODEL_BINARY binary"
)
ARROW = pa.schema([
    ("SERIES", pa.string()), ("STAGE_PATH", pa.string()), ("ALGORITHM", pa.string()),
    ("FEATURE_COLS", pa.list_(pa.string())), ("METRICS", pa.string()), ("MODEL_BINARY", pa.binary()),
])
OPEN_PER_TASK = 2_000  # artifacts opened by one task


class Broken(ValueError):
    """An artifact that is not what was written."""


def packed(series: str, algorithm: str, features: list[str], metrics: str | None, blob: bytes) -> bytes:
    """An artifact's bytes: mark, checksum, size of the header, header, model."""
    header = json.dumps({"series": series, "algorithm": algorithm, "features": features, "metrics": metrics}).encode()
    body = struct.pack("<I", len(header)) + header + blob
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def unpacked(data: bytes, where: str) -> tuple[dict, bytes]:
    if data[:4] != MAGIC or len(data) < 12 or struct.unpack_from("<I", data, 4)[0] != zlib.crc32(data[8:]):
        raise Broken(f"{where} is no artifact or is damaged")
    size = struct.unpack_from("<I", data, 8)[0]
    return json.loads(data[12 : 12 + size]), data[12 + size :]


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; object stores under their usual names."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path)


def put(store: fs.FileSystem, path: str, data: bytes) -> None:
    """Writes a file that is there whole or not at all."""
    written = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(written) as out:
        out.write(data)
    store.move(written, path)


def get(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()


def marker_of(folder: str) -> dict:
    """The marker of the write that counts in a run's folder."""
    store, at = store_of(folder)
    if store.get_file_info(f"{at}/{MARKER}").type != fs.FileType.File:
        raise FileNotFoundError(f"no committed artifacts in {folder}")
    return json.loads(get(store, f"{at}/{MARKER}"))


@dataclass
class Written(WriterCommitMessage):
    part: str
    artifacts: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder, self.write_id = folder, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, at = store_of(self.folder)
        lines = []
        for batch in iterator:
            for row in batch.to_pylist():
                if not row["STAGE_PATH"].startswith(self.folder.rstrip("/") + "/"):
                    raise ValueError(f"{row['STAGE_PATH']} is not in {self.folder}")
                _, path = store_of(row["STAGE_PATH"])
                store.create_dir(path, recursive=True)
                data = packed(row["SERIES"], row["ALGORITHM"], row["FEATURE_COLS"], row["METRICS"], row["MODEL_BINARY"])
                put(store, f"{path}/model-{self.write_id}.bin", data)
                lines.append(json.dumps([row["SERIES"], row["STAGE_PATH"]]))
        task = TaskContext.get()
        part = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.jsonl"
        store.create_dir(f"{at}/{MANIFESTS}/{self.write_id}", recursive=True)
        put(store, f"{at}/{MANIFESTS}/{self.write_id}/{part}", "\n".join(lines).encode())
        return Written(part, len(lines))

    def commit(self, messages: list[Written | None]) -> None:
        store, at = store_of(self.folder)
        parts = [m for m in messages if m is not None]
        store.create_dir(at, recursive=True)
        marker = {"write": self.write_id, "parts": [m.part for m in parts if m.artifacts], "artifacts": sum(m.artifacts for m in parts)}
        put(store, f"{at}/{MARKER}", json.dumps(marker).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, at = store_of(self.folder)
        if store.get_file_info(f"{at}/{MANIFESTS}/{self.write_id}").type == fs.FileType.Directory:
            store.delete_dir(f"{at}/{MANIFESTS}/{self.write_id}")


@dataclass
class _Part(InputPartition):
    name: str
    write_id: str


class _Reader(DataSourceReader):
    """``wanted`` are the series to open, all if it is None.

    It comes as an option: filters that a scan pushes into a reader stay in it for later scans of
    the same DataFrame, which would then lack rows.
    """

    def __init__(self, folder: str, wanted: list[str] | None):
        self.folder, self.wanted = folder, None if wanted is None else set(wanted)

    def partitions(self) -> list[_Part]:
        marker = marker_of(self.folder)
        return [_Part(p, marker["write"]) for p in marker["parts"] or [""]]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, at = store_of(self.folder)
        lines = get(store, f"{at}/{MANIFESTS}/{partition.write_id}/{partition.name}").decode().split("\n")
        for series, path in map(json.loads, lines):
            if self.wanted is None or series in self.wanted:
                yield pa.RecordBatch.from_pylist([_opened(store, path, partition.write_id)], ARROW)


def _opened(store: fs.FileSystem, path: str, write_id: str) -> dict:
    where = f"{store_of(path)[1]}/model-{write_id}.bin"
    head, blob = unpacked(get(store, where), where)
    return {
        "SERIES": head["series"], "STAGE_PATH": path, "ALGORITHM": head["algorithm"], "FEATURE_COLS": head["features"],
        "METRICS": head["metrics"], "MODEL_BINARY": blob,
    }


class ArtifactSource(DataSource):
    """Options: path, the folder of one run; series, a JSON list of those to read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        wanted = self.options.get("series")
        return _Reader(self.options["path"], None if wanted is None else json.loads(wanted))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(ArtifactSource)
    return spark


def write_artifacts(models: DataFrame, entries: DataFrame, folder: str, grain: str) -> None:
    """Puts the models of a run into the folders that the catalog rows ``entries`` name.

    ``folder`` holds them all. Artifacts of an earlier write to it no longer count.
    """
    _registered(models.sparkSession)
    paths = entries.select(F.col(grain).alias("_series"), "STAGE_PATH")
    rows = models.join(paths, F.col(grain) == F.col("_series")).select(
        F.col(grain).cast("string").alias("SERIES"), "STAGE_PATH", "ALGORITHM", "FEATURE_COLS",
        F.to_json("METRICS").alias("METRICS"), "MODEL_BINARY",
    )
    rows.write.format(NAME).mode("append").save(folder)


def read_artifacts(spark: SparkSession, folder: str, series: list[str] | None = None) -> DataFrame:
    """The artifacts of one run, or of the ``series`` named; other files are not opened."""
    reader = _registered(spark).read.format(NAME)
    if series is not None:
        reader = reader.option("series", json.dumps(series))
    return reader.load(folder)


def _open(on_missing: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writes: dict[str, str] = {}
        for batch in batches:
            for k, path in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                row = batch.slice(k, 1)
                folder = path.rpartition("/")[0]
                found = dict.fromkeys(["ALGORITHM", "FEATURE_COLS", "METRICS", "MODEL_BINARY"])
                try:
                    if folder not in writes:
                        writes[folder] = marker_of(folder)["write"]
                    found = _opened(store_of(path)[0], path, writes[folder])
                except FileNotFoundError:
                    if on_missing == "error":
                        raise FileNotFoundError(f"the catalog names {path}, but there is no artifact") from None
                made = [pa.array([found[c]], ARROW.field(c).type) for c in ("ALGORITHM", "FEATURE_COLS", "METRICS", "MODEL_BINARY")]
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, *made], names=[*row.schema.names, "ALGORITHM", "FEATURE_COLS", "METRICS", "MODEL_BINARY"]
                )

    return run


def open_artifacts(entries: DataFrame, grain: str, on_missing: str = "error", keep: tuple[str, ...] = ()) -> DataFrame:
    """grain, STAGE_PATH, the columns ``keep`` and the model of every catalog row, loaded from the path in it.

    ``on_missing='drop'`` leaves MODEL_BINARY null where no artifact lies, which scoring treats as
    no model; otherwise that is an error.
    """
    if on_missing not in ("error", "drop"):
        raise ValueError("on_missing must be 'error' or 'drop'")
    rows = entries.select(grain, *keep, "STAGE_PATH")
    tasks = rows.count() // OPEN_PER_TASK + 1
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema = f"{own}, ALGORITHM string, FEATURE_COLS array<string>, METRICS string, MODEL_BINARY binary"
    spread = rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInArrow(_open(on_missing), schema)
