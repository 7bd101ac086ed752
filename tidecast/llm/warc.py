"""Deterministic sharded WARC archives.

Records are range-sorted by id. The bounds come from ids chosen by their hash, so they depend on
the data alone; ids that are null are spread over all shards and come last in each. A task
writes its shard, one gzip member per record, and begins a new file when the compressed size
of one reaches the limit. Files get temporary names that tell attempts apart, and a manifest
of the attempts that Spark accepted. Only these are renamed, and only the final manifest makes
them an archive, so lost or repeated tasks leave nothing behind that is read.

Of equal payloads the smallest id is a response, all others revisit it. That is decided on ids
and hashes alone; the decisions are sorted in between the pages, so payloads are shuffled once.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm.spread import attach
from tidecast.llm.words import in_pieces
from tidecast.session import materialize, materialize_observed

SHARD_BYTES = 32 << 20  # of payload
ROLL_BYTES = 8 << 20  # compressed
SAMPLED = 64  # ids for each bound
DATE = "2024-01-01T00:00:00Z"  # the tables have no time of capture
# Names of the public WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
NAME = "<urn:page:%s>"

MANIFEST = "shard int, number int, name string, written string, records long, bytes long, sha256 string"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time stamp."""
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", "sha1:" + sha1(block))]
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page: str | None, url: str | None, payload: bytes, response: str | None) -> bytes:
    """A response, or a revisit of the page ``response``."""
    digest = sha1(payload)
    name = quote(page, safe="") if page is not None else "none:" + digest
    fields = [("WARC-Record-ID", NAME % name), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields += [("WARC-Payload-Digest", "sha1:" + digest), ("Content-Type", "application/http;msgtype=response")]
    head = HTTP % len(payload)
    if response is None:
        return record("response", fields, head + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", NAME % quote(response, safe=""))]
    return record("revisit", fields, head)


@dataclass
class Roller:
    """Writes the files of one shard under temporary names."""

    folder: str
    shard: int
    attempt: str
    roll: int
    number: int = 0
    out: pa.NativeFile | None = None

    def add(self, data: bytes) -> None:
        if self.out is None:
            store, root = fs.FileSystem.from_uri(self.folder)
            store.create_dir(root, recursive=True)
            self.name = f"part-{self.shard:06d}-{self.number:06d}.warc.gz"
            self.written = f"{self.name}.{self.attempt}.tmp"
            self.out = store.open_output_stream(f"{root}/{self.written}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = f"software: tidecast\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
            fields = [("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", DATE)]
            self._write(record("warcinfo", [*fields, ("Content-Type", "application/warc-fields")], info))
        self._write(data)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self.out.close()
        row = (self.shard, self.number, self.name, self.written, self.records, self.size, self.sha.hexdigest())
        self.out, self.number = None, self.number + 1
        return [row]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [[]] * len(kinds)
    names = [f.split(" ")[0] for f in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _write_shards(folder: str, roll: int) -> Callable:
    """Rows in order of shard and id; the decision about a page comes before the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().stageId()}-{TaskContext.get().taskAttemptId()}"
        roller, last, response = None, None, None
        for batch in in_pieces(batches, "_html"):
            rows = []
            for shard, page, key, is_page, first, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if roller is None or roller.shard != shard:
                    rows += roller.close() if roller else []
                    roller = Roller(folder, shard, attempt, roll)
                if (page, key) != last:
                    last, response = (page, key), None
                if not is_page:
                    response = first
                    continue
                roller.add(page_record(page, url, (html or "").encode(), response))
                if roller.size >= roll:
                    rows += roller.close()
            if rows:
                yield _table(rows)
        if roller:
            yield _table(roller.close())

    return run


def _rename(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, written in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                waiting, done = store.get_file_info([f"{root}/{written}", f"{root}/{name}"])
                if waiting.type == fs.FileType.File:
                    store.move(waiting.path, done.path)
                elif done.type != fs.FileType.File:
                    raise FileNotFoundError(f"neither {written} nor {name} is in {folder}")
            yield batch

    return run


def _bounds(ids: DataFrame, rows: int, shards: int) -> list:
    """Rising ids that cut the table into shards, from a share of the ids chosen by hash.

    An id comes to the driver once, with the count of its rows.
    """
    if shards < 2:
        return []
    one_in = max(1, rows // (shards * SAMPLED))
    sampled = ids.filter(F.col("_id").isNotNull() & (F.pmod(F.xxhash64("_id"), F.lit(one_in)) == 0))
    found = sampled.groupBy("_id").agg(F.count("*").alias("_n")).orderBy("_id").collect()
    through = list(accumulate(r["_n"] for r in found))
    return sorted({found[bisect.bisect_right(through, through[-1] * k // shards)][0] for k in range(1, shards)}) if found else []


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes a record per row into ``folder``, a new one in a store that all executors reach, and
    returns the manifest.

    A payload is revisited if it has ``least`` bytes or more. Rows that share the smallest id of
    their payload are all responses. A null id cannot be referred to: equal payloads without
    any id are all responses. A null html is an empty payload, a null url no URI.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.sha2(html, 256).alias("_key"),
        F.col(url_col).cast("string").alias("_url"),
        html.alias("_html"),
    )
    ids, seen = materialize_observed(
        rows.select("_id", "_key", F.octet_length("_html").cast("long").alias("_size")),
        "payloads", n=F.count("*"), total=F.sum("_size"),
    )
    n, total = seen["n"] or 0, seen["total"] or 0
    bounds = _bounds(ids, n, max(1, -(-total // shard_bytes)))
    shards = len(bounds) + 1

    groups = ids.filter(F.col("_size") >= least).groupBy("_key").agg(F.min("_id").alias("_first"), F.count("*").alias("n"))
    decided = attach(ids.select("_id", "_key"), materialize(groups, "payload-groups"), "_key", n, "_id").filter(
        F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    )

    def place(page: pa.Array) -> pa.Array:
        found = [None if i is None else bisect.bisect_right(bounds, i) for i in page.to_pylist()]
        return pa.array(found, pa.int32())

    place.__annotations__ = {"page": pa.Array, "return": pa.Array}
    spread = F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int")
    shard = F.coalesce(F.arrow_udf(place, "int")("_id"), spread) if bounds else F.lit(0)
    empty = F.lit(None).cast("string")
    both = rows.select("_id", "_key", F.lit(1).alias("_page"), empty.alias("_first"), "_url", "_html").unionAll(
        decided.select(
            "_id", "_key", F.lit(0).alias("_page"), F.col("_first").cast("string"), empty.alias("_url"), empty.alias("_html")
        )
    )
    staged = materialize(
        both.select(shard.alias("_shard"), "*")
        .repartitionById(shards, F.col("_shard"))
        .sortWithinPartitions("_shard", F.col("_id").asc_nulls_last(), "_key", "_page", "_url")
        .withColumn("_id", F.col("_id").cast("string"))
        .mapInArrow(_write_shards(folder, roll_bytes), MANIFEST),
        "staged-archives",
    )
    spark = pages.sparkSession
    files = max(1, min(staged.count(), 4 * spark.sparkContext.defaultParallelism))
    staged.repartition(files).mapInArrow(_rename(folder), MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that make up the archive in ``folder``."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed stream."""
    while version := stream.readline():
        if version.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {version!r}")
        fields = {}
        while (line := stream.readline().strip()) != b"":
            key, _, value = line.partition(b": ")
            fields[key.decode()] = value.decode()
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or fields["WARC-Block-Digest"] != "sha1:" + sha1(block):
            raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
        yield fields, block


def _page(name: str) -> str | None:
    inside = name.removeprefix("<urn:page:").removesuffix(">")
    return None if inside.startswith("none:") else unquote(inside)


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    for fields, block in parse(gzip.GzipFile(fileobj=raw)):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(head.rpartition(b"Content-Length: ")[2])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response" and (len(payload) != size or sha1(payload) != digest):
                            raise ValueError(f"damaged payload in {name}")
                        to = fields.get("WARC-Refers-To")
                        rows.append((_page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], to and _page(to)))
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, READ_TYPES)], names=READ)

    return run


READ = ["_id", "payload_bytes", "payload_digest", "record_type", "_to"]
READ_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())


def read_archives(spark: SparkSession, folder: str, id_col: str = "page_id", id_type: str = "long") -> DataFrame:
    """id_col, payload_bytes, payload_digest, record_type and refers_to of every record.

    Every digest is checked; a damaged record is an error. Files are read as streams.
    """
    files = manifest(spark, folder).select("name")
    tasks = max(1, min(files.count(), 100_000))
    found = files.repartition(tasks, "name").mapInArrow(
        _read(folder), "_id string, payload_bytes long, payload_digest string, record_type string, _to string"
    )
    return found.select(
        F.col("_id").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("_to").cast(id_type).alias("refers_to"),
    )
