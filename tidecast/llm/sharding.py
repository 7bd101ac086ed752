"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Equal texts form one group that is never divided. A partial partition is one sum of bytes per
shard; the two with the largest spread are combined, the largest sum of one with the smallest
of the other, until one is left. Groups too large to be evened out inside a task, of which there
is a fixed number at most, are differenced first. Their uneven sums then enter every bin of the
other groups as a partial partition of its own, in equal parts, so each bin fills the same gaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.spread import attach, number_rows
from tidecast.session import materialize_observed

LARGE = 5_000  # a group with over one part in so many of all bytes is large
BIN = 10_000  # groups differenced in one task


def difference(sizes: list[int], shards: int, base: list[float] | None = None) -> list[int]:
    """Shard of each size; with ``base`` the sums that the shards already hold, by number."""
    # A node is a partial partition: its sums in rising order, and what it was made of.
    spreads: list[tuple[float, int]] = []
    sums: list[list[float]] = []
    inside: list[tuple] = []

    def push(parts: list[float], made_of: tuple) -> None:
        sums.append(parts)
        inside.append(made_of)
        heapq.heappush(spreads, (parts[0] - parts[-1], len(sums) - 1))

    order = sorted(range(shards), key=lambda k: base[k]) if base else []
    for i, size in enumerate(sizes):
        push([0] * (shards - 1) + [size], (i,))
    if base:
        push([base[k] for k in order], (-1,))
    while len(spreads) > 1:
        a, b = heapq.heappop(spreads)[1], heapq.heappop(spreads)[1]
        # The largest of one meets the smallest of the other.
        both = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        place = sorted(range(shards), key=both.__getitem__)
        push([both[k] for k in place], (a, b, place))
    return _labels(inside, len(sizes), shards, order)


def _labels(inside: list[tuple], n: int, shards: int, order: list[int]) -> list[int]:
    """Follows the parts of the last node down to the sizes."""
    out = [0] * n
    if not inside:
        return out
    label = {len(inside) - 1: list(range(shards))}  # of each part of a node, the final one
    named: list[int] | None = None
    for node in range(len(inside) - 1, -1, -1):
        own = label.pop(node)
        made_of = inside[node]
        if len(made_of) == 1:
            if made_of[0] < 0:
                named = [0] * shards
                for part, final in enumerate(own):
                    named[final] = order[part]
            else:
                out[made_of[0]] = own[-1]
            continue
        a, b, place = made_of
        of_a, of_b = [0] * shards, [0] * shards
        for part, k in enumerate(place):
            of_a[k] = own[part]
            of_b[shards - 1 - k] = own[part]
        label[a], label[b] = of_a, of_b
    return [named[k] for k in out] if named else out


def shard_bin(shards: int, base: list[float]) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_bytes", "descending"), ("_key", "ascending")])
        found = difference(rows["_bytes"].to_pylist(), shards, base)
        return rows.select(["_key", "n"]).append_column("shard", pa.array(found, pa.int32()))

    return run


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) per row.

    The size of a row is the UTF-8 bytes of its text plus 1. Null and empty texts are one group.
    Rows of a shard are numbered by id, null first, and text, without gaps. An empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("_key"),
    )
    groups, seen = materialize_observed(
        rows.groupBy("_key").agg(F.count("*").alias("n"), F.sum("size").alias("_bytes")),
        "text-groups",
        rows=F.sum("n"),
        groups=F.count("*"),
        total=F.sum("_bytes"),
    )
    n_rows, n_groups, total = seen["rows"] or 0, seen["groups"] or 0, seen["total"] or 0
    is_large = F.col("_bytes") * LARGE > total
    large = sorted(groups.filter(is_large).collect(), key=lambda r: (-r["_bytes"], bytes(r["_key"])))
    placed = difference([r["_bytes"] for r in large], shards)
    held = [0] * shards
    for r, k in zip(large, placed):
        held[k] += r["_bytes"]
    bins = max(1, -(-n_groups // BIN))
    few = spark.createDataFrame(
        [(r["_key"], r["n"], k) for r, k in zip(large, placed)], "_key binary, n long, shard int"
    )
    rest = (
        groups.filter(~is_large)
        .withColumn("_bin", F.pmod(F.xxhash64("_key"), F.lit(bins)))
        .groupBy("_bin")
        .applyInArrow(shard_bin(shards, [h / bins for h in held]), few.schema)
    )
    found, _ = materialize_observed(rest.unionAll(few), "group-shards", n=F.count("*"))
    placed_rows = attach(rows, found, "_key", n_rows, "_id", "size").drop("n", "_key")
    numbered = number_rows(placed_rows, n_rows, "shard", "_id", "text_crc32", "size")
    starts, first = [], 0
    for r in found.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect():
        starts.append((r["shard"], first))
        first += r["n"]
    return numbered.join(
        F.broadcast(spark.createDataFrame(starts, "shard int, _first long")), "shard"
    ).select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_no") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
