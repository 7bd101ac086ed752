"""Near duplicates by SimHash fingerprints, searched in BK-trees.

A fingerprint bit is 1 if more than half of a text's shingle hashes have it. Distinct
fingerprints are dealt to shards by some of their bits; every shard is a BK-tree, whose children
hang on edges named by their Hamming distance from the parent, and a search follows only edges
within the radius of its own distance. Trees of many small shards are grown and searched
together as arrays. A shard beyond SHARD_ROWS is cut into several trees, and each of these goes
to the tasks that search the other parts. A task reports, for what its trees connect, one link
per fingerprint, never all pairs.

With few differing bits the shards are exact: of radius + 1 blocks one has to be equal. For
wide radii they are samples of bits, in so many tables that pairs at the radius are met with
probability RECALL at least.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.jaccard_join import set_groups, text_key
from tidecast.llm.links import Sets, components
from tidecast.llm.spread import attach, one_each
from tidecast.llm.words import in_pieces
from tidecast.session import materialize, materialize_observed

SEED = 42
EXACT_RADIUS = 3
SHARD_ROWS = 20_000
RECALL = 0.99
KEPT_APART = (4, 5)  # texts of a smaller Jaccard similarity are no near duplicates
STEP = 1 << 18  # pairs of search and node looked at together
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, words: int = 3, width: int = 64) -> bytes:
    """Big-endian fingerprint of ``width`` bits; zero if there is no word."""
    parts = text.lower().split()  # A-Z only, and exactly the six ASCII spaces
    out = b""
    n = max(1, len(parts) - words + 1) if parts else 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    first = np.cumsum(sizes) - sizes
    ends = (first + sizes - 1)[words - 1 :] if len(parts) > words else np.array([len(joined)])
    spans = list(zip(first[:n].tolist(), ends.tolist())) if n else []
    for seed in range(SEED, SEED + width // 64):
        if not n:
            out += bytes(8)
            continue
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64).view(np.uint8).reshape(-1, 8)
        bits = [np.bincount(hashes[:, k], minlength=256) @ _BITS for k in range(8)]
        ones = np.concatenate(bits) * 2 > n
        out += np.packbits(ones, bitorder="little").tobytes()[::-1]
    return out


def _fingerprints(text: str, words: int, width: int, fields: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, text):
            at = batch.schema.get_field_index(text)
            prints = [fingerprint((t or "").encode(), words, width) for t in batch.column(at).to_pylist()]
            kept = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(prints, pa.binary())], names=fields)

    return run


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, words: int, width: int) -> DataFrame:
    """_id and _print of every row; a null text counts as empty."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    run = _fingerprints("_text", words, width, ["_id", "_print"])
    return rows.mapInArrow(run, f"_id {kind}, _print binary")


def _tables(n: int, width: int, radius: int) -> list[list[int]]:
    """Bits whose values name the shard of a fingerprint, for each table."""
    if radius <= EXACT_RADIUS:
        cuts = [width * k // (radius + 1) for k in range(radius + 2)]
        return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]
    bits = min(width - radius, max(12, math.ceil(math.log2(max(n, 2)))))
    met = math.comb(width - radius, bits) / math.comb(width, bits)  # bits are drawn without repeats
    count = math.ceil(math.log(1 - RECALL) / math.log(1 - met))
    draw = np.random.default_rng(SEED)
    return [sorted(draw.choice(width, bits, replace=False).tolist()) for _ in range(count)]


def _deal(tables: list[list[int]]) -> Callable:
    """Each fingerprint once for every table, with the shard it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                prints = batch.column(0).to_pylist()
                if not prints:
                    continue
                bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
                for t, picked in enumerate(tables):
                    scale = np.uint64(1) << np.arange(len(picked), dtype=np.uint64)
                    key = (bits[:, picked].astype(np.uint64) * scale).sum(axis=1, dtype=np.uint64)
                    shard = key * np.uint64(len(tables)) + np.uint64(t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.view(np.int64)), batch.column(0)], names=["shard", "_print"]
                    )

    return run


class Forest:
    """BK-trees over the ``rows`` of ``words`` (64-bit words of each print), one per shard.

    ``shard`` has the shard of each of the rows, in rising order.
    """

    def __init__(self, words: np.ndarray, rows: np.ndarray, shard: np.ndarray):
        self.words, self.bits = words, words.shape[1] * 64 + 1
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        self.shards, self.roots = shard[starts], rows[starts]
        keys, children = [], []
        group = shard
        while len(rows):
            first = np.r_[True, group[1:] != group[:-1]]
            starts = np.flatnonzero(first)
            if group is not shard:
                keys.append(group[starts])
                children.append(rows[starts])
            node = np.repeat(rows[starts], np.diff(np.r_[starts, len(rows)]))[~first]
            rows = rows[~first]
            edges = node * self.bits + self.distance(rows, node)
            order = np.argsort(edges, kind="stable")
            rows, group = rows[order], edges[order]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.words[a] ^ self.words[b]).sum(axis=1, dtype=np.int64)

    def near(self, asks: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of one of ``asks`` and a row of its shard's tree within the radius, in portions."""
        node = self.roots[np.searchsorted(self.shards, shard)]
        stack = [(asks[i : i + STEP], node[i : i + STEP]) for i in range(0, len(asks), STEP)]
        while stack:
            ask, node = stack.pop()
            far = self.distance(ask, node)
            hit = (far <= radius) & (ask != node)
            if hit.any():
                yield ask[hit], node[hit]
            low = np.searchsorted(self.keys, node * self.bits + np.maximum(far - radius, 0), "left")
            high = np.searchsorted(self.keys, node * self.bits + np.minimum(far + radius, self.bits - 1), "right")
            more = high - low
            some = more > 0
            ask, low, more = ask[some], low[some], more[some]
            if len(ask):
                before = np.cumsum(more) - more
                child = self.children[np.arange(int(more.sum())) - np.repeat(before - low, more)]
                ask = np.repeat(ask, more)
                stack += [(ask[i : i + STEP], child[i : i + STEP]) for i in range(0, len(ask), STEP)]


BOTH, TREE, ASKS = 0, 1, 2  # roles of a print in a task


def _links(table: pa.Table, radius: int) -> pa.RecordBatch:
    """One link per print to the set it belongs to; rows in order of task and role."""
    table = table.combine_chunks()
    task, role = table["task"].to_numpy(), table["role"].to_numpy()
    prints = table["_print"].to_pylist()
    words = np.frombuffer(b"".join(prints), ">u8").astype(np.uint64).reshape(len(prints), -1)
    tree, asks = np.flatnonzero(role != ASKS), np.flatnonzero(role != TREE)
    sets = Sets(len(prints))
    for a, b in Forest(words, tree, task[tree]).near(asks, task[asks], radius):
        sets.unite(a, b)
    up = sets.names()
    moved = np.flatnonzero(up != np.arange(len(up))).tolist()
    ends = [[prints[i] for i in moved], [prints[up[i]] for i in moved]]
    return pa.RecordBatch.from_arrays([pa.array(e, pa.binary()) for e in ends], names=["a", "b"])


def _search(radius: int) -> Callable:
    """Searches the shards of a partition, several small ones at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * SHARD_ROWS:
                whole = pa.Table.from_batches(held).combine_chunks()
                tasks = whole["task"].to_numpy()
                cut = int(np.searchsorted(tasks, tasks[-1], "left"))  # the last may go on
                if cut:
                    yield _links(whole.slice(0, cut), radius)
                held, rows = whole.slice(cut).to_batches(), len(whole) - cut
        if rows:
            yield _links(pa.Table.from_batches(held), radius)

    return run


def link(prints: DataFrame, n: int, width: int, radius: int) -> DataFrame:
    """Links a, b that connect all of the distinct ``_print`` within the radius of each other."""
    tables = _tables(n, width, radius)
    dealt = prints.select("_print").mapInArrow(_deal(tables), "shard long, _print binary")
    large = (
        dealt.groupBy("shard")
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > SHARD_ROWS)
        .select(F.col("shard").alias("_shard"), F.ceil(F.col("_rows") / SHARD_ROWS).cast("int").alias("_parts"))
    )
    large, seen = materialize_observed(large, "large-shards", n=F.count("*"))
    tasks = dealt.select(F.col("shard").alias("task"), F.lit(BOTH).alias("role"), "_print")
    if seen["n"]:
        cut = dealt.join(large, F.col("shard") == F.col("_shard"), "left").withColumn(
            "_part", F.pmod(F.xxhash64("_print"), F.coalesce("_parts", F.lit(1))).cast("int")
        )
        cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        own, other = F.col("_part"), F.col("_other")
        role = F.when(own == other, BOTH).when(own < other, TREE).otherwise(ASKS)
        name = F.xxhash64("shard", F.least(own, other), F.greatest(own, other))
        task = F.when(F.col("_parts").isNull(), F.col("shard")).otherwise(name)
        tasks = cut.select(task.alias("task"), role.alias("role"), "_print")
    return (
        tasks.repartition("task")
        .sortWithinPartitions("task", "role", "_print")
        .mapInArrow(_search(radius), "a binary, b binary")
    )


def groups(
    docs: DataFrame, id_col: str, text_col: str, words: int, width: int, radius: int
) -> tuple[DataFrame, DataFrame, int]:
    """Rows (_id, _print), groups (_print, n, component_id), and the number of rows."""
    rows, seen = materialize_observed(
        with_fingerprint(docs, id_col, text_col, words, width), "prints", n=F.count("*")
    )
    prints, distinct = materialize_observed(
        rows.groupBy("_print").agg(F.count("*").alias("n"), F.min("_id").alias("_first")),
        "distinct-prints",
        n=F.count("*"),
    )
    roots = components(link(prints, distinct["n"] or 0, width, radius))
    placed = prints.join(roots, F.col("_print") == F.col("node"), "left").withColumn(
        "_root", F.coalesce("root", "_print")
    )
    least = placed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = placed.select("_print", "n", F.col("_root").alias("_r")).join(least, F.col("_r") == F.col("_root"))
    return rows, materialize(named.select("_print", "n", "component_id"), "components"), seen["n"] or 0


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, width: int = 64, radius: int = 3
) -> DataFrame:
    """id_col, fingerprint and component_id, the smallest id reachable over links, per row.

    A null or empty text has fingerprint zero; rows with equal fingerprints are linked. Null ids
    are never the smallest unless a component has no other. Repeated rows give repeated rows, an
    empty table none; other columns are ignored.
    """
    rows, found, total = groups(docs, id_col, text_col, words, width, radius)
    return attach(rows, found, "_print", total, "_id").select(
        F.col("_id").alias(id_col), F.lower(F.hex("_print")).alias("fingerprint"), "component_id"
    )


def set_print(found: np.ndarray) -> bytes:
    """Fingerprint of 64 bits of a set, from the hashes of its shingles."""
    if not len(found):
        return bytes(8)
    hashes = found.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(hashes[:, k], minlength=256) @ _BITS for k in range(8)]) * 2 > len(found)
    return np.packbits(ones, bitorder="little").tobytes()[::-1]


def tree_leads(sets: DataFrame) -> DataFrame:
    """a and b: each set (_doc, _print) that searches of the trees connect with a smaller one, the lead."""
    prints, seen = materialize_observed(
        sets.groupBy("_print").agg(F.count("*").alias("n"), F.min("_doc").alias("_first")), "set-prints", n=F.count("*")
    )
    roots = components(link(prints, seen["n"] or 0, 64, EXACT_RADIUS))
    placed = prints.join(roots, F.col("_print") == F.col("node"), "left").withColumn("_root", F.coalesce("root", "_print"))
    lead = placed.groupBy("_root").agg(F.min("_first").alias("_lead"))
    placed = placed.select(F.col("_print").alias("_p"), "n", F.col("_root").alias("_r")).join(lead, F.col("_r") == F.col("_root"))
    total = sets.count()
    found = attach(sets, placed.select(F.col("_p").alias("_print"), "n", "_lead"), "_print", total, "_doc")
    return found.filter("_doc != _lead").select(F.col("_doc").alias("a"), F.col("_lead").alias("b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one with the smallest
    id, of several with this id the one with the smallest hash.

    Two texts are linked if the Jaccard similarity of their shingle sets is 0.8 or more, and all
    that links lead to are one group. BK-trees of fingerprints of the sets find a lead for nearly
    equal ones, as 64 bits of sets at the threshold differ in about ten places and the trees search
    EXACT_RADIUS. Sets are compared exactly, and all other pairs are found by the set join. Texts
    without a word are never near duplicates of each other.
    """
    sets, groups, total = set_groups(docs, id_col, text_col, words, KEPT_APART, set_print, tree_leads)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(F.col(id_col).alias("_id"), text_key(text_col).alias("_key"), whole)
    named = groups.select(F.col("_set").alias("_s"), "component", "component_id")
    filled = sets.filter("_size > 0")
    found = filled.groupBy("_key", "_set").agg(F.count("*").alias("n")).join(named, F.col("_set") == F.col("_s"))
    stay = attach(rows, found.select("_key", "n", "component", "component_id"), "_key", total, "_id").filter(
        F.col("_id").eqNullSafe(F.col("component_id")) | F.col("n").isNull()
    )
    ids = filled.groupBy("_set", "_id").agg(F.count("*").alias("_k"))
    again = ids.join(named, (F.col("_set") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("component_id")))
    again = again.groupBy("component").agg(F.sum("_k").alias("_k")).filter("_k > 1").select("component")
    return one_each(stay.select("component", "_row"), "component", again).select("_row.*")
