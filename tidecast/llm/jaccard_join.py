"""Documents whose n-gram sets have a Jaccard similarity of at least a threshold, by set relations.

A set is indexed under its prefix only: of its shingles, rarest first, so many that two similar
sets share one at least. How rare a shingle is tells a table of SKETCH counters that covers all
documents; any order would be right, this one keeps the lists short. Relations between sets then
save most of the work:

* A list names a lead, the set in which its shingle comes first: that set has the fewest shingles
  of its own. Every set is compared with the lead that it meets most often and joins its cluster;
  if it is nearly the same set, it becomes a follower and is no longer searched for itself. Sets
  that are not similar to their lead name leads among themselves once more.
* Answers within a cluster derive from the comparisons with the lead. Two members share what they
  kept of the lead, at most the lesser of both, and what they have in common beyond it. So two
  members can only be similar if both kept enough, which their sizes and what they kept tell, or
  if lists of the shingles beyond the lead say that they have enough of these in common.
* What is left are pairs of classes (a lead and its followers) of different clusters that lists
  have in common. A list is cut into blocks of equal size and position, and a pair of blocks is
  skipped as a whole if their sizes or positions allow no similar pair. Shared shingles are counted
  per pair of classes, and the leads are compared only if there are enough of them. Where lists are
  long, a class that is in fewer lists than any partner asks for leaves all of them, which shortens
  the lists for the others, and so on. Two followers share at most what the leads share plus what
  each has beyond its lead; only where that suffices are they compared.

Each comparison of two sets is exact. Sets that links connect are one component, so a list whose
sets are connected already needs no further look. Shingles are told apart by hashes of 64 bits,
texts and sets by MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.links import components
from tidecast.llm.spread import attach
from tidecast.llm.words import in_pieces, mix, text_bytes, word_hashes, word_spans
from tidecast.session import materialize, materialize_observed

SIMILAR = (85, 100)  # least intersection and union
SAME = (95, 100)  # of a follower and its lead
MET = 0.7
SKETCH_BITS = 22
CHUNKS = 64  # parts of the table of counters
FAN_IN = 64  # tables summed up in one group
STEPS_PER_DOUBLING = 8  # of a counter, until it has the next rank
LIST_ROWS = 5_000  # beyond it a list is cut
PAIRS_PER_COPY = 500  # comparisons that share one copy of a set
BROADCAST_ROWS = 500_000
PAIRS_PER_ENTRY = 20  # in lists; beyond it, entries that can have no similar partner are looked for
ROUNDS = 12  # of that search
PIECE_BYTES = 1 << 20
STEP = 1 << 18  # pairs looked at together

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Rising hashes of the distinct shingles of each text; a text of fewer words is one shingle."""
    raw, at = text_bytes(texts)
    raw = _LOWER[raw]
    first, end, before = word_spans(raw, at)
    hashes = word_hashes(raw, first, end)
    windows = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        windows = windows * _PLACE + hashes[k : len(hashes) - words + 1 + k]
    windows = mix(windows)
    out = []
    for a, b in zip(before.tolist(), before[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(windows[a : b - words + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                whole = whole * _PLACE + h
            out.append(mix(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def small(stored: DataFrame) -> DataFrame:
    """A stored table, marked to be sent to all tasks if it has no more than BROADCAST_ROWS narrow rows."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def text_key(column: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")))


# How much similar sets share


def least_shared(a, b, similar: tuple[int, int]):
    """Shingles that sets of sizes a and b share at least if they are similar."""
    least, of = similar
    return -(-least * (a + b) // (least + of))


def beyond_prefix(size, similar: tuple[int, int]):
    """Shingles of a set that are not in its prefix."""
    least, of = similar
    return -(-least * size // of) - 1


def is_similar(shared: Column, a: Column, b: Column, similar: tuple[int, int]) -> Column:
    least, of = similar
    return shared * of >= least * (a + b - shared)


# Counters of all shingles


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _packed(group: int, counts: np.ndarray) -> pa.RecordBatch:
    parts = [pa.compress(c.astype(np.uint64).tobytes(), "zstd", asbytes=True) for c in np.split(counts, CHUNKS)]
    columns = [pa.array([group] * CHUNKS, pa.int64()), pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["_group", "_chunk", "_counts"])


def _unpacked(counts: bytes) -> np.ndarray:
    size = 8 * (1 << SKETCH_BITS) // CHUNKS
    return np.frombuffer(pa.decompress(counts, size, "zstd", asbytes=True), np.uint64)


def _count(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in in_pieces(batches, "_text", PIECE_BYTES):
            for found in shingle_sets(batch.column(0), words):
                np.add.at(counts, _bucket(found), np.uint32(1))
        yield _packed(TaskContext.get().partitionId() // FAN_IN, counts)

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(_unpacked(c) for c in table["_counts"].to_pylist())
    whole = pa.compress(total.tobytes(), "zstd", asbytes=True)
    return pa.table([table["_group"][:1], table["_chunk"][:1], pa.array([whole], pa.binary())], names=table.column_names)


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [rank_of(_unpacked(c)).tobytes() for c in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["_chunk", "_ranks"])


def rank_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(255, STEPS_PER_DOUBLING * np.log2(1.0 + count)).astype(np.uint8)


def rarity(texts: DataFrame, words: int) -> np.ndarray:
    """The rank of each counter: one byte for each, however many documents there are."""
    schema = "_group long, _chunk int, _counts binary"
    tables = texts.select("_text").mapInArrow(_count(words), schema)
    while True:
        summed = tables.groupBy("_group", "_chunk").applyInArrow(_add, schema)
        tables, seen = materialize_observed(summed, "shingle-counts", most=F.max("_group"))
        if not seen["most"]:
            break
        tables = tables.withColumn("_group", F.floor(F.col("_group") / FAN_IN))
    rows = tables.select("_chunk", "_counts").mapInArrow(_ranked, "_chunk int, _ranks binary").collect()
    ranks = {r["_chunk"]: r["_ranks"] for r in rows}
    empty = bytes((1 << SKETCH_BITS) // CHUNKS)
    return np.frombuffer(b"".join(ranks.get(k, empty) for k in range(CHUNKS)), np.uint8)


# Sets and their index


def _described(words: int, similar: tuple[int, int], ranks: np.ndarray, digest: Callable[[np.ndarray], bytes]) -> Callable:
    def prefix(found: np.ndarray) -> bytes:
        if not len(found):
            return b""
        order = np.argsort(ranks[_bucket(found)], kind="stable")
        return found[order[: len(found) - beyond_prefix(len(found), similar)]].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text", PIECE_BYTES):
            sets = shingle_sets(batch.column(2), words)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([prefix(s) for s in sets], pa.binary()),
                pa.array([digest(s) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_key", "_set", "_size", "_prefix", "_print"])

    return run


def _postings(ranks: np.ndarray, only_common: bool) -> Callable:
    """One row per shingle of a prefix; or those alone whose lists may be long."""
    common = rank_of(np.array([LIST_ROWS]))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                heads = [np.frombuffer(p, np.uint64) for p in batch.column(2).to_pylist()]
                if not heads:
                    continue
                counts = [len(h) for h in heads]
                row, values = np.repeat(np.arange(len(heads)), counts), np.concatenate(heads)
                place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
                if only_common:
                    some = ranks[_bucket(values)] >= common
                    row, values, place = row[some], values[some], place[some]
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(place)],
                    names=["_h", "_doc", "_size", "_pos"],
                )

    return run


POSTING = "_h long, _doc long, _size long, _pos long"


def _whole_lists(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Portions of a sorted partition that end where a list ends."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            whole = pa.Table.from_batches(held).combine_chunks()
            same = np.ones(n, bool)
            for k in keys:
                column = whole[k].to_numpy()
                same &= column == column[-1]
            cut = n - int(same[::-1].argmin()) if not same.all() else 0
            if cut:
                yield whole.slice(0, cut)
            held, n = whole.slice(cut).to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _ends(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, with the end of the last."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.r_[np.flatnonzero(new), len(new)]


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of lists that have several, with the first set of the list and its size.

    Lists come in order of position.
    """
    for table in _whole_lists(batches, ["_h", "_part"]):
        lists, parts = table["_h"].to_numpy(), table["_part"].to_numpy()
        at = _ends(lists, parts)
        n = np.diff(at)
        kept = np.repeat(n > 1, n) | (table["_parts"].to_numpy() > 1)
        lead = pa.array(np.repeat(at[:-1], n)[kept])
        found = table.filter(pa.array(kept))
        yield pa.RecordBatch.from_arrays(
            [found[c].combine_chunks() for c in ("_h", "_doc", "_size", "_pos")]
            + [table[c].combine_chunks().take(lead) for c in ("_doc", "_size")],
            names=["_h", "_doc", "_size", "_pos", "_lead", "_lead_size"],
        )


def _in_parts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with _parts, how many parts their list is cut into; ``sizes`` has _h and n of lists."""
    long, seen = materialize_observed(
        sizes.filter(F.col("n") > LIST_ROWS).select(F.col("_h").alias("_l"), F.ceil(F.col("n") / LIST_ROWS).cast("long").alias("_cut")),
        "long-lists",
        n=F.count("*"),
    )
    if not seen["n"]:
        return rows.withColumn("_parts", F.lit(1).cast("long"))
    return rows.join(long, F.col("_h") == F.col("_l"), "left").withColumn("_parts", F.coalesce("_cut", F.lit(1))).drop("_l", "_cut")


def shared_postings(sets: DataFrame, ranks: np.ndarray) -> DataFrame:
    """The postings of shingles that several prefixes hold, each with a lead of its list."""
    source = sets.select("_doc", "_size", "_prefix")
    common = source.mapInArrow(_postings(ranks, True), POSTING).groupBy("_h").agg(F.count("*").alias("n"))
    rows = source.mapInArrow(_postings(ranks, False), POSTING)
    return materialize(with_leads(in_parts(rows, common)), "shared-shingles")


def in_parts(postings: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Postings with the _part of their list and its number of _parts."""
    rows = _in_parts(postings, postings.groupBy("_h").agg(F.count("*").alias("n")) if sizes is None else sizes)
    return rows.withColumn("_part", F.pmod(F.xxhash64("_doc"), F.col("_parts")))


def with_leads(rows: DataFrame) -> DataFrame:
    """Postings (with _part and _parts) of lists that have several, each with the lead of its list."""
    lists = rows.repartition("_h", "_part").sortWithinPartitions("_h", "_part", "_pos", "_doc")
    return lists.mapInArrow(_leads, f"{POSTING}, _lead long, _lead_size long")


# Exact comparison


def hold(wanted: DataFrame, sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """_doc and _shingles, the whole set, of the documents named in ``wanted`` (column _d)."""
    found = sets.select("_doc", F.col("_at._key").alias("_k"), F.col("_at._id").alias("_i"))
    named, seen = materialize_observed(wanted.distinct().join(found, F.col("_d") == F.col("_doc")).drop("_d"), "wanted", n=F.count("*"))
    if (seen["n"] or 0) <= BROADCAST_ROWS:
        named = F.broadcast(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text", PIECE_BYTES):
            made = [s.tobytes() for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["_doc", "_shingles"])

    rows = texts.join(named, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i"))).select("_doc", "_text")
    return materialize(rows.mapInArrow(run, "_doc long, _shingles binary").dropDuplicates(["_doc"]), "held-sets")


def _bring(pairs: DataFrame, total: int, held: DataFrame, end: str, other: str, name: str) -> DataFrame:
    """``pairs`` with the set of one end; a set that many pairs need is copied for some of them each."""
    counts = pairs.groupBy(end).agg(F.count("*").alias("n"))
    copies = F.ceil(F.col("n") / PAIRS_PER_COPY)
    salted = attach(pairs, counts.withColumn("_copies", copies), end, total, other).withColumn(
        "_salt", F.pmod(F.xxhash64(other), F.col("_copies"))
    )
    each = F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("_c")
    sets = held.join(counts, F.col("_doc") == F.col(end)).select(F.col("_doc").alias("_e"), F.col("_shingles").alias(name), each)
    joined = salted.join(sets, (F.col(end) == F.col("_e")) & (F.col("_salt") == F.col("_c")))
    return joined.select(*pairs.columns, name)


def _shared(with_beyond: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_right"):
            found, beyond = [], []
            for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = np.intersect1d(p, q, assume_unique=True)
                found.append((len(both), len(p), len(q)))
                beyond.append(np.setdiff1d(p, both, assume_unique=True).tobytes() if with_beyond else b"")
            made = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made, pa.array(beyond, pa.binary())],
                names=["a", "b", "shared", "size_a", "size_b", "beyond"],
            )

    return run


COMPARED = "a long, b long, shared long, size_a long, size_b long, beyond binary"


def compare(
    pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int, with_beyond: bool = False
) -> tuple[DataFrame, int]:
    """The pairs a, b with the sizes of both sets and of what they share, and their number.

    ``with_beyond`` adds the shingles of a that b lacks.
    """
    pairs, seen = materialize_observed(pairs.select("a", "b"), "set-pairs", n=F.count("*"))
    n = seen["n"] or 0
    if not n:
        return pairs.sparkSession.createDataFrame([], COMPARED), 0
    ends = pairs.select(F.col("a").alias("_d")).unionAll(pairs.select(F.col("b").alias("_d")))
    held = hold(ends, sets, texts, words)
    both = _bring(_bring(pairs, n, held, "a", "b", "_left"), n, held, "b", "a", "_right")
    return materialize(both.mapInArrow(_shared(with_beyond), COMPARED), "compared"), n


def best_leads(shared: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """a and b: of each set one lead that it meets at least MET times as often as a similar pair must.

    It is the one that most sets would choose for themselves, so that near copies share a lead.
    """
    met = shared.filter("_doc != _lead").groupBy("_doc", "_lead").agg(
        F.count("*").alias("n"), F.first("_size").alias("_size"), F.first("_lead_size").alias("_other")
    )
    least, of = similar
    fit = F.least("_size", "_other") * of >= F.greatest("_size", "_other") * least
    need = F.ceil((F.col("_size") + F.col("_other")) * least / (least + of)) - F.greatest(
        *[F.ceil(F.col(c) * least / of) - 1 for c in ("_size", "_other")]
    )
    met = materialize(met.filter(fit & (F.col("n") >= MET * need)).select("_doc", "_lead", "n"), "met-leads")
    first = met.groupBy("_doc").agg(F.max(F.struct("n", (-F.col("_lead")).alias("_l"))).alias("_best"))
    chosen = first.groupBy((-F.col("_best._l")).alias("_c")).agg(F.count("*").alias("_times"))
    weighed = met.join(chosen, F.col("_lead") == F.col("_c"), "left")
    order = F.struct(F.coalesce("_times", F.lit(0)).alias("t"), "n", (-F.col("_lead")).alias("_l"))
    best = weighed.groupBy("_doc").agg(F.max(order).alias("_best"))
    return best.select(F.col("_doc").alias("a"), (-F.col("_best._l")).alias("b"))


def _node(column: str) -> Column:
    return F.unhex(F.lpad(F.hex(F.col(column)), 16, "0"))


def connected(links: DataFrame) -> DataFrame:
    """_n and _root, the smallest set of its component, of every linked set."""
    found = components(links.select(_node("a").alias("a"), _node("b").alias("b")))
    return materialize(found.select(*[F.conv(F.hex(c), 16, 10).cast("long").alias(n) for c, n in (("node", "_n"), ("root", "_root"))]), "roots")


# Pairs of classes in lists


def cut_pairs(at: np.ndarray, more: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row i with the ``more[i]`` rows from ``at[i]`` on, STEP pairs at a time or one row's."""
    through, start, n = np.cumsum(more), 0, len(more)
    while start < n:
        stop = max(start + 1, int(np.searchsorted(through, (through[start - 1] if start else 0) + STEP, "right")))
        count = more[start:stop]
        a = np.repeat(np.arange(start, stop), count)
        yield a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at[start:stop], count)
        start = stop


ENTRY = ["_least", "_most", "_from", "_to", "_lists"]  # sizes and positions that a class has in a list, and in how many it is


def class_pairs(table: pa.Table, similar: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes of different components and clusters in lists of ``table``, sorted by list, role and ENTRY.

    How many lists, and how many shared shingles their sizes ask for at least. A block is a run of
    entries with equal sizes and positions. In a list cut in two, only pairs across the cut count.
    """
    least, of = similar
    lists = [table[c].to_numpy() for c in ("_h", "_task", "_role")]
    low, high, begin, last, met = (table[c].to_numpy() for c in ENTRY)
    cls, root, cluster = (table[c].to_numpy() for c in ("_cls", "_root", "_cluster"))
    at = _ends(*lists, low, high, begin, last, met)
    size, at = np.diff(at), at[:-1]  # blocks
    ends = _ends(lists[0][at], lists[1][at])
    end = np.repeat(ends[1:], np.diff(ends))
    role = lists[2][at]
    half = _ends(lists[0][at], lists[1][at], role)
    own = np.repeat(half[1:], np.diff(half))
    first = np.where(role == WHOLE, np.arange(len(at)), own)
    more = np.where(role == RIGHT, 0, end - first)
    for i, j in cut_pairs(first, more):
        a, b = at[i], at[j]
        fit = np.minimum(high[a], high[b]) * of >= np.maximum(low[a], low[b]) * least
        need = least_shared(low[a], low[b], similar)
        rest = np.minimum(high[a] - begin[a], high[b] - begin[b])
        fit &= np.minimum(last[a], last[b]) + rest >= need
        need -= np.maximum(beyond_prefix(high[a], similar), beyond_prefix(high[b], similar))
        fit &= np.minimum(met[a], met[b]) >= need
        i, j, need = i[fit], j[fit], need[fit]
        # Members of the blocks that are left: first each left member, then its partners.
        for k, left in cut_pairs(at[i], size[i]):
            same = i[k] == j[k]
            start = np.where(same, left + 1, at[j[k]])
            for m, right in cut_pairs(start, at[j[k]] + size[j[k]] - start):
                one, two = left[m], right
                new = (root[one] != root[two]) & (cluster[one] != cluster[two])
                ends_ = np.sort(np.stack([cls[one][new], cls[two][new]], 1), axis=1)
                if len(ends_):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ends_[:, 0]), pa.array(ends_[:, 1]), pa.array(need[k][m][new])], names=["a", "b", "_need"]
                    )


WHOLE, LEFT, RIGHT = 0, 1, 2  # roles of entries


def _counted(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair once with the lists that it was met in and the least that was asked for."""
    found = pa.Table.from_batches(batches).group_by(["a", "b"]).aggregate([("a", "count"), ("_need", "min")])
    columns = [found.column(c).combine_chunks() for c in ("a", "b", "a_count", "_need_min")]
    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "_need"])


def _class_pairs(similar: tuple[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches, ["_h", "_task"]):
            held, rows = [], 0
            for found in class_pairs(table, similar):
                held.append(found)
                rows += found.num_rows
                if rows >= 1 << 20:
                    yield from _counted(held)
                    held, rows = [], 0
            if held:
                yield from _counted(held)

    return run


def _lists_apart(entries: DataFrame) -> tuple[DataFrame, dict]:
    """Lists _h whose n entries are of several components and clusters, with their sizes; totals of entries and pairs."""
    several = [F.min(c) != F.max(c) for c in ("_root", "_cluster")]
    lists = entries.groupBy("_h").agg(
        F.count("*").alias("n"), (several[0] & several[1]).alias("_apart"), F.min("_least").alias("_low"), F.max("_most").alias("_high")
    )
    pairs = F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)
    return materialize_observed(lists.filter("_apart").drop("_apart"), "lists-apart", entries=F.sum("n"), pairs=pairs)


def with_partners(entries: DataFrame, similar: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Entries of classes that may have a similar partner, with _lists, and the lists they are in.

    A pair of classes counts only if it meets in as many lists as their sizes ask for, so a class
    that is in fewer than the sizes in its lists ask for at least has no partner. Without it other
    lists may have one cluster only, or other classes too few lists: that is repeated while it
    pays. No entry of a pair that counts is lost. Sizes become those that a class has anywhere.
    """
    least, of = similar
    lists, seen = _lists_apart(entries)
    entries = entries.withColumn("_lists", F.lit(1 << 62))
    for _ in range(ROUNDS):
        pairs = seen["pairs"] or 0
        if pairs <= PAIRS_PER_ENTRY * (seen["entries"] or 0):
            break
        at = lists.select(F.col("_h").alias("_o"), "_low", "_high")
        live = entries.join(at, F.col("_h") == F.col("_o")).drop("_o")
        shared = F.ceil((F.col("_least") + F.col("_low")) * least / (least + of))
        need = shared - (F.ceil(F.greatest("_most", "_high") * least / of) - 1)
        classes = live.groupBy(F.col("_cls").alias("_c")).agg(
            F.count("*").alias("_met"), F.min(need).alias("_need"), F.min("_least").alias("_l"), F.max("_most").alias("_m")
        )
        stay = classes.filter("_met >= _need").drop("_need")
        kept = live.join(stay, F.col("_cls") == F.col("_c")).select(
            "_h", "_cls", "_root", "_cluster", F.col("_l").alias("_least"), F.col("_m").alias("_most"), "_from", "_to", F.col("_met").alias("_lists")
        )
        entries = materialize(kept, "entries-with-partners")
        lists, seen = _lists_apart(entries)
        if (seen["pairs"] or 0) > 0.9 * pairs:
            break
    return entries, lists


def candidates(shared: DataFrame, info: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """a and b: classes of different components and clusters that may have a similar pair of members.

    ``info`` has _group (component), _class and _in (cluster) of documents _d, as far as they are
    others than the document itself.
    """
    placed = shared.select("_h", "_doc", "_size", "_pos").join(small(info), F.col("_doc") == F.col("_d"), "left")
    entries = placed.groupBy("_h", F.coalesce("_class", "_doc").alias("_cls")).agg(
        F.first(F.coalesce("_group", "_doc")).alias("_root"), F.first(F.coalesce("_in", "_doc")).alias("_cluster"),
        F.min("_size").alias("_least"), F.max("_size").alias("_most"), F.min("_pos").alias("_from"), F.max("_pos").alias("_to"),
    )
    entries, lists = with_partners(materialize(entries, "list-entries"), similar)
    rows = _in_parts(entries.join(lists.select(F.col("_h").alias("_o")), F.col("_h") == F.col("_o"), "left_semi"), lists)
    own = F.pmod(F.xxhash64("_cls"), F.col("_parts"))
    rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    role = F.when(F.col("_own") == F.col("_other"), WHOLE).when(F.col("_own") < F.col("_other"), LEFT).otherwise(RIGHT)
    task = F.least("_own", "_other") * F.col("_parts") + F.greatest("_own", "_other")
    dealt = rows.withColumn("_role", role).withColumn("_task", task).repartition("_h", "_task")
    found = dealt.sortWithinPartitions("_h", "_task", "_role", *ENTRY).mapInArrow(_class_pairs(similar), "a long, b long, n long, _need long")
    counted = found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("_need").alias("_need"))
    return counted.filter("n >= _need").select("a", "b")


def size_step(size: Column) -> Column:
    """Sizes in steps of about one in a hundred."""
    return F.floor(F.log(size.cast("double")) * 100).cast("long")


def member_pairs(members: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """a and b: members of one cluster and of different components that may be similar.

    ``members`` has _d, _in (the lead), _size, _kept (what it shares with the lead), _beyond (its
    other shingles), _root and _linked, whether it is in the lead's component.
    """
    least, of = similar
    rows = members.select("_d", "_in", "_size", "_kept", "_root", "_linked", size_step(F.col("_size")).alias("_step"))
    # Pairs that need nothing beyond the lead: the other is so small that what this one kept suffices.
    enough = F.floor(F.col("_kept") * (least + of) / least) - F.col("_size")
    low, high = F.ceil(F.col("_size") * least / of), F.least(enough, F.floor(F.col("_size") * of / least))
    asks = rows.filter(~F.col("_linked") & (low <= high)).select(
        F.col("_d").alias("_a"), F.col("_in").alias("_in_a"), F.col("_size").alias("_size_a"), F.col("_kept").alias("_kept_a"),
        F.col("_root").alias("_root_a"), F.explode(F.sequence(size_step(low), size_step(high))).alias("_step_a"),
    )
    both = (F.col("_size") + F.col("_size_a")) * least
    small = both <= F.least("_kept", "_kept_a") * (least + of)
    by_size = asks.join(rows, (F.col("_in_a") == F.col("_in")) & (F.col("_step_a") == F.col("_step")) & small & (F.col("_root") != F.col("_root_a")))
    by_size = by_size.select(F.least("_a", "_d").alias("a"), F.greatest("_a", "_d").alias("b"))

    # Pairs that have shingles beyond the lead in common, all of which are listed here.
    posted = members.select("_in", "_d", "_root", "_beyond").mapInArrow(_beyond_postings, "_in long, _h long, _d long, _root long")
    lists = posted.groupBy("_in", "_h").agg(F.min("_root").alias("_x"), F.max("_root").alias("_y")).filter("_x != _y").select("_in", "_h")
    posted = materialize(posted.join(lists, ["_in", "_h"], "left_semi"), "beyond-leads")
    other = posted.select(F.col("_in").alias("_i"), F.col("_h").alias("_g"), F.col("_d").alias("_e"), F.col("_root").alias("_r"))
    meet = (F.col("_in") == F.col("_i")) & (F.col("_h") == F.col("_g")) & (F.col("_d") < F.col("_e")) & (F.col("_root") != F.col("_r"))
    counted = posted.join(other, meet).groupBy(F.col("_d").alias("a"), F.col("_e").alias("b")).agg(F.count("*").alias("n"))
    for end in ("a", "b"):
        sizes = rows.select(F.col("_d").alias("_x"), F.col("_size").alias(f"_size_{end}"), F.col("_kept").alias(f"_kept_{end}"))
        counted = counted.join(sizes, F.col(end) == F.col("_x")).drop("_x")
    most = F.least("_kept_a", "_kept_b") + F.col("n")
    by_list = counted.filter(most * (least + of) >= (F.col("_size_a") + F.col("_size_b")) * least).select("a", "b")
    return by_size.unionAll(by_list).distinct()


def _beyond_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            own = [np.frombuffer(b, np.int64) for b in batch.column(3).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
            values = np.concatenate(own) if own else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), pa.array(values), batch.column(1).take(row), batch.column(2).take(row)],
                names=["_in", "_h", "_d", "_root"],
            )


def follower_pairs(compared: DataFrame, roots: DataFrame, followers: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """a and b: members of two classes whose leads are not similar, if what the leads share and
    what the members have beyond them may be enough."""
    least, of = similar
    members = followers.select("_class", "_d", "_size", "_beyond")
    widest = members.groupBy(F.col("_class").alias("_w")).agg(F.max("_beyond").alias("_far"))
    open_ = compared.filter(~is_similar(F.col("shared"), F.col("size_a"), F.col("size_b"), similar))
    for end in ("a", "b"):
        at = roots.select(F.col("_n").alias("_x"), F.col("_root").alias(f"_root_{end}"))
        far = widest.select(F.col("_w").alias("_y"), F.col("_far").alias(f"_far_{end}"))
        open_ = open_.join(at, F.col(end) == F.col("_x"), "left").drop("_x").join(far, F.col(end) == F.col("_y"), "left").drop("_y")
    apart = F.coalesce("_root_a", "a") != F.coalesce("_root_b", "b")
    gain = F.coalesce("_far_a", F.lit(0)) + F.coalesce("_far_b", F.lit(0))
    # A follower may be smaller than its lead; at SAME it still has that share of its shingles.
    floor = (F.col("size_a") + F.col("size_b")) * (SAME[0] / SAME[1])
    hope = (F.col("shared") + gain) * (least + of) >= least * floor - 1
    open_ = open_.filter(apart & (gain > 0) & hope)
    sides = []
    for end in ("a", "b"):
        lead = open_.select("a", "b", "shared", F.col(end).alias("_m"), F.col(f"size_{end}").alias("_s"), F.lit(0).cast("long").alias("_more"))
        found = open_.join(members, F.col(end) == F.col("_class")).select(
            "a", "b", "shared", F.col("_d").alias("_m"), F.col("_size").alias("_s"), F.col("_beyond").alias("_more")
        )
        sides.append(lead.unionAll(found).select(*[F.col(c).alias(f"{c}_{end}") for c in ("a", "b", "shared", "_m", "_s", "_more")]))
    one, two = sides
    most = F.col("shared_a") + F.col("_more_a") + F.col("_more_b")
    enough = most * (least + of) >= least * (F.col("_s_a") + F.col("_s_b"))
    same = (F.col("a_a") == F.col("a_b")) & (F.col("b_a") == F.col("b_b"))
    new = (F.col("_m_a") != F.col("a_a")) | (F.col("_m_b") != F.col("b_a"))
    return one.join(two, same & enough & new).select(F.col("_m_a").alias("a"), F.col("_m_b").alias("b"))


# All together


def set_groups(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    words: int,
    similar: tuple[int, int] = SIMILAR,
    digest: Callable[[np.ndarray], bytes] | None = None,
    find_leads: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, int]:
    """Rows (_id, _key, _set, _size), one group per _set (n, component, component_id), and the
    number of rows. Empty sets are in no group.

    ``digest`` makes a fingerprint of a set and ``find_leads``, from _doc and _print, pairs a and b
    of a set and a lead that is probably similar. They save work; results do not depend on them.
    """
    texts = docs.select(
        F.col(id_col).alias("_id"), text_key(text_col).alias("_key"), F.col(text_col).cast("string").alias("_text")
    )
    kind = texts.schema["_id"].dataType.simpleString()
    ranks = rarity(texts, words)
    described = texts.mapInArrow(
        _described(words, similar, ranks, digest or (lambda found: b"")),
        f"_id {kind}, _key binary, _set binary, _size long, _prefix binary, _print binary",
    )
    rows, seen = materialize_observed(described, "shingle-sets", n=F.count("*"))
    sets = rows.filter("_size > 0").groupBy("_set").agg(
        F.count("*").alias("n"), F.min("_id").alias("_first"), F.min(F.struct("_key", "_id")).alias("_at"),
        F.first("_size").alias("_size"), F.first("_prefix").alias("_prefix"), F.first("_print").alias("_print"),
    )
    sets = materialize(sets.withColumn("_doc", F.monotonically_increasing_id()), "distinct-sets")
    shared = shared_postings(sets, ranks)

    hopes = best_leads(shared, similar)
    if find_leads:
        given = materialize(find_leads(sets.select("_doc", "_print")), "given-leads")
        hopes = given.unionAll(hopes.join(given.select("a"), "a", "left_anti"))
    leads, _ = compare(hopes, sets, texts, words, True)
    fits = is_similar(F.col("shared"), F.col("size_a"), F.col("size_b"), similar)
    links = leads.filter(fits).select("a", "b")
    lost = materialize(leads.filter(~fits).select(F.col("a").alias("_l")), "without-lead")
    again = shared.join(small(lost), F.col("_doc") == F.col("_l"), "left_semi").select("_h", "_doc", "_size", "_pos")
    tried = leads.select("a", "b")
    found, n = compare(best_leads(with_leads(in_parts(again)), similar).join(tried, ["a", "b"], "left_anti"), sets, texts, words)
    if n:
        links = links.unionAll(found.filter(fits).select("a", "b"))
        tried = tried.unionAll(found.select("a", "b"))
    roots = connected(links)

    # A lead may have a lead itself; followers are only those whose lead has none.
    led = leads.join(leads.select(F.col("a").alias("_f")), F.col("b") == F.col("_f"), "left")
    near = is_similar(F.col("shared"), F.col("size_a"), F.col("size_b"), max(similar, SAME, key=lambda s: s[0] / s[1]))
    members = led.select(
        F.col("a").alias("_d"), F.col("b").alias("_in"), F.when(near & F.col("_f").isNull(), F.col("b")).alias("_class"), F.col("size_a").alias("_size"),
        F.col("shared").alias("_kept"), F.col("beyond").alias("_beyond"), fits.alias("_similar"),
    )
    for end in ("_d", "_in"):
        at = roots.select(F.col("_n").alias("_x"), F.col("_root").alias(f"_root{end}"))
        members = members.join(at, F.col(end) == F.col("_x"), "left").drop("_x").withColumn(f"_root{end}", F.coalesce(f"_root{end}", end))
    linked = F.col("_root_d") == F.col("_root_in")
    members = materialize(members.withColumn("_root", F.col("_root_d")).withColumn("_linked", linked).drop("_root_d", "_root_in"), "members")
    followers = members.filter("_class IS NOT NULL").select("_d", "_class", "_size", (F.col("_size") - F.col("_kept")).alias("_beyond"))

    info = roots.select(F.col("_n").alias("_d"), F.col("_root").alias("_group")).join(members.select("_d", "_class", "_in"), "_d", "full")
    info = materialize(info, "places")
    pairs = candidates(shared, info, similar)
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    inside = member_pairs(members, similar).join(known, ["a", "b"], "left_anti")
    inside, n = compare(inside, sets, texts, words)
    if n:
        links = links.unionAll(inside.filter(fits).select("a", "b"))
    more, found = compare(pairs.join(known, ["a", "b"], "left_anti"), sets, texts, words)
    if found:
        links = links.unionAll(more.filter(fits).select("a", "b"))
    if n or found:
        roots = connected(links)
    if found:
        last, found = compare(follower_pairs(more, roots, followers, similar), sets, texts, words)
    if found:
        roots = connected(links.unionAll(last.filter(fits).select("a", "b")))

    placed = sets.select("_set", "n", "_first", "_doc").join(roots, F.col("_doc") == F.col("_n"), "left").select(
        "_set", "n", "_first", F.coalesce("_root", "_doc").alias("component")
    )
    least = placed.groupBy(F.col("component").alias("_c")).agg(F.min("_first").alias("component_id"))
    groups = placed.join(least, F.col("component") == F.col("_c")).select("_set", "n", "component", "component_id")
    return rows.select("_id", "_key", "_set", "_size"), materialize(groups, "set-groups"), seen["n"] or 0


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """id_col, n_shingles and component_id, the smallest id that links lead to, of every row.

    Texts (null: empty) are lower-cased in A-Z and cut into words at ASCII white space. A text
    without words has no shingles and its own id. Rows with equal texts are linked. A null id is
    the smallest of a component only if there is no other. Repeated rows give repeated rows, an
    empty table none; other columns are ignored.
    """
    rows, groups, total = set_groups(docs, id_col, text_col, words, similar)
    found = attach(rows.select("_id", "_set", "_size"), groups, "_set", total, "_id")
    own = F.when(F.col("_size") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return found.select(F.col("_id").alias(id_col), F.col("_size").alias("n_shingles"), own.alias("component_id"))
