"""Passages that repeat across documents, by relative Lempel-Ziv parsing.

A document is parsed against all documents with smaller ids. That reference is indexed in blocks
by the hash of every run of WINDOW words, so a block can tell for each such run whether it also
starts in an earlier document. Parsing is greedy: a factor begins at the first run found and is
lengthened as long as the run one word on is found as well. Where a factor ends, the runs that
lie across its border are looked up like any other, so a factor may begin before the last one
has ended. Factors of WINDOW words or more are the duplicate spans. Neighbouring runs may
come from different documents, so a factor need not be a substring of any one; it keeps no
position in the reference, and no bytes of the reference are compared.

What the blocks need is one hash and one position per run. A task packs those of a few MB of
text into one row per block: hashes of 56 bits, which the block's number, drawn from other bits,
adds to. Runs repeated inside a pack are settled there, so a passage that a third of all documents
share reaches its block as a few rows of each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.words import in_pieces, mix, powers, text_bytes, word_hashes, word_spans
from tidecast.session import materialize

WINDOW = 13
BLOCK_BYTES = 6 << 20  # of text, whose runs one block indexes
PACK_BYTES = 8 << 20  # of text, packed together
_HASH = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def run_hashes(words: np.ndarray, window: int, base: np.uint64) -> np.ndarray:
    """Hash of the ``window`` words that begin at each word."""
    n = len(words) - window + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k, p in enumerate(powers(base, window)):
        out += words[k : k + len(out)] * p
    return mix(out)


def pack(array: np.ndarray) -> bytes:
    """64-bit numbers as compressed steps, byte plane by byte plane."""
    steps = np.diff(array.astype(np.int64), prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


class Piece:
    """Some documents, their words in one sequence, and the runs that begin in them."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, texts: pa.Array, window: int):
        raw, at = text_bytes(texts)
        first, end, before = word_spans(raw, at)
        words = word_hashes(raw, first, end)
        self.ids, self.keys, self.before = ids, keys, before
        doc = np.repeat(np.arange(len(ids)), np.diff(before))
        n = max(len(words) - window + 1, 0)
        self.at = np.flatnonzero(doc[:n] == doc[window - 1 :]) if n else np.zeros(0, np.int64)
        self.doc = doc[self.at]
        self.hash = run_hashes(words, window, _HASH[0])[self.at]
        self.block = (run_hashes(words, window, _HASH[1])[self.at] >> np.uint64(20)).astype(np.int64)

    def repeats(self) -> np.ndarray:
        """Which runs also begin in a document of the piece with a smaller id."""
        later = np.zeros(len(self.at), bool)
        if len(self.at):
            id_ = self.ids[self.doc]
            order = np.lexsort((id_, self.hash))
            later[order] = _not_least(self.hash[order], id_[order])
        return later


def _not_least(group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows in order of group and id: which have a larger id than the first of their group."""
    first = np.r_[True, group[1:] != group[:-1]]
    return ids > ids[np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))]


PACKS = pa.schema(
    [("block", pa.int32()), ("piece", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary()), ("keys", pa.binary()),
     ("at", pa.binary()), ("hashes", pa.binary())]
)
PACKS_DDL = "block int, piece long, ids binary, starts binary, keys binary, at binary, hashes binary"


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, PACKS)


def _cut(blocks: int, window: int) -> Callable:
    """For each piece one row with its documents and the runs settled inside, and a pack of runs,
    with the documents they begin in, for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text", PACK_BYTES):
            ids, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            piece = Piece(ids, keys, batch.column(2), window)
            if not len(piece.at):
                continue
            name = xxhash.xxh64_intdigest(ids.tobytes() + keys.tobytes()) >> 1
            later = piece.repeats()
            block = piece.block % blocks
            docs = {"ids": pack(ids), "starts": pack(piece.before), "keys": keys.tobytes()}
            rows = [{"block": int(block[0]), "piece": name, "at": pack(piece.at[later]), **docs}]
            open_ = np.flatnonzero(~later)
            order = open_[np.argsort(block[open_], kind="stable")]
            found, firsts = np.unique(block[order], return_index=True)
            for b, part in zip(found.tolist(), np.split(order, firsts[1:])):
                own = np.unique(piece.doc[part])
                rows.append({
                    "block": b, "piece": name, "ids": pack(ids[own]), "starts": pack(piece.before[own]), "at": pack(piece.at[part]),
                    "hashes": piece.hash[part].view(np.uint8).reshape(-1, 8)[:, 1:].tobytes(),
                })
            yield _rows(rows)

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inside one block: the runs of every pack that begin in an earlier document as well."""
    held: list[dict] = []
    for batch in batches:
        rows = batch.to_pylist()
        pieces = [r for r in rows if r["keys"] is not None]
        held += [r for r in rows if r["keys"] is None]
        if pieces:
            yield _rows(pieces)
    if not held:
        return
    at = [unpack(r["at"]) for r in held]
    hashes, ids = [], []
    for r, a in zip(held, at):
        ids.append(unpack(r["ids"])[np.searchsorted(unpack(r["starts"]), a, "right") - 1])
        low = np.zeros((len(a), 8), np.uint8)
        low[:, 1:] = np.frombuffer(r["hashes"], np.uint8).reshape(-1, 7)
        hashes.append(low.view(np.uint64).ravel())
    whole, id_ = np.concatenate(hashes), np.concatenate(ids)
    block = np.repeat([r["block"] for r in held], [len(a) for a in at])
    order = np.lexsort((id_, whole, block))
    later = np.zeros(len(whole), bool)
    changes = np.r_[False, block[order][1:] != block[order][:-1]].cumsum().astype(np.uint64)
    later[order] = _not_least(whole[order] ^ mix(changes), id_[order])
    found = np.split(later, np.cumsum([len(a) for a in at])[:-1])
    out = [{"block": r["block"], "piece": r["piece"], "at": pack(a[hit])} for r, a, hit in zip(held, at, found) if hit.any()]
    for k in range(0, len(out), 64):
        yield _rows(out[k : k + 64])


def factors(found: np.ndarray, window: int) -> np.ndarray:
    """Greedy parse: (first word, words) of each factor, from the rising starts of runs found."""
    if not len(found):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.r_[True, np.diff(found) > 1])
    last = found[np.r_[cut[1:] - 1, len(found) - 1]]
    return np.stack([found[cut], last - found[cut] + window], axis=1)


def _by_document(window: int) -> Callable:
    """The factors of each document of one piece."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = rows[rows["keys"].notna()]
        if not len(whole):
            raise RuntimeError("the table was read in another order; write it before it is deduplicated")
        piece = whole.iloc[0]
        ids, starts, keys = unpack(piece["ids"]), unpack(piece["starts"]), np.frombuffer(piece["keys"], np.int64)
        at = np.unique(np.concatenate([unpack(a) for a in rows["at"]]))
        cuts = np.searchsorted(at, starts)
        made = [
            (i, key, factors(at[a:b] - first, window).astype(np.int32).tobytes())
            for i, key, first, a, b in zip(ids.tolist(), keys.tolist(), starts.tolist(), cuts.tolist(), cuts[1:].tolist())
            if a < b
        ]
        return pd.DataFrame(made, columns=["_order", "_key", "spans"])

    return run


def _keys(id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Sort key of the id (null last), hash that tells texts with one id apart, and text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    return order.alias("_order"), F.xxhash64(text).alias("_key"), text.alias("_text")


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """_order, _key and ``spans``: factors as pairs of 32-bit numbers, for documents with any."""
    order, key, text = _keys(id_col, text_col)
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    packs = docs.select(order, key, text).mapInArrow(_cut(blocks, window), PACKS_DDL)
    hits = packs.repartitionById(blocks, F.col("block")).mapInArrow(_look_up, PACKS_DDL)
    by_piece = hits.groupBy("piece").applyInPandas(_by_document(window), "_order long, _key long, spans binary")
    merged = by_piece.groupBy("_order", "_key").agg(F.collect_set("spans").alias("spans"))
    return materialize(merged, "spans")


def _strip(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text"):
            totals, gone, shas = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                total = len(words)
                if spans:
                    drop = np.zeros(total + 1, np.int64)
                    for first, size in np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2).tolist():
                        drop[first] += 1
                        drop[first + size] -= 1
                    keep = np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()
                    words = [words[k] for k in keep]
                totals.append(total)
                gone.append(total - len(words))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            made = [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], names=["_id", "n_words", "n_removed", "kept_sha256"]
            )

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id_col, n_words, n_removed and kept_sha256 per row.

    A document with a null id comes after all others. Rows that repeat an id are never earlier than
    one another. Null and empty texts have no words and keep the empty text; repeated rows give
    repeated rows, an empty table none; other columns are ignored.
    """
    order, key, text = _keys(id_col, text_col)
    spans = duplicate_spans(docs, id_col, text_col, window).select(
        F.col("_order").alias("_o"), F.col("_key").alias("_k"), "spans"
    )
    rows = docs.select(F.col(id_col).alias("_id"), order, key, text)
    joined = rows.join(spans, (F.col("_order") == F.col("_o")) & (F.col("_key") == F.col("_k")), "left")
    kind = rows.schema["_id"].dataType.simpleString()
    return (
        joined.select("_id", "_text", "spans")
        .mapInArrow(_strip(window), f"_id {kind}, n_words long, n_removed long, kept_sha256 string")
        .withColumnRenamed("_id", id_col)
    )
