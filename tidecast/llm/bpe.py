"""Byte-level BPE encoding and decoding with the merges of a public tokenizer file.

A word's bytes are its first parts. One array holds where parts begin and one, beside it, the
rank of each part joined with the next; the smallest rank names the boundary to delete, and the
ranks next to it are looked up anew. Long words keep the same ranks in a heap instead, as
scanning them again and again would take quadratic time. Words repeat, so each Python worker
keeps the tokens of those it has met, in CACHE_BYTES at most: when the young half is full, the old
half is forgotten, and what is met again returns to the young one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.words import KEPT, in_pieces

# The word pattern of byte-level tokenizers of this kind.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SHORT = 64  # parts of a word that are scanned; beyond it a heap is used
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 200  # of a short word and its ids as Python keeps them
MARKS = ".,;:!?%$#*&|"  # often end a word; each is neither letter, number nor space
NEVER = 1 << 60


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in the file: itself if it is printable in
    Latin-1 and no space, else the next one from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """The vocabulary, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = printable_bytes()
        raw = {token: bytes(byte_of[c] for c in token) for token in spec["model"]["vocab"]}
        self.ids = {raw[token]: i for token, i in spec["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {raw[a] + raw[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.cuts = [len(raw[a]) for a, _ in pairs]
        self.two = [self.ranks.get(bytes((k >> 8, k & 255)), NEVER) for k in range(1 << 16)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.shown = {token: str(i) for token, i in self.ids.items()}
        self.bytes_of = {i: token for token, i in self.ids.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.bytes_shown = {str(i): token for i, token in self.bytes_of.items()}
        self.words = regex.compile(WORDS)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.spread_space = regex.compile(r"\s ")
        self.before_space = regex.compile(r"(?<=\S)(?= )")
        self.known: dict[str, str] = {}  # words, and stretches between spaces; the young half
        self.old: dict[str, str] = {}
        self.most_known = CACHE_BYTES // ENTRY_BYTES // 2

    def parts(self, word: bytes) -> list[bytes]:
        """Tokens of one word."""
        return self._scan(word) if len(word) <= SHORT else self._heap(word)

    def _rank(self, word: bytes, a: int, b: int, c: int) -> int:
        """Rank of joining the parts from a and from b, which ends at c."""
        r = self.ranks.get(word[a:c], NEVER)
        return r if r < NEVER and self.cuts[r] == b - a else NEVER

    def _scan(self, word: bytes) -> list[bytes]:
        get, cuts = self.ranks.get, self.cuts
        begins = list(range(len(word) + 1))
        two = self.two
        ranks = [two[a << 8 | b] for a, b in zip(word, word[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            del begins[i + 1], ranks[i]
            a, b = begins[i], begins[i + 1]
            if i < len(ranks):
                r = get(word[a : begins[i + 2]], NEVER)
                ranks[i] = r if r == NEVER or cuts[r] == b - a else NEVER
            if i:
                before = begins[i - 1]
                r = get(word[before:b], NEVER)
                ranks[i - 1] = r if r == NEVER or cuts[r] == a - before else NEVER
        return [word[a:b] for a, b in zip(begins, begins[1:])]

    def _heap(self, word: bytes) -> list[bytes]:
        """The same merges; parts linked to their neighbours, ranks in a heap."""
        n = len(word)
        end = list(range(1, n + 1))  # of the part beginning here
        before = list(range(-1, n - 1))

        def joined(a: int) -> int:
            return self._rank(word, a, end[a], end[end[a]]) if end[a] < n else NEVER

        now = [joined(a) for a in range(n)]
        heap = [(r, a) for a, r in enumerate(now) if r < NEVER]
        heapq.heapify(heap)
        while heap:
            r, a = heapq.heappop(heap)
            if now[a] != r:
                continue  # its parts have changed since
            gone = end[a]
            end[a] = end[gone]
            now[gone] = -1
            if end[a] < n:
                before[end[a]] = a
            for i in (a, before[a]):
                if i >= 0:
                    now[i] = joined(i)
                    if now[i] < NEVER:
                        heapq.heappush(heap, (now[i], i))
        out, a = [], 0
        while a < n:
            out.append(word[a : end[a]])
            a = end[a]
        return out

    def _keep(self, stretch: str, found: str) -> str:
        if len(stretch) <= SHORT:
            if len(self.known) >= self.most_known:
                self.old, self.known = self.known, {}
            self.known[stretch] = found
        return found

    def _met(self, stretch: str) -> str | None:
        """What is known of a stretch, from either half."""
        found = self.known.get(stretch)
        if found is None and (found := self.old.get(stretch)) is not None:
            self._keep(stretch, found)
        return found

    def _word(self, word: str) -> str:
        """Ids of one word; alone it is the same word as among others."""
        return self._met(word) or self._keep(word, ",".join([self.shown[p] for p in self.parts(word.encode())]))

    def _chunk(self, chunk: str) -> str:
        """Ids of a stretch that holds whole words, joined by commas."""
        if found := self._met(chunk):
            return found
        letters = chunk.rstrip(MARKS)
        if letters[1:].isalpha() and (letters[0] == " " or letters[0].isalpha()):  # at most a space, letters and marks: one word or two
            found = self._word(letters)
            if len(letters) == len(chunk):
                return found
            found += "," + self._word(chunk[len(letters) :])
        else:
            found = ",".join([self._word(w) for w in self.words.findall(chunk)])
        return self._keep(chunk, found)

    def encode_joined(self, text: str) -> str:
        """Token ids of a text, joined by commas.

        A text is cut before each space that follows something else than white space: no word
        of the pattern runs over such a place, nor does one depend on what is beyond it.
        """
        out: list[str] = []
        pieces = self.marks.split(text) if self.marks else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(str(self.special[piece]))
            elif piece:
                if self.spread_space.search(piece):
                    chunks = self.before_space.split(piece)
                else:
                    first, *rest = piece.split(" ")
                    chunks = [" " + c for c in rest]
                    if first:
                        chunks.insert(0, first)
                known = self.known.get
                out.extend([known(c) or self._chunk(c) for c in chunks])
        return ",".join(out)

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode(self, ids: list[int]) -> str:
        """The text of token ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


    def decode_shown(self, ids: list[str]) -> str:
        """The same for ids in decimal form."""
        return b"".join(map(self.bytes_shown.__getitem__, ids)).decode("utf-8", "replace")


def load(path: str) -> Bpe:
    """One tokenizer per Python worker, that of the file last asked for.

    It is kept beside the interpreter's modules: this function travels to workers that do not have
    the package, and what travels is made anew for every task. The next task of another operator
    on texts frees it, so that stages after this one have the memory.
    """
    kept = sys.__dict__.setdefault(KEPT, {})
    if path not in kept:
        kept.clear()
        kept[path] = Bpe(path)
    return kept[path]


def _digests(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        sha = hashlib.sha256
        for batch in in_pieces(batches, "_text", keep=True):
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                joined = bpe.encode_joined(text or "")
                ids = joined.split(",") if joined else []
                counts.append(len(ids))
                ids_sha.append(sha(joined.encode()).hexdigest())
                text_sha.append(sha(bpe.decode_shown(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows, rows.schema["_id"].dataType.simpleString()


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens and the SHA-256 of the encoded ids and of the decoded text per row.

    A null text counts as empty and has no token; repeated rows give repeated rows, an empty
    table none; other columns are ignored. ``path`` must exist on every executor.
    """
    rows, kind = _rows(docs, id_col, text_col)
    made = rows.mapInArrow(
        _digests(path), f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return made.withColumnRenamed("_id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ``ids``, the tokens of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in in_pieces(batches, "_text", 1 << 20, keep=True):
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["_id", "ids"]
            )

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and ``text``, what each array of token ids stands for; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    rows = tokens.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)
