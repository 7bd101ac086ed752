"""Quality rules: the lines of a text labelled by a linear-chain conditional random field.

A chain's states are content and boilerplate. Each line has a set of yes-or-no features, and the
Viterbi path gives the labels of all lines of a text. A text is kept if content lines have at
least half of its words and it passes two base rules. The field is fitted by maximum likelihood
on texts that were labelled as a whole: lines of good texts are taken for content, lines of bad
ones for boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.words import IS_SPACE, in_pieces, mix, text_bytes, word_hashes, word_spans

SAMPLE = 400  # labelled texts of each class that the field is fitted on, at most
CHAIN = 64  # lines of one training chain; longer texts give several
ROUNDS = 150
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

FEATURES = (
    "always", "short", "long", "some symbols", "many symbols", "menu", "few different words",
    "seen before", "ends a sentence", "many digits", "address", "long words",
)


def line_features(lines: list[bytes]) -> tuple[list[int], list[int], int]:
    """Features of each line as bits, its words, and the lines with a word equal to an earlier."""
    bits, sizes, copies = [], [], 0
    seen: set[bytes] = set()
    for line in lines:
        words = line.split()
        n = len(words)
        f = 1
        if n:
            chars = len(line)
            symbols = chars - len(line.translate(None, SYMBOLS))
            if n < 4:
                f |= 2
            elif n >= 12:
                f |= 4
            if symbols * 50 > chars:
                f |= 8
            if symbols * 12 > chars:
                f |= 16
            if line.count(b"|") > 1:
                f |= 32
            if n >= 6 and 2 * len(set(words)) < n:
                f |= 64
            if line in seen:
                f |= 128
                copies += 1
            if words[-1][-1] in b".!?":
                f |= 256
            if (chars - len(line.translate(None, DIGITS))) * 6 > chars:
                f |= 512
            if b"@" in line or b"://" in line or b"www." in line:
                f |= 1024
            if chars > 12 * n:
                f |= 2048
            seen.add(line)
        bits.append(f)
        sizes.append(n)
    return bits, sizes, copies


def base_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n_words, word_chars, n_symbols and n_repeat_words of each text."""
    raw, at = text_bytes(texts)

    def total(marks: np.ndarray) -> np.ndarray:
        through = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return through[at[1:]] - through[at[:-1]]

    first, end, before = word_spans(raw, at)
    n_words = np.diff(before)
    chars = total(~IS_SPACE[raw] & ((raw & 0xC0) != 0x80))
    symbols = total(_IS_SYMBOL[raw])
    words = word_hashes(raw, first, end)
    covered = np.zeros(len(words), bool)
    if len(words) > 3:
        text = np.repeat(np.arange(len(n_words)), n_words)
        inside = np.flatnonzero(text[2:] == text[:-2])
        window = mix(words[inside] * np.uint64(3) + text[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        window = mix(window + words[inside + 1] * np.uint64(5))
        window = mix(window + words[inside + 2] * np.uint64(7))
        order = np.argsort(window)
        sorted_ = window[order]
        same = np.zeros(len(sorted_), bool)
        same[1:] = sorted_[1:] == sorted_[:-1]
        same[:-1] |= same[1:]
        hit = inside[order[same]]
        for k in range(3):
            covered[hit + k] = True
    through = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    return n_words, chars, symbols, through[before[1:]] - through[before[:-1]]


@dataclass
class Field:
    """Scores of state 1 (content) over state 0 (boilerplate)."""

    emit: np.ndarray  # of each feature
    move: np.ndarray  # from state to state

    def __post_init__(self):
        table = np.arange(1 << len(FEATURES))[:, None] >> np.arange(len(FEATURES)) & 1
        self.scores = (table @ self.emit).tolist()
        self.to_self = [float(self.move[0, 0]), float(self.move[1, 1])]
        self.to_other = [float(self.move[0, 1]), float(self.move[1, 0])]

    def viterbi(self, bits: list[int]) -> list[int]:
        """The most likely state of each line."""
        if not bits:
            return []
        (s0, s1), (t01, t10) = self.to_self, self.to_other
        bad, good = 0.0, self.scores[bits[0]]
        back = []
        for f in bits[1:]:
            b0, b1 = bad + s0, good + t10
            g0, g1 = bad + t01, good + s1
            back.append((b1 > b0, g1 >= g0))
            bad, good = max(b0, b1), max(g0, g1) + self.scores[f]
        states = [int(good >= bad)]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]

    def content_share(self, bits: list[int], sizes: list[int]) -> float:
        words = sum(sizes)
        return sum(n for n, s in zip(sizes, self.viterbi(bits)) if s) / words if words else 0.0


def fit(chains: list[list[int]], good: list[int]) -> Field:
    """Maximum likelihood by gradient steps; forward and backward sums over all chains at once."""
    emit, move = np.zeros(len(FEATURES)), np.zeros((2, 2))
    cut = [(c[i : i + CHAIN], g) for c, g in zip(chains, good) for i in range(0, len(c), CHAIN)]
    if not cut:
        return Field(emit, move)
    bits = np.zeros((len(cut), CHAIN), np.int64)
    real = np.zeros((len(cut), CHAIN))
    for k, (c, _) in enumerate(cut):
        bits[k, : len(c)], real[k, : len(c)] = c, 1
    truth = np.array([g for _, g in cut])[:, None] * real
    x = (bits[:, :, None] >> np.arange(len(FEATURES)) & 1) * real[:, :, None]
    pairs = real[:, 1:].sum()
    kept = np.array([(truth[:, 1:] * real[:, 1:]).sum()])
    seen_move = np.diag([pairs - kept[0], kept[0]])
    for _ in range(ROUNDS):
        score = np.stack([np.zeros(real.shape), x @ emit], axis=2)
        ahead = np.zeros((CHAIN, len(cut), 2))
        ahead[0] = score[:, 0]
        for t in range(1, CHAIN):
            step = np.logaddexp(ahead[t - 1][:, :1] + move[0], ahead[t - 1][:, 1:] + move[1]) + score[:, t]
            ahead[t] = np.where(real[:, t, None] > 0, step, ahead[t - 1])
        all_ = np.logaddexp(ahead[-1][:, 0], ahead[-1][:, 1])
        behind = np.zeros((CHAIN, len(cut), 2))
        expected = np.zeros((2, 2))
        for t in range(CHAIN - 1, 0, -1):
            out = behind[t] + score[:, t]
            both = ahead[t - 1][:, :, None] + move + out[:, None, :] - all_[:, None, None]
            expected += (np.exp(both) * real[:, t, None, None]).sum(axis=0)
            step = np.logaddexp(move[:, 0] + out[:, :1], move[:, 1] + out[:, 1:])
            behind[t - 1] = np.where(real[:, t, None] > 0, step, 0.0)
        content = np.exp((ahead[:, :, 1] + behind[:, :, 1]).T - all_[:, None])
        n = real.sum()
        emit = emit + 2.0 * (np.einsum("kt,ktf->f", (truth - content) * real, x) / n - 1e-4 * emit)
        move = move + 0.5 * ((seen_move - expected) / n - 1e-2 * move)
    return Field(emit, move)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality"
) -> Field:
    """Fits the field on SAMPLE texts of each class, chosen by a hash of the id."""
    picked = None
    for quality in (0, 1):
        one = (
            labels.filter(F.col(quality_col) == quality)
            .select(F.col(id_col).alias("_p"), F.lit(quality).alias("_good"))
            .orderBy(F.xxhash64("_p"), "_p")
            .limit(SAMPLE)
        )
        picked = one if picked is None else picked.unionAll(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features(t.split(b"\n"))[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int32()))], names=["g", "x"])

    rows = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text")
    )
    rows = rows.join(F.broadcast(picked), F.col("_id") == F.col("_p")).select("_good", "_text")
    found = rows.mapInArrow(run, "g int, x array<int>").orderBy("g", "x").collect()
    return fit([r["x"] for r in found], [r["g"] for r in found])


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, the base counts, base_failed, kept and content_share per row, from whole texts.

    A null or empty text has no word and fails. Repeated rows give repeated rows, an empty table
    none; other columns are ignored.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text"):
            n_words, chars, symbols, repeats = base_counts(batch.column(1))
            copies, shares = [], []
            for text in batch.column(1).to_pylist():
                bits, sizes, same = line_features((text or "").encode().split(b"\n"))
                copies.append(same)
                shares.append(field.content_share(bits, sizes))
            failed = (n_words < MIN_WORDS) | (100 * repeats > 50 * n_words)
            share = np.array(shares, float)
            kept = ~failed & (share >= CONTENT_SHARE)
            numbers = [n_words, chars, symbols, np.array(copies, np.int64), repeats]
            made = [pa.array(c.astype(np.int64)) for c in numbers]
            made += [pa.array(failed), pa.array(kept), pa.array(share)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], names=["_id", *counts, "base_failed", "kept", "content_share"]
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in counts)
    return rows.mapInArrow(
        run, f"_id {kind}, {numbers}, base_failed boolean, kept boolean, content_share double"
    ).withColumnRenamed("_id", id_col)
