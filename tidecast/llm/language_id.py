"""Language identification with error-correcting output codes.

Every language has a codeword; one linear classifier of character n-grams per bit tells which
half of the languages a text is in. The bits' logistic losses against each codeword, weighted by
how well the bit was learned, are summed, and the language with the smallest loss wins. If the
second is nearly as close, the text is flagged as ambiguous.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.words import in_pieces
from tidecast.session import materialize

SAMPLE = 300  # labelled documents of each language that are learned from, at most
FEATURES = 1 << 12  # hashed n-grams of one to three bytes
ALL_DICHOTOMIES = 6  # up to so many languages every split of them is a bit
ROUNDS = 300
AMBIGUOUS = 0.6  # a score below it
GUESS = math.log(2)  # loss of a bit that is a mere guess
UNKNOWN = "und"

_KEPT = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    if _ASCII_LETTER.search(text):
        return True
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of the n-grams; marks, digits and spaces are one space."""
    a = np.frombuffer(b" " + b" ".join(text.translate(_KEPT).split()) + b" ", np.uint8).astype(np.uint32)
    two = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + a[2:] * np.uint32(0x27D4EB2F)
    grams = np.concatenate([a * np.uint32(0x165667B1), two, three]) >> np.uint32(20)
    counts = np.bincount(grams, minlength=FEATURES)
    return np.sqrt(counts / len(grams)).astype(np.float32)


def codewords(k: int) -> np.ndarray:
    """Rows of +1 and -1, one per language, whose columns are distinct splits."""
    if k <= ALL_DICHOTOMIES:
        cols = [[1] + [1 if c >> i & 1 else -1 for i in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(cols, float).reshape(len(cols), k).T
    length = 15 * math.ceil(math.log2(k))
    draws = (np.random.default_rng(seed).choice([-1.0, 1.0], (k, length)) for seed in range(50))

    def apart(code: np.ndarray) -> float:
        far = (length - code @ code.T) / 2
        return far[~np.eye(k, dtype=bool)].min()

    return max(draws, key=apart)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, text: bytes) -> np.ndarray:
        """Weighted loss of a text against the codeword of each language."""
        margin = features(text) @ self.weights + self.bias
        return (np.logaddexp(0, -self.code * margin) * self.trust).sum(axis=1)

    def knows(self, text: bytes | None) -> bool:
        """Whether a text has a letter and its nearest codeword is nearer than mere guesses of all bits.

        Without two languages to tell apart every text with a letter is known.
        """
        if not text or not has_letter(text):
            return False
        return len(self.languages) < 2 or bool(self.losses(text).min() < GUESS * self.trust.sum())

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether it is ambiguous."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        loss = self.losses(text)
        share = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        score = float(1 / share.sum())
        return self.languages[best], score, len(self.languages) > 1 and score < AMBIGUOUS


def fit(examples: np.ndarray, labels: list[str]) -> Model:
    """One logistic classifier per bit, by gradient steps over all examples."""
    languages = sorted(set(labels))
    code = codewords(len(languages)) if languages else np.zeros((0, 0))
    bits = code.shape[1]
    weights, bias = np.zeros((FEATURES, bits)), np.zeros(bits)
    if not bits:
        return Model(languages, code, weights.astype(np.float32), bias, np.ones(bits))
    which = np.array([languages.index(x) for x in labels])
    wanted = code[which]
    each = (1 / np.bincount(which))[which][:, None] / len(languages)  # languages count alike
    fast_w, fast_b = weights, bias
    for r in range(ROUNDS):
        pull = each * wanted / (1 + np.exp(wanted * (examples @ fast_w + fast_b)))
        new_w = fast_w + 8.0 * (examples.T @ pull - 1e-5 * fast_w)
        new_b = fast_b + 2.0 * pull.sum(axis=0)
        fast_w, fast_b = new_w + r / (r + 3) * (new_w - weights), new_b + r / (r + 3) * (new_b - bias)
        weights, bias = new_w, new_b
    hits = (each * (wanted * (examples @ weights + bias) > 0)).sum(axis=0)
    trust = np.log(hits.clip(0.5, 0.999) / (1 - hits.clip(0.5, 0.999)))
    trust = trust / trust.mean() if trust.sum() > 0 else np.ones(bits)
    return Model(languages, code, weights.astype(np.float32), bias, trust)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, "_text", 1 << 20):
        made = [features(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["_lang", "_x"])


def _sample(ids: DataFrame) -> DataFrame:
    """_p and _l: SAMPLE different ids of each language, those with the smallest hash.

    A share of the hash range that holds about four times as many is ranked, so what is ranked does
    not grow with the table.
    """
    sizes = ids.groupBy(F.col("_lang").alias("_l")).agg((F.approx_count_distinct("_id") + 1).alias("_size"))
    sizes = materialize(sizes, "languages")
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 31))
    low = place * (F.col("_size") / (1 << 31)) < 4 * SAMPLE
    near = ids.join(sizes, F.col("_lang") == F.col("_l")).filter(low).select(F.col("_id").alias("_p"), "_l", place.alias("_place"))
    order = Window.partitionBy("_l").orderBy("_place", "_p")
    return near.distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= SAMPLE).select("_p", "_l")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from labelled texts of folds 0 and 2, SAMPLE of each language, by hash of the id."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 1)).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text")
    )
    picked = _sample(materialize(known.select("_id", "_lang"), "labelled"))
    # At most SAMPLE ids of each language; of texts that share an id, the smallest.
    chosen = known.join(F.broadcast(picked), F.col("_id").eqNullSafe(F.col("_p")) & (F.col("_lang") == F.col("_l")))
    chosen = chosen.groupBy("_lang", "_id").agg(F.min("_text").alias("_text"))
    rows = (
        chosen.select("_lang", F.col("_text").cast("string").cast("binary").alias("_text"))
        .mapInArrow(_vectors, "_lang string, _x binary")
        .orderBy("_lang", "_x")
        .collect()
    )
    examples = np.array([np.frombuffer(r["_x"], np.float32) for r in rows], np.float32).reshape(len(rows), FEATURES)
    return fit(examples, [r["_lang"] for r in rows])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, lang_pred, score and ambiguous per row, from the whole text alone.

    Null, empty and letterless texts are 'und' with score 0. Repeated rows give repeated rows, an
    empty table none; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text"):
            found = [model.predict(t) for t in batch.column(2).to_pylist()]
            columns = zip(*found) if found else [[], [], []]
            made = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made], names=["_id", "held_out", "lang_pred", "score", "ambiguous"]
            )

    rows = docs.select(
        F.col(id_col).alias("_id"), (fold(id_col) == 1).alias("_held"), F.col(text_col).cast("string").cast("binary").alias("_text")
    )
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    ).withColumnRenamed("_id", id_col)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text ``Model.knows``, with all their columns: rejected are texts without a
    letter (null and empty ones too) and those nearer to no language than a guess."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "_text"):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            yield batch.filter(pa.array([model.knows(t) for t in texts], pa.bool_()))

    # Names that clash travel as numbers.
    rows = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    rows = rows.withColumn("_text", F.col(f"_{at}").cast("string").cast("binary"))
    return rows.mapInArrow(run, rows.schema).drop("_text").toDF(*docs.columns)
