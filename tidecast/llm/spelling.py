"""Spelling variants: words that differ by one code point, and the frequent form of each.

Letters are hashed to a few symbols, so that a word of n letters has a short list of reduced words
one edit away: each letter deleted, each replaced by another symbol, each symbol inserted, and the
reduced word itself, which words have in common whose differing letters share a symbol. Two words
one edit apart are one edit apart, or equal, once reduced. So every word joins its whole
neighbourhood with the reduced vocabulary, finds each near word exactly once, and the edit
distance of the original strings decides inside the join: only true pairs leave it.

A neighbourhood is made as hashes, by arithmetic on the hash of the reduced word: no edited string
is ever built. A mask of the letters of a word goes with them; one edit changes two of its bits at
most, so most chance meetings end before the edit distance. A word has no more near words than its
own one-edit neighbourhood has, so no group of results is unbounded. The number of symbols follows
the vocabulary, which keeps the words of a reduced word few.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.session import materialize, materialize_observed

# Words are runs of these: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_SYMBOLS = 3
TASK_WORDS = 20_000  # whose neighbourhoods are made in one task
WHOLE = 64  # longer words do not travel with each of their reduced neighbours
ASKS = 1 << 18  # neighbours made together
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10  # a form is so many times as frequent as the word
ONE_IN = 31  # of the occurrences that lose a letter


def occurrences(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_LENGTH) -> DataFrame:
    """_run: every run of at least ``least`` letters, A-Z in lower case, one letter short where the
    CRC-32 of the id, a colon and the run says so. A null id counts as empty text."""
    found = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("_raw"),
    )
    runs = found.select("_id", F.translate("_raw", UPPER, LOWER).alias("_run"))
    drawn = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.char_length("_run")))
    return drawn.select(F.when(F.col("_h") % ONE_IN == 0, shorter).otherwise(F.col("_run")).alias("_run"))


def vocabulary(runs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the runs that are long and frequent enough; counted before the shuffle."""
    counts = runs.filter(F.char_length("_run") >= least_length).groupBy(F.col("_run").alias("word")).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def symbols_for(words: int) -> int:
    """Symbols for a vocabulary: few make short neighbourhoods, more keep the words of a reduced word few."""
    return max(LEAST_SYMBOLS, int(words ** (1 / 11)))


def symbol_table(symbols: int) -> np.ndarray:
    """The symbol, from 1, of each letter by its code point."""
    return np.array([1 + zlib.crc32(chr(c).encode()) % symbols for c in range(256)], np.uint64)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points of words of equal length, ASKS letters at a time or one word's."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        step = max(1, ASKS // max(size, 1))
        for k in range(0, len(places), step):
            some = places[k : k + step]
            codes = np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le"), np.uint32)
            yield some, codes.reshape(len(some), size)


def letter_mask(codes: np.ndarray) -> np.ndarray:
    """31 bits that tell which letters a word has; the sign is left alone, as Spark counts it as many bits."""
    bits = np.uint32(1) << ((codes * np.uint32(0x9E3779B1) >> np.uint32(16)) % np.uint32(31))
    return np.bitwise_or.reduce(bits, axis=1).view(np.int32)


def word_keys(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hash of each reduced word: symbols times powers of BASE."""
    return (table[codes] * _powers(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def neighbour_keys(codes: np.ndarray, table: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of all that is at most one edit away from each reduced word, each once.

    Equal results come about only next to a symbol's own copies, so of a run only the first is
    deleted, and nothing is inserted behind its own like.
    """
    reduced = table[codes]
    n, size = reduced.shape
    power = _powers(size)
    terms = reduced * power[:-1]
    whole = terms.sum(axis=1, dtype=np.uint64)
    head = np.zeros((n, size + 1), np.uint64)
    np.cumsum(terms, axis=1, dtype=np.uint64, out=head[:, 1:])
    rows = np.arange(n)
    yield rows, whole
    first = np.ones((n, size), bool)
    first[:, 1:] = reduced[:, 1:] != reduced[:, :-1]
    at = np.nonzero(first)
    yield at[0], (head[:, :-1] + (whole[:, None] - head[:, 1:]) * BACK)[at]
    for symbol in np.arange(1, symbols + 1, dtype=np.uint64):
        at = np.nonzero(reduced != symbol)
        yield at[0], (whole[:, None] + (symbol - reduced) * power[:-1])[at]
        new = np.ones((n, size + 1), bool)
        new[:, 1:] = reduced != symbol
        at = np.nonzero(new)
        yield at[0], (head + symbol * power + (whole[:, None] - head) * BASE)[at]


def _neighbours(symbols: int, with_word: bool) -> Callable:
    """From _no and word: the word or its _no, its mask, and the hash of each of its neighbours."""
    table = symbol_table(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column(1 if with_word else 0)
            for places, codes in by_length(batch.column(1).to_pylist()):
                masks = letter_mask(codes)
                for rows, keys in neighbour_keys(codes, table, symbols):
                    for k in range(0, len(rows), ASKS):
                        own = rows[k : k + ASKS]
                        yield pa.RecordBatch.from_arrays(
                            [named.take(pa.array(places[own])), pa.array(masks[own]), pa.array(keys[k : k + ASKS].view(np.int64))],
                            names=["_word", "_mask", "_ask"],
                        )

    return run


def _keyed(symbols: int) -> Callable:
    table = symbol_table(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, keys = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.uint64)
            for places, codes in by_length(batch.column(0).to_pylist()):
                masks[places], keys[places] = letter_mask(codes), word_keys(codes, table)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(masks), pa.array(keys.view(np.int64))], names=["near", "near_n", "_near_mask", "_known"]
            )

    return run


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """word, near and near_n: each ordered pair of words (_no, word, n) exactly one edit apart, once.

    Reduced words meet by a hash; the distance of the original strings has the last word.
    """
    known = words.select("word", "n").mapInArrow(_keyed(symbols), "near string, near_n long, _near_mask int, _known long")
    meet = (F.col("_ask") == F.col("_known")) & (F.bit_count(F.col("_mask").bitwiseXOR(F.col("_near_mask"))) <= 2)
    short = words.filter(F.char_length("word") <= WHOLE).select("_no", "word")
    asks = short.mapInArrow(_neighbours(symbols, True), "_word string, _mask int, _ask long")
    found = asks.join(known, meet & (F.levenshtein("_word", "near", 1) == 1)).select(F.col("_word").alias("word"), "near", "near_n")
    long = words.filter(F.char_length("word") > WHOLE).select("_no", "word")
    if long.isEmpty():
        return found
    asks = long.mapInArrow(_neighbours(symbols, False), "_word long, _mask int, _ask long")
    maybe = asks.join(known, meet).join(long, F.col("_word") == F.col("_no"))
    return found.unionAll(maybe.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n"))


def forms(words: DataFrame, symbols: int, times: int = TIMES) -> DataFrame:
    """word, n, n_near, form and form_n of every row of ``words`` (_no, word, n; one row per word)."""
    best = F.struct((-F.col("near_n")).alias("least"), "near")
    found = near_pairs(words, symbols).groupBy(F.col("word").alias("_word")).agg(F.count("*").alias("_near"), F.min(best).alias("_best"))
    joined = words.join(found, F.col("word") == F.col("_word"), "left")
    enough = -F.col("_best.least") >= times * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("_best.near")).alias("form"),
        F.when(enough, -F.col("_best.least")).alias("form_n"),
    )


def with_root(found: DataFrame) -> DataFrame:
    """``found`` (word, form, ...) with root, the last form on the way from each word.

    A form is more frequent than its word, so there are no circles. Ways are doubled in every
    round and only words that have a form take part.
    """
    ways, seen = materialize_observed(
        found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms", n=F.count("*")
    )
    moved = seen["n"]
    while moved:
        above = ways.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        ways, seen = materialize_observed(
            ways.join(above, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_on")),
            "roots",
            on=F.count_if("_on"),
        )
        ways, moved = ways.drop("_on"), seen["on"]
    last = ways.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
    return found.join(last, F.col("word") == F.col("_w"), "left").drop("_w").select(
        *found.columns, F.coalesce("_r", "word").alias("root")
    )


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    A word's form is its near word (exactly one code point inserted, deleted or replaced) that is
    most frequent, of several the smallest in code-point order, if it is at least TIMES as frequent
    as the word. Null and empty texts have no words; rows repeated count again; an empty table
    gives no rows; other columns are ignored.
    """
    counted = vocabulary(occurrences(docs, id_col, text_col)).withColumn("_no", F.monotonically_increasing_id())
    words, seen = materialize_observed(counted, "vocabulary", n=F.count("*"))
    total = seen["n"] or 0
    spread = words.repartition(-(-total // TASK_WORDS) or 1)
    found = materialize(forms(spread, symbols or symbols_for(total)), "forms-of-words")
    return with_root(found).select("word", "form", "root", "n", "n_near", "form_n")
