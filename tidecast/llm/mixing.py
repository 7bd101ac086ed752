"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted ``target / source_size`` times, a whole number of copies
and a fraction. Fractions are rounded in pairs: words move at random from one document to the
other until one of the two fractions is 0 or 1, which keeps the words taken unchanged and each
document's expectation as well. What is left of a leaf of documents, one fraction, is paired
with those of other leaves, level by level, until one is left per source; a last draw rounds it.
So a source misses its target by less than one document. Of rows that repeat id, source and size
all but one are rounded at once: their fractions add up to a whole number of further copies, and
what is left is the fraction of one row.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.spread import attach, number_rows
from tidecast.llm.words import WORD
from tidecast.session import materialize, materialize_observed

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2.0  # times the words of a source
LEAF = 5_000  # documents rounded in one group
FAN_IN = 1_000  # leaves combined in one group of the next level
EDGE = 1e-9


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, n (documents), target: words to take from each source.

    ``sizes`` has one row per source. Sources in code-point order, null last, weigh 5, 2, 1 and
    so on; what a source cannot take beyond its bound goes to the others by weight. Only sums
    over all sources are gathered, once for each round of bounds reached.
    """
    n = sizes.count()
    ranked = number_rows(sizes, n, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("row_no") % len(WEIGHTS) + 1).cast("int"))
    ranked = materialize(
        ranked.select("source", "source_size", "n", weight.cast("double").alias("_weight")), "sources"
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    unit, before = 0.0, None
    while before is None or unit > before:
        bounded = MOST * F.col("source_size") <= F.col("_weight") * unit if before is not None else F.lit(False)
        at, free = ranked.agg(
            F.sum(F.when(bounded, MOST * F.col("source_size"))), F.sum(F.when(~bounded, F.col("_weight")))
        ).first()
        before, unit = unit, (SHARE * total - (at or 0.0)) / free if free else unit
    target = F.least(MOST * F.col("source_size"), F.col("_weight") * unit)
    return ranked.select("source", "source_size", "n", target.alias("target"))


def pivot(weights: list[int], parts: list[float], draw: random.Random) -> list[int | None]:
    """Each fraction rounded to 0 or 1; None for the one that may be left, its part in ``parts``."""
    done: list[int | None] = [None] * len(parts)

    def settle(i: int) -> bool:
        if EDGE < parts[i] < 1 - EDGE:
            return False
        done[i] = int(parts[i] > 0.5)
        return True

    left = -1
    for i in range(len(parts)):
        if settle(i):
            continue
        if left >= 0:
            a, b = weights[left], weights[i]
            up = min(a * (1 - parts[left]), b * parts[i])
            down = min(a * parts[left], b * (1 - parts[i]))
            move = up if draw.random() * (up + down) < down else -down
            parts[left] += move / a
            parts[i] -= move / b
            if settle(left):
                left = -1
        if not settle(i):
            left = i
    return done


def round_group(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    """Rounds the fractions of one group; at the last level the one left over as well."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_id", "ascending"), ("size", "ascending")])
        parts = rows["_part"].to_pylist()
        draw = random.Random(f"{level} {rows['_source'][0]} {rows['_group'][0]}")
        done = pivot(rows["_weight"].to_pylist(), parts, draw)
        if last:
            done = [int(draw.random() < p) if d is None else d for d, p in zip(done, parts)]
        for name, values in (("_part", pa.array(parts, pa.float64())), ("_copies", pa.array(done, pa.int32()))):
            rows = rows.set_column(rows.column_names.index(name), name, values)
        return rows

    return run


def copies(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per distinct (_id, _source, size) of ``docs``: source_size, target, its rows _m, the
    _copies to take of each and _more, of how many of them one copy more."""
    sized = docs.select(F.col(id_col).alias("_id"), _source(source_col), word_count(text_col).alias("size"))
    items = materialize(sized.groupBy("_id", "_source", "size").agg(F.count("*").alias("_m")), "items")
    by_source = items.groupBy("_source").agg(
        F.sum(F.col("size") * F.col("_m")).alias("source_size"), F.sum("_m").alias("n")
    )
    named = F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30))
    targets, seen = materialize_observed(
        source_targets(by_source.withColumn("source", named)).select(
            _source("source"), "source_size", "n", "target"
        ),
        "targets",
        total=F.sum("n"),
    )
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = (
        attach(items, targets, "_source", seen["total"] or 0, "_id", "size")
        .withColumn("_whole", F.floor(ratio + EDGE).cast("int"))
        .withColumn("_parts", F.greatest(ratio - F.col("_whole"), F.lit(0.0)) * F.col("_m"))
        .withColumn("_sure", F.least(F.floor(F.col("_parts") + EDGE), "_m"))
        .withColumn("_part", F.greatest(F.col("_parts") - F.col("_sure"), F.lit(0.0)))
        .withColumn("_weight", F.col("size"))
        .withColumn("_group", F.pmod(F.xxhash64("_id", "size"), F.ceil(F.col("n") / LEAF)))
        .withColumn("_copies", F.lit(None).cast("int"))
    )
    settled, level, groups = [], 0, None
    while groups is None or groups > 0:
        last = groups == 1
        rounded, seen = materialize_observed(
            wanted.groupBy("_source", "_group").applyInArrow(round_group(level, last), wanted.schema),
            "rounded",
            most=F.max(F.when(F.col("_copies").isNull(), F.col("_group"))),
        )
        settled.append(rounded.filter(F.col("_copies").isNotNull()))
        groups = 0 if seen["most"] is None else int(seen["most"]) // FAN_IN + 1
        wanted = rounded.filter(F.col("_copies").isNull()).withColumn("_group", F.floor(F.col("_group") / FAN_IN))
        level += 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    return out.select(
        "_id", "_source", "size", "_m", "source_size", "target",
        F.col("_whole").alias("_copies"), (F.col("_sure") + F.col("_copies")).alias("_more"),
    )


def _source(column: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("")).alias("_source")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id_col, size, source_size, target and taken, the words that the mix takes, per row.

    Of rows that repeat id, source and size, some may be taken once more than others. Texts without
    words take nothing; a null source is one source; an empty table gives no rows.
    """
    plan = copies(docs, id_col, text_col, source_col)
    return plan.select(
        F.explode(F.sequence(F.lit(1).cast("long"), "_m")).alias("_i"), "*"
    ).select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        (_taken(F.col("_i")) * F.col("size")).alias("taken"),
    )


def _taken(place: Column) -> Column:
    """Copies of the row at ``place``, from 1, among those that repeat its id, source and size."""
    return F.col("_copies") + F.when(place <= F.col("_more"), 1).otherwise(0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns.

    Of rows that repeat id, source and size, those with the smallest hashes are taken most often.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(
        F.col(id_col).alias("_i"), _source(source_col).alias("_s"), word_count(text_col).alias("_n"), whole
    )
    plan, seen = materialize_observed(
        copies(docs, id_col, text_col, source_col), "plan", again=F.sum(F.when(F.col("_m") > 1, F.col("_m")))
    )
    plan = plan.select("_id", "_source", "size", "_m", "_copies", "_more")
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_source") == F.col("_s")) & (F.col("size") == F.col("_n"))
    planned = rows.join(plan, same)
    single = planned if not seen["again"] else planned.filter("_m = 1")
    out = single.withColumn("_place", F.lit(1).cast("long"))
    if seen["again"]:
        out = out.unionByName(_numbered(planned.filter("_m > 1"), seen["again"]))
    times = out.withColumn("_times", _taken(F.col("_place"))).filter("_times > 0")
    return times.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_k")).select("_row.*")


def _numbered(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with their _place, from 1, among those with equal id, source and size, in order of hash.

    Positions among all rows are taken first, so no group is held in one task.
    """
    keys = ["_i", "_s", "_n"]
    salted = materialize(rows.withColumn("_hash", F.xxhash64("_row")).withColumn("_salt", F.monotonically_increasing_id()), "repeats")
    places = number_rows(salted.select(*keys, "_hash", "_salt"), n, *keys, "_hash", "_salt", name="_at")
    starts = places.groupBy(*keys).agg(F.min("_at").alias("_from"))
    starts = starts.select(*[F.col(k).alias(f"{k}_") for k in keys], "_from")
    equal = F.col("_i").eqNullSafe(F.col("_i_")) & (F.col("_s") == F.col("_s_")) & (F.col("_n") == F.col("_n_"))
    placed = places.join(starts, equal).select(F.col("_salt").alias("_p"), (F.col("_at") - F.col("_from") + 1).alias("_place"))
    return salted.join(placed, F.col("_salt") == F.col("_p")).drop("_p", "_hash", "_salt")
