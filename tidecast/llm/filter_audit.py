"""Interaction of filters: what each removes in every order, and its fair share of all removals.

Filters that were applied are a set, and an order of filters is a path through the lattice of such
sets, from none to all. How many documents a filter removes at an edge of the lattice depends on
the set below it alone, not on the order inside it. So every edge is counted once, as a difference
of what its two ends keep. Path counting forwards (orders that reach a set) and backwards (orders
that leave it) tells how many orders use an edge; removals weighted so are the Shapley sums. The
steps of each single order are read from the same edges.

Documents meet as counts per part and set of failed filters, combined before any shuffle; a part
becomes one row of 2^k counts, however many documents it has.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.spread import attach
from tidecast.llm.words import WORD
from tidecast.session import materialize, materialize_observed

MOST_FILTERS = 6  # the result has k! orders of k steps for each part
FLAGS = ("good", "toxic")


def lattice(k: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(set, filter) -> (orders that reach the set, orders that lead from behind the edge to the end)."""
    whole = (1 << k) - 1
    reach, leave = [0] * (whole + 1), [0] * (whole + 1)
    reach[0], leave[whole] = 1, 1
    for s in range(whole + 1):
        for f in range(k):
            if not s >> f & 1:
                reach[s | 1 << f] += reach[s]
    for s in range(whole, -1, -1):
        for f in range(k):
            if not s >> f & 1:
                leave[s] += leave[s | 1 << f]
    return {(s, f): (reach[s], leave[s | 1 << f]) for s in range(whole) for f in range(k) if not s >> f & 1}


def lattice_counts(failed: DataFrame, k: int) -> DataFrame:
    """part and kept_n, kept_good, kept_toxic: of each part, how many rows every set of filters keeps.

    ``failed`` has part, _mask (bit f: fails filter f) and the flags good and toxic.
    """
    size = 1 << k
    sums = [F.count_if(F.col("_mask") == m).alias(f"n{m}") for m in range(size)]
    for flag in FLAGS:
        sums += [F.count_if((F.col("_mask") == m) & F.col(flag)).alias(f"{flag}{m}") for m in range(size)]
    cells = failed.groupBy("part").agg(*sums)

    def kept(name: str) -> Column:
        # A set keeps the rows that fail none of its filters.
        return F.array(*[sum((F.col(f"{name}{m}") for m in range(1, size) if not m & s), F.col(f"{name}0")) for s in range(size)])

    # Stored, as later columns refer to these sums again and again; there is one row per part.
    return materialize(cells.select("part", kept("n").alias("kept_n"), *[kept(x).alias(f"kept_{x}") for x in FLAGS]), "kept")


def step_report(counts: DataFrame, letters: str) -> DataFrame:
    """Every step of every order of the filters ``letters``, from the counts of ``lattice_counts``."""
    k = len(letters)
    whole = (1 << k) - 1

    def kept(s: int | Column, name: str = "n") -> Column:
        return F.col(f"kept_{name}")[s]

    shapley = []
    for f in range(k):
        ways = [(a * b, s) for (s, g), (a, b) in lattice(k).items() if g == f]
        shapley.append(sum((w * (kept(s) - kept(s | 1 << f)) for w, s in ways), F.lit(0)))
    alone = [kept(whole ^ 1 << f) - kept(whole) for f in range(k)]
    fails = [kept(0) - kept(1 << f) for f in range(k)]
    per_filter = counts.withColumns({"_shapley": F.array(*shapley), "_alone": F.array(*alone), "_fails": F.array(*fails)})

    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(letters)])
    ordered = per_filter.withColumn("filter_order", F.explode(orders))
    steps = ordered.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    bits = F.array(*[F.lit(1 << f) for f in range(k)])
    path = F.transform(F.split("filter_order", ""), lambda x: F.instr(F.lit(letters), x) - 1)
    before = F.aggregate(F.slice("_path", F.lit(1), F.col("step") - 1), F.lit(0), lambda s, f: s + bits[f])
    at = steps.withColumn("_path", path).withColumn("_from", before).withColumn("_f", F.col("_path")[F.col("step") - 1])
    at = at.withColumn("_to", F.col("_from") + bits[F.col("_f")])
    removed = kept(F.col("_from")) - kept(F.col("_to"))
    lost = {x: kept(F.col("_from"), x) - kept(F.col("_to"), x) for x in FLAGS}
    return at.select(
        "part",
        "filter_order",
        "step",
        kept(F.col("_to")).alias("kept"),
        removed.alias("removed"),
        (F.col("_fails")[F.col("_f")] - removed).alias("redundant"),
        F.col("_alone")[F.col("_f")].alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        F.col("_shapley")[F.col("_f")].alias("shapley"),
    )


def audit(rows: DataFrame, part: str, failures: dict[str, Column], flags: dict[str, Column]) -> DataFrame:
    """The report of ``step_report`` for the rows of each ``part`` (null: empty string).

    ``failures`` maps one letter per filter to the condition of failing it (null: not failed);
    ``flags`` tells of a row whether it is 'good' and 'toxic'. An empty table gives no rows.
    """
    letters = "".join(failures)
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) != len(failures) or len(letters) != len(failures):
        raise ValueError(f"one to {MOST_FILTERS} filters are needed, each with a letter of its own")
    bits = [F.when(F.coalesce(c, F.lit(False)), 1 << f).otherwise(0) for f, c in enumerate(failures.values())]
    failed = rows.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("_mask"),
        *[F.coalesce(flags[x], F.lit(False)).alias(x) for x in FLAGS],
    )
    return step_report(lattice_counts(failed, len(letters)), letters)


def text_failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """_id, _part, A to D and _text_sha of every row of ``docs``; its text is read once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("_id"), F.col(part_col).alias("_part"), text.alias("_text"))
    found = found.withColumn("_words", F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1)))
    n, capitals = F.size("_words"), F.char_length(F.regexp_replace("_text", "[^A-Z]+", ""))
    return found.select(
        "_id",
        "_part",
        (n < 50).alias("A"),
        (100 * F.size(F.array_distinct("_words")) < 65 * n).alias("B"),
        (100 * capitals > 5 * F.char_length("_text")).alias("C"),
        F.col("_text").rlike("[#$%&*|]").alias("D"),
        F.unhex(F.sha2("_text", 256)).alias("_text_sha"),
    )


def audit_texts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """The audit of five text filters, A to E, over every part of ``docs``.

    Failing is: A, fewer than 50 words; B, fewer distinct words than 65 %; C, more capitals A-Z
    than 5 % of the code points; D, any of ``#$%&*|``; E, a text that a smaller id has as well,
    whatever became of that row. Texts are told apart by SHA-256. ``labels`` has doc_id, quality
    and toxic; of several labels of one id any that says 1 counts.

    A null text is empty. A row with a null id has no smaller id and is none, and it has no label;
    rows that repeat an id with its text fail E only if a smaller id has that text. Other columns
    are ignored, an empty table gives no rows.
    """
    rows, seen = materialize_observed(text_failures(docs, id_col, text_col, part_col), "text-failures", n=F.count("*"))
    first = rows.groupBy("_text_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("n"))
    first = materialize(first.filter("n > 1"), "copied-texts")
    marked = attach(rows, first, "_text_sha", seen["n"] or 0, "_id").drop("n")
    said = labels.groupBy(F.col("doc_id").alias("_label")).agg(
        F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic")
    )
    judged = marked.join(said, F.col("_id") == F.col("_label"), "left")
    failures = {x: F.col(x) for x in "ABCD"} | {"E": F.col("_id") > F.col("_first")}
    return audit(judged, "_part", failures, {"good": F.col("_good"), "toxic": F.col("_toxic")})
