"""Exact duplicates: rows whose texts are the same bytes once white space is deleted.

Texts are grouped by the 128-bit hash of their normal form *and* by that form itself, so Spark
compares the bytes inside each hash group while it aggregates and a collision splits the group.
Copies meet first inside each task, hence a group with a third of all rows reaches the shuffle
as a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.spread import attach, one_each
from tidecast.llm.words import SPACES
from tidecast.session import materialize_observed


def normal_form(text: str) -> Column:
    """The text without its white space; null counts as empty."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACES, "")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """One row per distinct normal form, and the number of rows of ``docs``.

    sha: SHA-256 of the form in lower-case hex; n: rows; keep_chars, keep_id: code points and id
    of the row that stays, the longest original and among those the smallest id. A null id stays
    only if no other row is as long.
    """
    form = normal_form(text_col)
    sizes = (
        docs.select(
            F.col(id_col).alias("_id"),
            F.unhex(F.md5(form)).alias("_hash"),
            form.alias("_form"),
            _chars(text_col),
        )
        .groupBy("_hash", "_form", "_chars")
        .agg(F.min("_id").alias("_id"), F.count("*").alias("_n"))
        .select(F.sha2("_form", 256).alias("sha"), "_chars", "_id", "_n")
    )
    kept = sizes.groupBy("sha").agg(
        F.sum("_n").alias("n"),
        F.max("_chars").alias("keep_chars"),
        F.max_by("_id", "_chars").alias("keep_id"),
    )
    kept, seen = materialize_observed(kept, "text-classes", total=F.sum("n"))
    return kept, seen["total"] or 0


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    Rows that repeat both id and text of the row that stays are that document and are kept with
    it. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), _chars(text_col), F.sha2(normal_form(text_col), 256).alias("text_sha256")
    )
    groups, total = classes(docs, id_col, text_col)
    found = attach(rows, groups.withColumnRenamed("sha", "text_sha256"), "text_sha256", total, "_id")
    return found.select(
        F.col("_id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        _stays().alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of ``docs``, with all its columns; of rows that share the id and length
    that stay, the one with the smallest hash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(
        F.col(id_col).alias("_id"), _chars(text_col), F.sha2(normal_form(text_col), 256).alias("sha"), whole
    )
    groups, total = classes(docs, id_col, text_col)
    again = rows.groupBy("sha", "_id", "_chars").agg(F.count("*").alias("_k")).filter("_k > 1").select("sha").distinct()
    stay = attach(rows, groups, "sha", total, "_id").filter(_stays()).select("sha", "_row")
    return one_each(stay, "sha", again).select("_row.*")


def _chars(text: str) -> Column:
    return F.char_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long").alias("_chars")


def _stays() -> Column:
    return F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_chars") == F.col("keep_chars"))
