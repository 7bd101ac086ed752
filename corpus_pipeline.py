"""From raw documents to token digests of a training corpus, stage by stage.

Every stage is written as Parquet and read again before the next one begins, so a lost executor
costs no more than a part of one stage.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tidecast
from tidecast.llm import bpe, exact_dedup, language_id, mixing, simhash
from tidecast.llm.queries import tokenizer
from tidecast.session import materialize

# Workers need not have the package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(tidecast)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null or without a letter go."""
    return language_id.keep_known(docs, language_id.train(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the longest, then the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8), the one with the smallest id."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once or twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the encoded and the decoded text of every document."""
    return bpe.round_trip(docs, tokenizer())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", tokens),
]

# Classifiers, fingerprints, random rounding and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
