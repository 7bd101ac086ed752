"""Queries over whole tables, one per operator, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (
    bpe, exact_dedup, filter_audit, jaccard_join, language_id, mixing, quality_crf, rlz_dedup, sharding, simhash,
    spelling, tool_calls, warc,
)
from tidecast.llm.oracles import ORACLES
from tidecast.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_crf.judge(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder)


def tokenizer() -> str:
    """The tokenizer file; TOKENIZER_FILE names another one."""
    if "TOKENIZER_FILE" in os.environ:
        return os.environ["TOKENIZER_FILE"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def conversation_calls(conversations: DataFrame) -> DataFrame:
    """Conversations as a log of tool calls: what a user asks is a call of the tool 'answer', made
    after the one two turns before, and what the assistant says next is its result."""
    name = F.concat(F.lit("c"), F.col("conv_id"), F.lit("t"), F.col("turn") - F.when(F.col("role") == "assistant", 1).otherwise(0))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    asked = F.struct(F.col("text").alias("query"), F.col("turn").alias("turn"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(user, "call").when(assistant, "result").otherwise(F.col("role")).alias("kind"),
        F.when(user | assistant, name).alias("call_id"),
        F.when(user, "answer").alias("tool"),
        F.when(user, F.to_json(asked)).alias("arguments"),
        F.when(~user, F.col("text")).alias("content"),
        F.when(user, F.concat(F.lit("c"), F.col("conv_id"), F.lit("t"), F.col("turn") - 2)).alias("after"),
    )


ANSWER = {
    "type": "object",
    "properties": {"query": {"type": "string", "minLength": 40}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["query", "turn"],
    "additionalProperties": False,
}


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_calls(conversation_calls(table(spark, sf_dir, "conversations")), {"answer": ANSWER})


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=13)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), words=3, width=64, radius=3)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"), words=4, similar=(85, 100))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_exact_dedup, op2_quality, op3_warc, op4_bpe, op5_sharding, op6_tool_calls,
        op7_substring_dedup, op8_language_id, op9_mixing, op10_simhash, op11_filter_audit, op12_jaccard_join,
        op13_spelling,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return ORACLES
