"""The corpus operators' queries, each over its whole table with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import chat, decontaminate, media, mixing, near_dedup, quality, substring_dedup, suffix_dedup, token_counts, token_output
from quire.llm.common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.digest_conversations(chat.format_conversations(rows))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(spark, documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read_tokens(token_output.write_tokens(spark, documents(spark, sf_dir)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(spark, documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_matches(spark, documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest_media(media.to_media(documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_near_dedup": op5_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_output": op7_token_output,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_media": op10_media,
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.oracle(),
    "op2_decontamination": decontaminate.ORACLE,
    "op5_near_dedup": near_dedup.ORACLE,
    "op6_substring_dedup": substring_dedup.oracle(35),
    "op9_suffix_dedup": substring_dedup.oracle(50),
}
