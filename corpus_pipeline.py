"""Corpus pipeline: quality, near duplicates, contamination, mixing, token files; each stage on all that the one before kept.

Every stage but the last returns its documents with the columns of the table. Decisions are of rows, not of doc_ids, so rows
without a doc_id or with one that others have go through all stages like any other. Null and empty texts pass the first three stages;
an empty table gives empty results; further columns are carried along, whatever their names, but for _key, _id, _text and repeated. A stage's
tables in the shared folder are dropped when the next stage starts, as its result has been written by then; the last one's stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, mixing, near_dedup, quality, token_output
from quire.llm.common import Workspace, live_workspaces
from quire.shipping import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_ours: list[Workspace] = []


def key_of(docs: DataFrame) -> Column:
    """A 64-bit hash of the row; rows of equal values share it and any decision that comes from the values."""
    return F.xxhash64(*docs.columns, *(F.isnull(c) for c in docs.columns))


def keep(docs: DataFrame, decided: DataFrame, wanted: str) -> DataFrame:
    """The rows of docs whose key is wanted in the decisions, where it is the column _key."""
    keys = decided.where(wanted).select("_key").distinct()
    return docs.withColumn("_key", key_of(docs)).join(keys, "_key", "left_semi").select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with the rows' keys instead of their ids."""
    return docs.withColumn("doc_id", key_of(docs))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality models keep. Labels are found by doc_id, so equal rows share a fate; rows without text, label or doc_id are judged by what they have."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("long").alias("_id"), "quality", "toxic")
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), key_of(docs).alias("doc_id"))
    decided = quality.classify(spark, keyed(docs), rows.join(labels, "_id").select("doc_id", "quality", "toxic"))
    return keep(docs, decided.withColumnRenamed("doc_id", "_key"), "kept")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group; texts without words are in no group. Of rows of equal id and text the least by its other columns stays."""
    rows, blank = docs.select("*", near_dedup.safe_id().alias("_id"), near_dedup.text_id().alias("_text")), ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = rows.join(near_dedup.NearGroups(spark, docs).heads().select(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text"), "repeated"), ["_id", "_text"])
    one = kept.where("repeated").groupBy("_id", "_text").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return docs.where(blank).unionByName(kept.where("not repeated").select(*docs.columns)).unionByName(one)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window; rows without words have none, and equal rows share a fate."""
    decided = decontaminate.decontaminate(spark, keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return keep(docs, decided.withColumnRenamed("doc_id", "_key"), "not contaminated")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a doc_id are drawn by their keys, each for itself."""
    rows = docs.withColumn("_key", key_of(docs)).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), "_key"))
    return keep(docs, mixing.mix(spark, rows, carry=("_key",)), "sampled")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document from the token files; a null text has its end id only, a null doc_id stays null."""
    return token_output.read_tokens(token_output.write_tokens(spark, docs))


def staged(function: Stage, last: bool) -> Stage:
    """The stage with its tables dropped when the next one starts; the last one's stay, as the result of a run reads them."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        while _ours:
            _ours.pop().drop()
        before = live_workspaces()
        out = function(spark, docs, sf_dir)
        if not last:
            _ours.extend(w for w in live_workspaces() if w not in before)
        return out

    return run


STAGES: list[tuple[str, Stage]] = [(name, staged(f, f is tokens)) for name, f in (("quality", classify), ("near_dedup", dedup), ("decontamination", clean), ("mixing", mix), ("token_output", tokens))]

#: Models and token files cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; each result but the last is written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
