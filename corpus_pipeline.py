"""A training-data pipeline over ``documents``: five stages, each of which works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.linededup import dedup_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_sequences
from tidemark.llm.quality import decision_column, fit_quality_rules, text_statistics, with_ratios
from tidemark.llm.queries import LINE_EDITS, LINE_NEAR_CHARS, tokenizer_path
from tidemark.llm.shared import cut, delete_folder, ensure_checkpoint_dir, few, keep_ids, release, table, word_count

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Labelled rows that the quality rules are learned from, at most.
MAX_LABELLED = 20_000

#: Five words and a similarity of 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no learned rule rejects. The rules are learned from labelled rows and judge each row by its own text."""
    labels = table(spark, sf_dir, "labels").where("quality is not null and doc_id is not null").select("doc_id", "quality")
    sample = cut(labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(MAX_LABELLED))
    labelled = keep_ids(docs, sample.select("doc_id").distinct(), "doc_id", MAX_LABELLED)
    rules = fit_quality_rules(text_statistics(labelled, ["doc_id"]), sample, MAX_LABELLED)
    judged = with_ratios(text_statistics(docs, COLUMNS))
    return judged.where(decision_column(rules) == 0).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has or nearly has; a document that consisted of such lines goes."""
    left = dedup_lines(docs.select(*COLUMNS), LINE_EDITS, LINE_NEAR_CHARS).where("n_removed = 0 or n_removed < n_lines")
    changed = F.col("n_removed") > 0
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect, the one of least doc_id.

    Rows are told apart by doc_id and text, so a row goes by its own text only; rows equal in both are one document, and stay or go
    together, as do rows without a doc_id, which stay.
    """
    # Text that sorts like the id: its hexadecimal digits with the sign turned.
    order = F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    named = docs.select(*COLUMNS, F.concat(order, F.lit(":"), F.hex(F.xxhash64("text"))).alias("_row"))
    components = jaccard_components(named.select(F.col("_row").alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT, 100)
    losers = cut(components.where("component_id < doc_id").select(F.col("doc_id").alias("_row")).distinct())
    side = F.broadcast(losers) if few(losers, losers.count()) else losers
    return named.join(side, "_row", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them; each row by its own count, with or without a doc_id."""
    mixed = mix_sources(docs.select(*COLUMNS, word_count(F.col("text")).alias("size"))).where("repeats > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces in sequences of 2048."""
    return pack_sequences(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: The learned rules and the tokenizer can't be said in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again.

    A stage's folder goes when the next one's is written; the last stays, because the result reads it.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete_folder(spark, before)
        before = f"{folder}/{name}"
        release(spark)
    return docs
