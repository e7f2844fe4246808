"""Corpus pipeline: quality rules, near-duplicate join, substring dedup, secret
scan and packing over the documents table.

Every stage works on all rows that its predecessor kept and returns the
columns of documents (the last one the packed pieces).  :func:`run` writes
each stage's output to the shared folder and reads it back, so a lost
executor repeats one stage's tasks at most; the tables before the last are
deleted once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regpanel.llm import packing, parity_join, quality, secret_scan, substring
from regpanel.llm.common import Scratch


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars after the text was changed, where the table has the column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group of near duplicates (5-word shingles, 80 per cent)."""
    return parity_join.keep_one(docs, k=5, similarity=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur twice."""
    return _counted(substring.remove(docs))


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the reported secrets blacked out."""
    return _counted(secret_scan.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 4096 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan_stage),
    ("packing", pack),
]

#: SQL cannot tokenize; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return docs
