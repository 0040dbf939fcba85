"""The corpus pipeline: each stage takes the documents its predecessor kept and writes what it keeps.

Every stage but the last returns the columns of ``documents``; the last one returns the token
counts and digests of what is left. Null texts, empty tables and further columns go through
as the operators of each stage define it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchshift.llm import bpe, decontaminate, near_dup, pii, quality
from searchshift.llm.queries import DEMONSTRATION_KEY, vocabulary
from searchshift.session import materialized


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates on runs of five words, the one with the least id."""
    return near_dup.one_of_each(docs, words=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts and lengths to match."""
    changed = pii.pseudonymize(docs, DEMONSTRATION_KEY)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        changed = changed.withColumn("n_chars", length)
    return changed


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.digests(docs, vocabulary())


STAGES = [
    ("quality rules", quality_stage),
    ("near dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", encoding_stage),
]

#: Cutoffs, tokens and pseudonyms are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
