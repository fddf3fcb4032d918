"""A training corpus from raw documents: filter, deduplicate, cut repeats, redact, pack.

Every stage is a function of ``(spark, docs, sf_dir)``; its rows are written and read again as the
next one's ``docs``. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cauce.llm.packing import pack_documents
from cauce.llm.registry import findable
from cauce.llm.rules import quality_rules
from cauce.llm.secrets import redact_secrets
from cauce.llm.simhash import keep_one
from cauce.llm.substrings import cut_repeats
from cauce.sources.scratch import materialise


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text, and ``n_chars`` counted anew where there is such a column."""
    changed = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, out="_quality").filter("_quality.kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    findable(spark)
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that an earlier document has are cut; texts that lose nothing stay as they are."""
    findable(spark)
    cut = cut_repeats(docs, out="_cut")
    text = F.when(F.col("_cut.n_removed") > 0, F.col("_cut.text")).otherwise(F.col("text"))
    return _with_text(cut, text).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, are replaced by a mark."""
    findable(spark)
    return _with_text(redact_secrets(docs), F.col("text")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their training sequences."""
    findable(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeats),
    ("secret_scans", secrets),
    ("packing", packing),
]

#: Fingerprints, decoded layers and packing are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
