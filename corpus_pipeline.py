"""The corpus pipeline: language ID, exact dedup, near dedup, benchmark decontamination, packing.

Every stage takes the documents that the one before kept, read from Parquet, and applies its operator's decisions to the
rows; all columns pass through untouched up to packing, which returns the pieces of the training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkwh.llm import decontamination, exact_dedup, language, near_dedup, packing
from sparkwh.llm.batches import small_batches
from sparkwh.llm.filters import without
from sparkwh.llm.queries import vocabulary_path
from sparkwh.session import stage

# Score of the best language from which a text counts as being in it; with four languages chance alone gives 0.25.
LEAST_SCORE = 0.4
# Near duplicates on shingles of five words, links at a similarity of 0.8 or more.
NEAR = near_dedup.NearParameters(shingle=5)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is in none of the learned languages: NULL, without letters, or with less than
    ``LEAST_SCORE`` for the best one. If nothing has a label to learn from, only texts without letters go."""
    small_batches(spark)
    return language.keep_identified(docs, language.fit(docs), least_score=LEAST_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of texts that are equal but for white space. Rows without a ``doc_id`` go."""
    small_batches(spark)
    return exact_dedup.keep_one(docs, exact_dedup.exact_groups(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest ``doc_id`` of every component; rows that share a ``doc_id`` stay if one of them does."""
    small_batches(spark)
    groups = near_dedup.near_groups(docs, NEAR).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return without(docs, stage(groups.where("not kept and doc_id is not null").select("doc_id"), "near_copies"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item. Rows with NULL ``doc_id`` or text stay."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.overlaps(docs, benchmark).select("doc_id").distinct()
    return without(docs, stage(leaks, "leaks"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences; a NULL or empty text is its end mark alone. See ``packing.pack``."""
    small_batches(spark)
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

# Classifier, sketches and token merging have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each writes what it keeps and the next one reads it. An empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
