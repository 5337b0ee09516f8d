"""Corpus pipeline over ``documents``: quality rules, n-gram Jaccard join, substring
dedup, benchmark decontamination, mixing.

Each stage works on every row the one before kept; what a stage decides is what
the next one reads.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import decontaminate, jaccard_join, mixing, quality_rules, substring_dedup
from reelhouse.llm.common import stored, table

# near-duplicates here: five-word shingles, similarity of 0.8 or more
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return jaccard_join.keep_first(docs, SHINGLE, PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that start earlier in the corpus are cut; n_chars follows the text."""
    cut = substring_dedup.deduplicate_text(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each remaining document is taken for the target mix of sources."""
    return mixing.taken(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_free),
    ("source_mixing", mixture),
]

# Expectation-maximisation, minimisers' connected components and rounding are not SQL;
# tests/llm/test_pipeline.py holds the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
