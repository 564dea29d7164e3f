"""Documents to a training mix: language, near duplicates, repeated passages, benchmark passages, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casefeatures.llm import decontaminate, jaccard, language, mixing, suffixes
from casefeatures.sources.files import scratch_path, scratch_run, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no learned language go."""
    return language.kept(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of passages of 50 words and more are cut out; the first occurrence stays."""
    return suffixes.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.removed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.taken_rows(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]
#: Learned filters, components and balanced draws are not for SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before kept; every stage's rows are written and read again.

    The tables a stage needs for itself are removed once its rows are written; the rows of the stages stay in the shared folder.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_run(spark, f"{name}-run"):
            docs = written(stage(spark, docs, sf_dir), path)
    return docs
