"""A corpus made ready for training: five stages, each on what the one before kept.

Every stage is written as Parquet and read again by the next.  All but the last
return the columns of ``documents``; the last adds the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tomeworks.llm import bpe, decontaminate, line_dedup, near_dup, quality_rules
from tomeworks.llm.common import documents
from tomeworks.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.stage_docs(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that occurred before go, and documents that consisted of nothing else."""
    return line_dedup.stage_docs(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    return near_dup.stage_docs(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.decontaminate(docs, decontaminate.benchmark_table(spark, sf_dir))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and how many there are."""
    return bpe.encode(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

# The searches of stages 2 to 5 have no SQL form; the tests compare the whole with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
