"""Parquet tables: the storage of every typed input and feature table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_features(spark: SparkSession, path: str, folds: Iterable[int] | None = None) -> DataFrame:
    """A saved feature table; with ``folds`` only those fold folders are read."""
    table = spark.read.parquet(path)
    return table if folds is None else in_folds(table, folds)


def in_folds(df: DataFrame, folds: Iterable[int]) -> DataFrame:
    """Rows of the named folds; on a table partitioned by fold this prunes folders."""
    return df.where(F.col("fold").isin([int(f) for f in folds]))


def names_table(spark: SparkSession, names: Iterable[str], column: str = "file") -> DataFrame:
    """A one-column table from a short list given in code."""
    return spark.createDataFrame([(n,) for n in names], f"{column} string")
