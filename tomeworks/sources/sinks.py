"""Writers.  Every table is written in one distributed job, never per document."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tomeworks.sources.manifest import manifest_lines


def save_table(df: DataFrame, path: str) -> None:
    """TF bags, document frequencies, IDF, subject counts: one Parquet table each."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """File statuses of a resumed audit and rows of experiment metrics."""
    df.write.mode("append").parquet(path)


def save_by_fold(df: DataFrame, path: str) -> None:
    """Vectors laid out by fold, so that a split reads only its own folders."""
    df.write.mode("overwrite").partitionBy("fold").parquet(path)


def save_manifest_lines(manifest: DataFrame, path: str, trailing_comma: bool = False) -> None:
    manifest_lines(manifest, trailing_comma).write.mode("overwrite").text(path)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Exclusion lists, metadata and metrics for use outside Spark."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)
