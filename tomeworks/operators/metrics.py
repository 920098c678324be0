"""Confusion counts and the measures derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, *by: str) -> DataFrame:
    """(*by, label, prediction, n)."""
    return predictions.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def accuracy(predictions: DataFrame, *by: str) -> DataFrame:
    """(*by, n_docs, accuracy)."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return predictions.groupBy(*by).agg(F.count("*").alias("n_docs"), F.avg(hit).alias("accuracy"))


def _cell(label: float, prediction: float) -> Column:
    in_cell = (F.col("label") == label) & (F.col("prediction") == prediction)
    return F.sum(F.when(in_cell, F.col("n")).otherwise(F.lit(0)))


def binary_metrics(counts: DataFrame, *by: str) -> DataFrame:
    """All measures of a binary classifier from confusion counts; 0/0 gives NULL."""
    cells = counts.groupBy(*by).agg(
        F.sum("n").alias("n_docs"),
        _cell(1.0, 1.0).alias("true_pos"),
        _cell(0.0, 1.0).alias("false_pos"),
        _cell(0.0, 0.0).alias("true_neg"),
        _cell(1.0, 0.0).alias("false_neg"),
    )
    tp, fp, tn, fn, n = (F.col(c) for c in ("true_pos", "false_pos", "true_neg", "false_neg", "n_docs"))
    return cells.select(
        *by,
        "n_docs",
        (tp + fn).alias("positives"),
        (fp + tn).alias("negatives"),
        "true_pos",
        "false_pos",
        "true_neg",
        "false_neg",
        F.try_divide(fp + fn, n).alias("error_rate"),
        F.try_divide(tp + tn, n).alias("accuracy"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tn, tn + fp).alias("specificity"),
    )
