"""Fold numbers and train/test/validate splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.ordering import dense_sequence

FOLDS = 10

# The folds that make up each part of a split plan.
SPLIT_PLANS: dict[str, dict[str, list[int]]] = {
    "7/3": {"train": [0, 1, 2, 3, 4, 5, 6], "test": [7, 8, 9]},
    "7/2/1": {"train": [0, 1, 2, 3, 4, 5, 6], "test": [7, 8], "validate": [9]},
    "4/3/3": {"train": [0, 1, 2, 3], "test": [4, 5, 6], "validate": [7, 8, 9]},
}


def cyclic_folds(docs: DataFrame, key: str = "doc_id", folds: int = FOLDS, start: int = 0) -> DataFrame:
    """(key, fold): folds dealt out in turn in key order, so their sizes differ by one at most.

    ``start`` documents have been dealt before.
    """
    position = F.col("position") + F.lit(start)
    return dense_sequence(docs, key).select(key, F.pmod(position, F.lit(folds)).cast("int").alias("fold"))


def hashed_fold(key: Column, folds: int = FOLDS) -> Column:
    """A fold from the key alone: no ordering and no shuffle, sizes only nearly equal."""
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def split_of(fold: Column, plan: str | dict[str, list[int]]) -> Column:
    """The part of the split plan a fold belongs to."""
    parts = SPLIT_PLANS[plan] if isinstance(plan, str) else plan
    split = F.lit(None).cast("string")
    for name, members in parts.items():
        split = F.when(fold.isin(members), F.lit(name)).otherwise(split)
    return split


def split_sizes(examples: DataFrame) -> DataFrame:
    return examples.groupBy("split").agg(F.count("*").alias("n_docs"))
