"""Labelled examples: vectors, labels and splits put together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.folds import split_of
from tomeworks.operators.subjects import label_array


def training_set(
    vectors: DataFrame,
    manifest: DataFrame,
    names: list[str],
    plan: str | dict[str, list[int]] = "7/2/1",
) -> DataFrame:
    """(doc_id, fold, split, labels, vec) of the manifest's documents.

    One row per document with a label for each subject, so no vector is repeated.
    Documents of folds outside the plan drop out before the join.  The narrow side
    is what is hashed, so no vector is sorted.
    """
    rows = manifest.select(
        "doc_id", "fold", split_of(F.col("fold"), plan).alias("split"), label_array(names).alias("labels")
    ).where(F.col("split").isNotNull())
    return rows.hint("shuffle_hash").join(vectors, "doc_id", "inner")
