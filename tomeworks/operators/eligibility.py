"""Which documents take part in a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.ordering import dense_sequence

# Files excluded by hand although they are not oversize.
HAND_PICKED_EXCLUSIONS = ["3.txt", "65.txt", "12218.txt", "12219.txt"]


def listed_once(files: DataFrame, statuses: DataFrame) -> DataFrame:
    """``files`` with the status of those listed exactly once; the others are skipped."""
    single = (
        statuses.groupBy("file")
        .agg(F.count("*").alias("_times"), F.min("status").alias("status"))
        .where(F.col("_times") == 1)
        .drop("_times")
    )
    return files.join(single, "file", "inner")


def good_files(files: DataFrame, statuses: DataFrame) -> DataFrame:
    return listed_once(files, statuses).where(F.col("status") == "GOOD").drop("status")


def without_excluded(files: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Files not on the exclusion list, by exact name.

    The list grows with the corpus (its oversize files), so the kind of join is
    left to the planner, which broadcasts it only while it is small.
    """
    return files.join(exclusions.select("file").distinct(), "file", "left_anti")


def first_documents(docs: DataFrame, stop_after: int = 0, *keys: str) -> DataFrame:
    """The first ``stop_after`` documents by ``keys`` (doc_id by default), which together are unique; 0 keeps them all.

    A document with a NULL key has no place in the order and is left out.  Only
    keys are ordered.  The last key that still counts becomes a filter on the
    documents, so their text is neither sorted nor moved.
    """
    if stop_after <= 0:
        return docs
    keys = keys or ("doc_id",)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    place = F.struct(*keys)
    ordered = dense_sequence(docs.where(known).select(place.alias("key")), "key")
    last = ordered.where(F.col("position") < stop_after).select(F.max("key"))
    return docs.where(known & (place <= last.scalar()))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.length(column) > 0)
