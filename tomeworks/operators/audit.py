"""Corpus audit: missing ids, duplicates, missing metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.folds import cyclic_folds
from tomeworks.operators.lookup import BROADCAST_BYTES, keyed_lookup
from tomeworks.staging import stage


def with_known_metadata(files: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    return files.join(metadata.select(key).distinct(), key, "left_semi")


def without_metadata(files: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    return files.join(metadata.select(key).distinct(), key, "left_anti")


def first_copies(files: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, first_seq, copies).  Copies are reduced before the shuffle, so a key
    with very many of them costs no more than any other."""
    return (
        files.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(seq).alias("first_seq"), F.count("*").alias("copies"))
    )


def file_statuses(
    files: DataFrame,
    metadata: DataFrame,
    key: str = "doc_key",
    seq: str = "seq",
    broadcast_bytes: int = BROADCAST_BYTES,
    seen: DataFrame | None = None,
) -> DataFrame:
    """``files`` plus ``status``.

    MISSING_ID  the file has no id
    NO_META     its id has no metadata (every copy)
    GOOD        the first file, by ``seq``, with its id
    DUPLICATE   any later one, and any whose id is in ``seen``, the ids found GOOD by earlier audits

    No window over the copies of an id: a single id may own a third of all
    files.  Ids are reduced to one row each, which is then looked up.  ``files``
    is read several times and should be a stage table; ``key`` is a string.
    """
    known = metadata.select(key).distinct().withColumn("_known", F.lit(True))
    firsts = first_copies(files, key, seq).join(known, key, "left")
    if seen is not None:
        earlier = seen.toDF(key).withColumn("_seen", F.lit(True))
        # an id seen before has no first copy among these files
        firsts = firsts.join(earlier, key, "left").withColumn("first_seq", F.expr("if(_seen, NULL, first_seq)")).drop("_seen")
    keys = stage(firsts, "ids")
    found = keyed_lookup(
        files.where(F.col(key).isNotNull()), keys, key, weight="copies", broadcast_bytes=broadcast_bytes
    )
    judged = found.withColumn(
        "status",
        F.when(F.col("_known").isNull(), F.lit("NO_META"))
        .when(F.col(seq) == F.col("first_seq"), F.lit("GOOD"))
        .otherwise(F.lit("DUPLICATE")),
    ).select(*files.columns, "status")
    missing = files.where(F.col(key).isNull()).withColumn("status", F.lit("MISSING_ID"))
    return judged.unionByName(missing)


def with_audit_folds(statuses: DataFrame, seq: str = "seq", good_before: int = 0) -> DataFrame:
    """Folds dealt to the GOOD files in order, going on after ``good_before`` earlier ones; other files have none."""
    folds = cyclic_folds(statuses.where(F.col("status") == "GOOD"), seq, start=good_before)
    return statuses.join(folds, seq, "left")


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("n"))


def audit_totals(statuses: DataFrame) -> DataFrame:
    """One row: files, duplicates, no_id, no_meta."""
    is_status = lambda s: F.count_if(F.col("status") == s)
    return statuses.agg(
        F.count("*").alias("files"),
        is_status("DUPLICATE").alias("duplicates"),
        is_status("MISSING_ID").alias("no_id"),
        is_status("NO_META").alias("no_meta"),
    )
