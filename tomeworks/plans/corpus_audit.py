"""Auditing a corpus of raw text files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.markup import document_id
from tomeworks.operators.audit import audit_totals, file_statuses, status_counts, with_audit_folds
from tomeworks.staging import stage


def audit(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(seq, file, doc_key, status, fold) for files (seq, file, text) against metadata (doc_key).

    The text is read once, for the id; everything after works on the narrow
    stage table.
    """
    ids = stage(files.select("seq", "file", document_id(F.col("text")).alias("doc_key")), "ids")
    return with_audit_folds(stage(file_statuses(ids, metadata), "statuses"))


def audit_report(statuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts per status, and the totals."""
    return status_counts(statuses), audit_totals(statuses)
