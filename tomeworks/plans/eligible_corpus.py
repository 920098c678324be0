"""From a folder of files to the documents of a run, each book once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.markup import document_id
from tomeworks.operators.audit import file_statuses
from tomeworks.operators.boilerplate import strip_boilerplate
from tomeworks.operators.eligibility import first_documents, without_excluded
from tomeworks.staging import stage


def eligible_files(files: DataFrame, metadata: DataFrame, exclusions: DataFrame, stop_after: int = 0) -> DataFrame:
    """(path, doc_id) of the files that take part.

    ``files`` is (path, file, text) with a unique path, ``metadata`` (doc_key),
    ``exclusions`` (file).  The id comes from the text.  Of several files with one
    id the first by path is GOOD; those without an id, without metadata, or on the
    list are left out, and so are ids beyond the bigint range.  The cap counts in the order of (doc_id, path).
    The text is read once, for the id.
    """
    ids = stage(files.select("path", "file", document_id(F.col("text")).alias("doc_key")), "file-ids")
    good = file_statuses(ids, metadata, seq="path").where(F.col("status") == "GOOD")
    numbered = without_excluded(good, exclusions).select("path", F.col("doc_key").try_cast("bigint").alias("doc_id"))
    # ids with leading zeros may meet in one number: the first path counts
    once = numbered.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("path").alias("path"))
    return first_documents(stage(once, "eligible"), stop_after, "doc_id", "path")


def eligible_corpus(
    files: DataFrame, metadata: DataFrame, exclusions: DataFrame, stop_after: int = 0, strip: bool = True
) -> DataFrame:
    """(doc_id, text), one row per document: what ``Features`` counts.

    The cap comes before the header test here, since it is known before any text
    is read again; the text meets its few narrow keys in one join.
    """
    kept = eligible_files(files, metadata, exclusions, stop_after)
    docs = files.select("path", "text").join(kept, "path").select("doc_id", "text")
    return strip_boilerplate(docs) if strip else docs
