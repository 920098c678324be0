"""Subjects: frequencies, rankings and one-vs-rest labels.

Subjects are arrays throughout.  They are compared as whole strings, so a
subject that contains a comma or surrounding blanks stays what it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.fields import comma_fields


def with_metadata(docs: DataFrame, metadata: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with their subjects; a document without metadata drops out."""
    return docs.join(metadata, key, "inner")


def subject_frequency(manifest: DataFrame) -> DataFrame:
    """(subject, n) over the documents of a run."""
    each = manifest.select(F.explode("subjects").alias("subject")).where(F.length("subject") > 0)
    return each.groupBy("subject").agg(F.count("*").alias("n"))


def field_frequency(records: DataFrame, column: str = "value", keep_ids: bool = False) -> DataFrame:
    """(term, n) over all comma fields of metadata records.

    The ``ID=`` field is dropped unless ``keep_ids`` is set.
    """
    fields = records.select(F.explode(comma_fields(F.col(column))).alias("term"))
    fields = fields.where(F.length("term") > 0)
    if not keep_ids:
        fields = fields.where(~F.startswith("term", F.lit("ID=")))
    return fields.groupBy("term").agg(F.count("*").alias("n"))


def ranked(frequencies: DataFrame, name: str = "subject") -> DataFrame:
    """All of them, most frequent first, ties by name."""
    return frequencies.orderBy(F.desc("n"), F.asc(name))


def top(frequencies: DataFrame, k: int = 10, name: str = "subject") -> DataFrame:
    return ranked(frequencies, name).limit(k)


def top_names(frequencies: DataFrame, k: int = 10, name: str = "subject") -> list[str]:
    """The k names, brought to the driver: k is a setting and small."""
    return [row[name] for row in top(frequencies, k, name).collect()]


def has_subject(subject: str) -> Column:
    """1.0 if the document has the subject, else 0.0."""
    return F.array_contains("subjects", subject).cast("double")


def label_array(names: list[str]) -> Column:
    """One label per subject, in the order of ``names``."""
    return F.array(*[has_subject(n) for n in names])


def one_vs_rest(docs: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """(doc_id, *keep, subject, label): every document with its label for every subject."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("subject"), has_subject(n).alias("label")) for n in names]
    )
    return docs.select("doc_id", *keep, F.inline(pairs))
