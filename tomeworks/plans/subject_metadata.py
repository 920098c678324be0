"""From metadata records to subjects and their ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.subjects import ranked, subject_frequency
from tomeworks.sources.metadata import parse_metadata, usable, with_outcome
from tomeworks.staging import stage


@dataclass
class SubjectMetadata:
    """``metadata`` is (doc_id, subjects), ``ranking`` (subject, n), ``outcome`` one row (records, read, unreadable, no_id)."""

    metadata: DataFrame
    ranking: DataFrame
    outcome: DataFrame


def subject_metadata(records: DataFrame, column: str = "xml") -> SubjectMetadata:
    """Parse every record once; those that cannot be used are counted and left out."""
    parsed = stage(parse_metadata(records, column), "metadata")
    one = lambda name: F.count_if(F.col("outcome") == name).alias(name)
    outcome = with_outcome(parsed).agg(F.count("*").alias("records"), one("read"), one("unreadable"), one("no_id"))
    good = usable(parsed)
    return SubjectMetadata(good, ranked(subject_frequency(good)), outcome)
