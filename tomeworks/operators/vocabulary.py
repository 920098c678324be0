"""Document frequencies and the growth of the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.ordering import running_total
from tomeworks.operators.terms import term_counts


def document_frequency(bags: DataFrame) -> DataFrame:
    """(term, df).  A term occurs once per bag, so counting rows counts documents."""
    each = bags.select(F.explode_outer("terms.term").alias("term")).where(F.col("term").isNotNull())
    return each.groupBy("term").agg(F.count("*").alias("df"))


def document_count(bags: DataFrame) -> DataFrame:
    """One row, ``n_docs``: documents with at least one term."""
    return bags.agg(F.count("max_n").alias("n_docs"))


def merge_frequencies(state: DataFrame, batch: DataFrame) -> DataFrame:
    """(term, df) of two disjoint sets of documents together."""
    both = state.select("term", "df").unionByName(batch.select("term", "df"))
    return both.groupBy("term").agg(F.sum("df").alias("df"))


def known_terms(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Distinct terms that are in the vocabulary already.

    Made distinct first: repeats of a common term would all meet in one task of the join.
    """
    return terms.select("term").distinct().intersect(vocabulary.select("term"))


def new_terms(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Distinct terms the vocabulary does not have."""
    return terms.select("term").distinct().join(vocabulary.select("term"), "term", "left_anti")


def vocabulary_growth(bags: DataFrame) -> DataFrame:
    """(doc_id, words, already, new, vocabulary) as documents arrive in doc_id order.

    A term is new in the first document that has it.  That turns the per-document
    comparison with everything seen before into one aggregation over terms; the
    running total then has one row per document.
    """
    first_seen = term_counts(bags).groupBy("term").agg(F.min("doc_id").alias("doc_id"))
    new = first_seen.groupBy("doc_id").agg(F.count("*").alias("new"))
    counts = bags.where(F.col("max_n").isNotNull()).select(
        "doc_id", F.size("terms").cast("bigint").alias("words")
    )
    per_doc = counts.join(new, "doc_id", "left").select(
        "doc_id", "words", F.coalesce("new", F.lit(0)).alias("new")
    )
    grown = running_total(per_doc, "doc_id", "new", "vocabulary")
    return grown.select(
        "doc_id", "words", (F.col("words") - F.col("new")).alias("already"), "new", "vocabulary"
    )
