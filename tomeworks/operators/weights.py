"""Inverse document frequency and TF·IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.hashing import BUCKET_FUNCTIONS, DEFAULT_BUCKETS
from tomeworks.operators.lookup import BROADCAST_BYTES, keyed_lookup


def inverse_frequency(frequencies: DataFrame, n_docs: DataFrame, log: bool = True) -> DataFrame:
    """(term, df, idf) with ``idf = ln(N / df)``, or ``N / df`` without the logarithm.

    Not smoothed, unlike spark.ml's IDF.  ``n_docs`` is a one-row table and is
    used as a scalar subquery.
    """
    ratio = n_docs.select(F.col("n_docs").cast("double")).scalar() / F.col("df")
    return frequencies.select("term", "df", (F.ln(ratio) if log else ratio).alias("idf"))


def with_buckets(
    idf: DataFrame, buckets: int = DEFAULT_BUCKETS, hash_name: str = "md5"
) -> DataFrame:
    """The IDF table plus each term's bucket, so that terms are hashed once per
    vocabulary entry and not once per occurrence."""
    return idf.withColumn("bucket", BUCKET_FUNCTIONS[hash_name](F.col("term"), buckets))


def tfidf(tf: DataFrame, idf: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``tf`` rows joined to the IDF table, with ``tfidf = tf * idf``.

    Terms the IDF table does not have drop out.  Frequent terms fill most of the
    rows, which is why the join treats them separately; ``idf`` must be staged.
    """
    joined = keyed_lookup(tf, idf, "term", weight="df", broadcast_bytes=broadcast_bytes)
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))
