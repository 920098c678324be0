"""Small tables for the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_docs(spark: SparkSession, texts: list, schema: str = SCHEMA) -> DataFrame:
    """One row per text; a tuple gives the whole row."""
    rows = [
        t if isinstance(t, tuple) else (i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, schema)


# Nulls in every column, empty and blank text, repeated rows, ids that clash, and a long text.
ODD = [
    (1, "one two three", "en", "a", 13),
    (1, "one two three", "en", "a", 13),
    (1, "other words here", None, "a", 16),
    (None, "no id at all", "en", None, 12),
    (None, "no id at all", "en", None, 12),
    (None, None, None, None, None),
    (2, None, "en", "a", None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "en", "a", 4),
    (5, "long words " * 30_000, "en", "a", 330_000),
    (6, "naïve 日本語 🙂🙂 text", "fr", "b", 17),
]


def folder_of(tmp_path, spark, documents, **tables) -> str:
    for name, df in {"documents": documents, **tables}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
