"""Run manifests: which documents took part, their fold and their subjects.

Inside the package a manifest is a typed table (doc_id, fold, subjects).  The
comma-line form is kept for exchange: ``<id>.tf,<fold>,ID=<id>,<subject>,...``.
A comma, a line break or a percent sign inside a subject is written as ``%2C``, ``%0A``, ``%0D``
or ``%25``, so that every subject comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.fields import bare, comma_fields, digits, prefixed_record


# The percent sign first when writing, last when reading.
_ESCAPES = [("%", "%25"), (",", "%2C"), ("\n", "%0A"), ("\r", "%0D")]


def escaped(subject: Column) -> Column:
    for plain, code in _ESCAPES:
        subject = F.replace(subject, F.lit(plain), F.lit(code))
    return subject


def unescaped(field: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        field = F.replace(field, F.lit(code), F.lit(plain))
    return field


def parse_manifest(lines: DataFrame, column: str = "value") -> DataFrame:
    """(doc_id, file, fold, subjects) from manifest lines."""
    fields = lines.select(comma_fields(F.col(column)).alias("f"))
    return fields.select(
        digits(F.get("f", F.lit(2))).try_cast("bigint").alias("doc_id"),
        bare(F.get("f", F.lit(0))).alias("file"),
        F.trim(F.get("f", F.lit(1))).try_cast("int").alias("fold"),
        F.transform(F.filter(F.slice("f", 4, F.size("f")), lambda s: F.length(s) > 0), unescaped).alias("subjects"),
    )


def manifest_lines(manifest: DataFrame, trailing_comma: bool = False) -> DataFrame:
    """Comma lines (column ``value``) from a typed manifest."""
    line = F.concat_ws(
        ",",
        F.concat(F.col("doc_id").cast("string"), F.lit(".tf")),
        F.col("fold").cast("string"),
        prefixed_record(F.col("doc_id"), F.transform("subjects", escaped)),
    )
    if trailing_comma:
        line = F.concat(line, F.lit(","))
    return manifest.select(line.alias("value"))
