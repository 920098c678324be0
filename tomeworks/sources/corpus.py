"""Text files as documents or as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.functions.markup import unix_newlines


def text_documents(spark: SparkSession, folder: str, name_glob: str = "*.txt*") -> DataFrame:
    """One row per file below ``folder``: path, file, text.

    Files are found in all sub-folders; ``name_glob`` picks them by name and is
    applied while listing.  The path names the file; the id of the book is in its
    text (``plans.eligible_corpus``), never in its name: ``10.txt`` and
    ``truck10.txt`` are different books.
    """
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .text(folder, wholetext=True)
    )
    name = F.col("_metadata.file_name")
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        name.alias("file"),
        unix_newlines(F.col("value")).alias("text"),
    )


def text_lines(spark: SparkSession, path: str, at_least: int | None = None) -> DataFrame:
    """One row per line (column ``value``), in at least so many partitions if wanted.

    The minimum cuts the files into smaller splits; nothing is shuffled, and a
    large table keeps its own, larger number.  The setting belongs to the reading
    session, hence a session of its own.
    """
    if at_least:
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.minPartitionNum", at_least)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    return spark.read.text(path)


def document_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) for work that needs single lines."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
