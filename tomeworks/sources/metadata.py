"""Book metadata in RDF/XML: the book's id and its subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.functions.fields import digits, ebook_id

# The part of a record that is read; other elements are skipped by the parser.
RECORD_SCHEMA = (
    "ebook STRUCT<_about: STRING, subject: ARRAY<STRUCT<Description: STRUCT<value: STRING>>>>, "
    "_corrupt_record STRING"
)
_OPTIONS = {
    "ignoreNamespace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}


def metadata_files(spark: SparkSession, folder: str, name_glob: str = "*.rdf") -> DataFrame:
    """(path, xml): one record per file of a metadata tree, in all its sub-folders."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob)
    return files.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))


def metadata_records(
    spark: SparkSession, folder: str, name_glob: str = "*.rdf", record: str = "pgterms:ebook"
) -> DataFrame:
    """(path, xml): one row per ``record`` element of files that hold any number of them.

    The files are cut at the end tags by the text reader, so one large file is read
    by many tasks and no row is longer than a record and what stands before it.  A
    record whose end tag is missing is cut where the next one starts and keeps its
    place as an unreadable one; what stands between records is left out.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob)
    parts = files.option("lineSep", f"</{record}>").text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.split("value", rf"<(?=\Q{record}\E[\s/>])").alias("part")
    )
    # what is before the first start is no record; all but the last of a part were never closed
    last = F.size("part") - 1
    opened = F.slice("part", 2, F.greatest(last, F.lit(0)))
    records = parts.select("path", F.posexplode(opened).alias("pos", "body"), last.alias("last"))
    ended = F.when(F.col("pos") == F.col("last") - 1, F.lit(f"</{record}>")).otherwise("")
    return records.select("path", F.concat(F.lit("<rdf:RDF><"), "body", ended, F.lit("</rdf:RDF>")).alias("xml"))


def parse_metadata(records: DataFrame, column: str = "xml") -> DataFrame:
    """(doc_id, subjects, is_bad) for every XML record.

    Records that cannot be parsed are kept with ``is_bad`` set, so that they can
    be counted before they are dropped.
    """
    parsed = records.select(F.from_xml(F.col(column), RECORD_SCHEMA, _OPTIONS).alias("r"))
    subjects = F.filter(F.col("r.ebook.subject.Description.value"), lambda s: s.isNotNull())
    return parsed.select(
        digits(ebook_id(F.col("r.ebook._about"))).try_cast("bigint").alias("doc_id"),
        F.coalesce(subjects, F.array().cast("array<string>")).alias("subjects"),
        (F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()).alias("is_bad"),
    )


def with_outcome(metadata: DataFrame) -> DataFrame:
    """``metadata`` with ``outcome``: unreadable, no_id or read.  Every record has one."""
    outcome = F.when(F.col("is_bad"), "unreadable").when(F.col("doc_id").isNull(), "no_id").otherwise("read")
    return metadata.withColumn("outcome", outcome)


def usable(metadata: DataFrame) -> DataFrame:
    return metadata.where(~F.col("is_bad") & F.col("doc_id").isNotNull()).select("doc_id", "subjects")
