"""Stand-in inputs derived from the test tables.

The expressions are plain SQL text, valid in Spark and in ANSI SQL engines, so
that a check against another engine starts from the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.sources.tables import read_table

NL = "chr(10)"

# The id written into a document; some documents share one.
BOOK_ID = "CASE WHEN doc_id % 11 = 0 THEN CAST(floor(doc_id / 5) AS BIGINT) ELSE doc_id END"

_MARKER = "CASE doc_id % 3 WHEN 0 THEN '[EBook #' WHEN 1 THEN '[Etext #' ELSE '[eBook #' END"
_TITLE = f"'Title ' || CASE WHEN doc_id % 13 = 0 THEN '' ELSE {_MARKER} || CAST({BOOK_ID} AS VARCHAR(20)) || ']' END"
_HEADER = (
    "CASE doc_id % 4 WHEN 0 THEN '*** START OF X ***' WHEN 1 THEN '***The Project Gutenberg Etext X' "
    "WHEN 2 THEN '***START OF THE PROJECT GUTENBERG EBOOK X' ELSE '*END THE SMALL PRINT! X' END"
)
_FOOTER = "CASE doc_id % 2 WHEN 0 THEN '*** END OF THIS X ***' ELSE '*** START: FULL LICENSE ***' END"

# Title with id, header, text, footer; the footer first or early, or some part missing, for some.
MARKED_TEXT = (
    f"CASE WHEN doc_id % 37 = 6 THEN '*** END OF THIS FIRST ***' || {NL} ELSE '' END || "
    f"{_TITLE} || {NL} || "
    f"CASE WHEN doc_id % 31 = 5 THEN '*** END OF THIS EARLY ***' || {NL} ELSE '' END || "
    f"CASE WHEN doc_id % 10 = 0 THEN '' ELSE {_HEADER} || {NL} END || "
    f"text || {NL} || "
    f"CASE WHEN doc_id % 7 = 0 THEN '' ELSE {_FOOTER} || {NL} END || 'legal'"
)

FILE_NAME = "CAST(doc_id AS VARCHAR(20)) || '.txt'"
# a unique path whose order is that of the ids
PATH = f"lpad(CAST(doc_id AS VARCHAR(20)), 20, '0') || '/' || {FILE_NAME}"

_SIZE = (
    "CASE WHEN doc_id % 50 = 0 THEN '3G' WHEN doc_id % 9 = 0 THEN CAST(n_chars AS VARCHAR(20)) || 'K' "
    "WHEN doc_id % 23 = 0 THEN CAST(n_chars AS VARCHAR(20)) "
    "ELSE CAST(CAST(floor(n_chars / 1000) AS BIGINT) AS VARCHAR(20)) || '.' || "
    "CAST(CAST(floor(n_chars / 100) AS BIGINT) % 10 AS VARCHAR(20)) || 'M' END"
)
_ENDING = "CASE WHEN doc_id % 19 = 0 THEN '.zip' ELSE '.txt' END"
LISTING_LINE = (
    f"'-rw-r--r--   1 u  g  ' || {_SIZE} || ' Jan  1 2010 ' || CAST(doc_id AS VARCHAR(20)) || {_ENDING}"
)

SUBJECT_PARTS = [
    "lang",
    "source",
    "'quality:' || CAST(quality AS VARCHAR(20))",
    "'toxic:' || CAST(toxic AS VARCHAR(20))",
]

_PREFIX = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:p="http://purl.org/dc/terms/">'


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def corpus(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """(doc_id, text) as scanned.  For a small file in few row groups a caller may ask for more partitions."""
    docs = documents(spark, folder).select("doc_id", "text")
    return docs.repartition(partitions, "doc_id") if partitions else docs


def marked(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """(doc_id, seq, file, text) with ids, headers and footers in the text."""
    return corpus(spark, folder, partitions).selectExpr(
        "doc_id", "doc_id AS seq", f"{FILE_NAME} AS file", f"{MARKED_TEXT} AS text"
    )


def listing_lines(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", "n_chars").selectExpr(f"{LISTING_LINE} AS value")


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, subjects)."""
    labels = read_table(spark, folder, "labels")
    both = documents(spark, folder).select("doc_id", "lang", "source").join(labels, "doc_id", "left")
    parts = [F.expr(p) for p in SUBJECT_PARTS]
    return both.select("doc_id", F.array_compact(F.array(*parts)).alias("subjects"))


def metadata_keys(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_key) of the books that have metadata: here, those with labels."""
    return read_table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("doc_key"))


def xml_records(spark: SparkSession, folder: str, broken_every: int = 0, nameless_every: int = 0) -> DataFrame:
    """(xml): one RDF record per document; when asked for every n-th is cut short, or has no id."""
    subject = lambda s: F.concat(
        F.lit("<p:subject><rdf:Description><rdf:value>"), s, F.lit("</rdf:value></rdf:Description></p:subject>")
    )
    record = F.concat(
        F.lit(_PREFIX),
        F.lit('<p:ebook rdf:about="ebooks/'),
        F.when(F.lit(nameless_every > 0) & (F.col("doc_id") % max(1, nameless_every) == 0), F.lit("none")).otherwise(
            F.col("doc_id").cast("string")
        ),
        F.lit('"><p:title>T</p:title>'),
        F.array_join(F.transform("subjects", subject), ""),
        F.lit("</p:ebook></rdf:RDF>"),
    )
    if broken_every:
        broken = F.col("doc_id") % broken_every == 0
        record = F.when(broken, F.substring(record, F.lit(1), F.length(record) - 20)).otherwise(record)
    return metadata(spark, folder).select(record.alias("xml"))


def many_record_files(spark: SparkSession, folder: str, path: str) -> None:
    """The same records, many to a file, as lines below ``path``."""
    records = xml_records(spark, folder).select(F.regexp_replace("xml", "</?rdf:RDF[^>]*>", "").alias("value"))
    records.write.text(path)
