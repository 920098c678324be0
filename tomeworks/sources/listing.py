"""Files and sizes: from long directory listings (``ls -lhR``), or from the file system itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.functions.fields import columns_of, megabytes


def parse_listing(lines: DataFrame, column: str = "value", reference_compat: bool = False) -> DataFrame:
    """(file, size_text, size_mb) of the ``.txt`` lines; size is column 5, the name column 9."""
    txt = lines.where(F.contains(F.col(column), F.lit(".txt")))
    cols = txt.select(columns_of(F.col(column)).alias("c"))
    sized = cols.select(F.get("c", F.lit(8)).alias("file"), F.get("c", F.lit(4)).alias("size_text"))
    return sized.withColumn("size_mb", megabytes(F.col("size_text"), reference_compat))


def size_text(size: Column) -> Column:
    """Bytes the way a long listing prints them: rounded up, one decimal below 10 units."""
    text = size.cast("string")
    for power, unit in enumerate("KMGT", start=1):
        amount = size / F.lit(float(1 << (10 * power)))
        small = F.ceil(amount * 10)
        shown = F.when(small < 100, F.format_string("%.1f", small / 10)).otherwise(F.ceil(amount).cast("string"))
        text = F.when(size >= 1 << (10 * power), F.concat(shown, F.lit(unit))).otherwise(text)
    return text


def file_sizes(spark: SparkSession, folder: str, glob: str = "*.txt*") -> DataFrame:
    """(path, file, size, size_text, size_mb) of the files below ``folder``; their contents are not read.

    Empty files are left out, as Spark gives them no task.

    Above a limit of whole tenths of a megabyte are the same files as by a listing's rounded sizes.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    files = reader.load(folder).select("path", F.col("length").alias("size"))
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        "size",
        size_text(F.col("size")).alias("size_text"),
        (F.col("size") / F.lit(float(1 << 20))).alias("size_mb"),
    )


def big_files(listing: DataFrame, limit_mb: float = 2.5) -> DataFrame:
    """Files larger than the limit."""
    return listing.where(F.col("size_mb") > limit_mb)


def exclusion_records(big: DataFrame) -> DataFrame:
    """(reason, file, size_text): the rows of an exclusion list."""
    return big.select(F.lit("TOOBIG").alias("reason"), "file", "size_text")
