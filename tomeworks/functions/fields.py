"""Fields of text records: ids, comma lists and file-listing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(value: Column) -> Column:
    """The digits of a string, NULL when it has none."""
    return F.nullif(F.regexp_replace(value, "[^0-9]", ""), F.lit(""))


def ebook_id(about: Column) -> Column:
    """``ebooks/123`` to ``123``."""
    return F.regexp_replace(about, "ebooks/", "")


def prefixed_record(key: Column, values: Column) -> Column:
    """``ID=<key>,v1,v2,...`` from a key and an array of strings."""
    return F.concat_ws(",", F.concat(F.lit("ID="), key.cast("string")), values)


def comma_fields(line: Column) -> Column:
    return F.split(line, ",")


def bare(value: Column) -> Column:
    """Trimmed, without line breaks, quotes and opening brackets."""
    return F.trim(F.regexp_replace(value, r"[\n'\[]", ""))


def columns_of(line: Column) -> Column:
    """The columns of a line separated by one or more spaces."""
    return F.split(F.regexp_replace(line, " +", " "), " ")


def megabytes(size: Column, reference_compat: bool = False) -> Column:
    """A human-readable size (``820K``, ``3.0M``, ``1.2G``) in megabytes.

    With ``reference_compat`` only ``M`` sizes count and all others are 0, so
    that a file of some gigabytes is not oversize.
    """
    number = F.regexp_replace(size, "[^0-9.]", "").try_cast("double")
    if reference_compat:
        return F.when(F.contains(size, F.lit("M")), number).otherwise(F.lit(0.0))
    unit = F.upper(F.regexp_extract(size, "([KMGTkmgt])", 1))
    return (
        F.when(unit == "T", number * 1024.0 * 1024.0)
        .when(unit == "G", number * 1024.0)
        .when(unit == "M", number)
        .when(unit == "K", number / 1024.0)
        .otherwise(number / (1024.0 * 1024.0))
    )
