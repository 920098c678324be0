"""Removing the licence header and footer around a book's text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.markup import (
    FOOTER_PATTERNS,
    HEADER_PATTERNS,
    before_footer,
    footer_line,
    header_line,
    through_header,
)
from tomeworks.operators.fence import computed_once
from tomeworks.sources.corpus import document_lines


def marker_lines(
    docs: DataFrame,
    headers: list[str] = HEADER_PATTERNS,
    footers: list[str] = FOOTER_PATTERNS,
) -> DataFrame:
    """(doc_id, header_line, footer_line), 0-based, NULL where there is none."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        header_line(text, headers).alias("header_line"),
        footer_line(text, footers).alias("footer_line"),
    )


def strip_boilerplate(
    docs: DataFrame,
    headers: list[str] = HEADER_PATTERNS,
    footers: list[str] = FOOTER_PATTERNS,
) -> DataFrame:
    """``docs`` with ``text`` cut to the lines between header and footer.

    A document without a header is dropped.  One without a footer keeps its end,
    and so does one whose footer is its very first line.  A footer before the
    header leaves an empty text.  Row-local: no shuffle.
    """
    text = F.col("text")
    others = [c for c in docs.columns if c != "text"]
    found = docs.select(
        *others,
        "text",
        through_header(text, headers).alias("_head"),
        before_footer(text, footers).alias("_before"),
    )
    # Both parts carry one line break in front, so the length of the head is the
    # 1-based position in the text of the first character after it.
    start = F.length("_head")
    stop = F.length("_before")
    body = (
        F.when(start.isNull(), F.lit(None).cast("string"))
        .when(stop.isNull() | (stop == 1), F.substring(text, start, F.length(text)))
        .when(stop <= start, F.lit(""))
        .otherwise(F.substring(text, start, stop - start))
    )
    cut = computed_once(found, others, text=body)
    return cut.where(F.col("text").isNotNull()).select(*docs.columns)


def body_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) without blank lines."""
    return document_lines(docs).where(F.length("line") > 0)
