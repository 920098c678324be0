"""Ids, headers and footers on hand-made documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tomeworks.functions import markup
from tomeworks.operators.boilerplate import body_lines, marker_lines, strip_boilerplate
from tomeworks.operators.terms import term_bags

H, T = "*** START OF THE BOOK ***", "*** END OF THIS BOOK ***"

# name: (text, header line, footer line, body lines or None when dropped)
CASES = {
    "header 1 and footer 1": (f"pre\n{H}\none\n\ntwo\n{T}\nlegal", 1, 5, ["one", "two"]),
    "header 2": ("***The Project Gutenberg Etext of X\nbody", 0, None, ["body"]),
    "header 3": ("***START OF THE PROJECT GUTENBERG EBOOK X\nbody", 0, None, ["body"]),
    "header 4": ("x\n*END THE SMALL PRINT! y\nbody\n", 1, None, ["body"]),
    "footer 2": (f"{H}\nbody\n*** START: FULL LICENSE ***\nlegal", 0, 2, ["body"]),
    "no header": (f"text\n{T}\nlegal", None, 1, None),
    "no footer": (f"{H}\none\ntwo", 0, None, ["one", "two"]),
    "footer before header": (f"pre\n{T}\n{H}\nbody", 2, 1, []),
    "footer first": (f"{T}\n{H}\nbody", 1, 0, ["body"]),
    "first footer pattern at the start, second later": (
        f"{T}\n{H}\nbody\n*** START: FULL LICENSE ***", 1, 0, ["body", "*** START: FULL LICENSE ***"]),
    "empty body": (f"{H}\n{T}", 0, 1, []),
    "header is the last line": (f"pre\n{H}", 1, None, []),
    "priority beats position": (f"*END THE SMALL PRINT\na\n{H}\nb", 2, None, ["b"]),
    "first line of the pattern counts": (f"{H}\na\n{H}\nb\n{T}\nc\n{T}", 0, 4, ["a", H, "b"]),
    "not at the line start": (f"x {H}\nbody", None, None, None),
    "characters outside the basic plane": (f"\U0001d11e\n{H}\n\U0001d11e body\n{T}", 1, 3, ["\U0001d11e body"]),
    "unicode line separators are ordinary": (f"a {H}\n{H}\nx y", 1, None, ["x y"]),
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, text) for i, (text, *_) in enumerate(CASES.values())]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_marker_lines(documents):
    got = {r["doc_id"]: (r["header_line"], r["footer_line"]) for r in marker_lines(documents).collect()}
    assert got == {i: (h, f) for i, (_, h, f, _) in enumerate(CASES.values())}


def test_bodies(documents):
    stripped = strip_boilerplate(documents)
    kept = {r["doc_id"] for r in stripped.collect()}
    lines: dict[int, list[str]] = {i: [] for i in kept}
    for r in body_lines(stripped).orderBy("doc_id", "line_no").collect():
        lines[r["doc_id"]].append(r["line"])
    assert lines == {i: body for i, (*_, body) in enumerate(CASES.values()) if body is not None}


def test_loose_header_pattern_is_an_option(spark):
    docs = spark.createDataFrame([(1, "see *ENDTHE SMALL\nbody")], "doc_id bigint, text string")
    assert strip_boilerplate(docs).count() == 0
    loose = [*markup.HEADER_PATTERNS, markup.LOOSE_HEADER_PATTERN]
    assert strip_boilerplate(docs, headers=loose).first()["text"] == "body"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Title [EBook #1220] x", "1220"),
        ("Title [Etext #12201]", "12201"),
        ("[eBook #5]\n[Etext #6]\n[EBook #7]", "7"),
        ("[EBook #8]\n[EBook #9]", "8"),
        ("[EBook #1 of 2] 3", "12"),
        ("[EBook without end 44", "44"),
        ("[EBook none]\n[Etext #6]", None),
        ("nothing", None),
    ],
)
def test_document_id(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(markup.document_id(F.col("text")).alias("id")).first()["id"] == expected


def test_newlines(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd",)], "text string")
    assert df.select(markup.unix_newlines(F.col("text")).alias("t")).first()["t"] == "a\nb\nc\nd"


def test_long_lines_and_documents(spark):
    """Lines of a megabyte, wide characters included, must not exhaust the matcher."""
    wide = "\U0001f600a" * 200_000
    text = f"{wide}\n*** START {wide}\n{'word ' * 200_000}\n{wide}\n*** END OF THIS {wide}\n{wide}"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert strip_boilerplate(docs).first()["text"] == f"{'word ' * 200_000}\n{wide}\n"
    bag = term_bags(strip_boilerplate(docs)).first()
    assert [tuple(t) for t in bag["terms"]] == [("word", 200_000)] and bag["max_n"] == 200_000
