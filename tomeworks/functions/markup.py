"""Finding ids, headers and footers in the raw text of a book.

Patterns apply to single lines: a pattern matches a document when it is found in
any of its lines, patterns are tried in order, and the first matching line of
the first matching pattern counts.  Everything is done on the whole text with
multi-line regular expressions, so a document is never cut into line rows.

Positions are taken on the text with one line break put in front.  The empty
line this adds can match no pattern, so a match always has something before it
and "no match" (NULL) cannot be mistaken for a match at the very start.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id markers and line patterns, in order of priority.
ID_MARKERS = ["[EBook", "[Etext", "[eBook"]
HEADER_PATTERNS = [
    r"^\*\*\* START (.*)\/*/*/*$",
    r"^\*\*\*The Project Gutenberg(.*)",
    r"^\*\*\*START OF THE PROJECT GUTENBERG EBOOK(.*)",
    r"^\*END THE SMALL PRINT",
]
# A fifth header pattern, mis-escaped and off by default; add it to HEADER_PATTERNS to use it.
LOOSE_HEADER_PATTERN = r"\*END*THE SMALL"
FOOTER_PATTERNS = [
    r"^\*\*\* END OF THIS (.*)\/*/*/*$",
    r"^\*\*\* START: FULL LICEN(.*)",
]

_LINES = "(?dm)"  # "^" and "$" at line breaks, and only "\n" breaks lines


def unix_newlines(text: Column) -> Column:
    """Line breaks as ``\\n``, the only break the patterns know."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def _from_line_start(pattern: str) -> str:
    return pattern if pattern.startswith("^") else rf"^[^\n]*?(?:{pattern})"


def _by_priority(cases: list[tuple[Column, Column]]) -> Column:
    """The value of the first test that holds, else NULL; later tests are not evaluated."""
    chosen = F.lit(None).cast("string")
    for test, value in reversed(cases):
        chosen = F.when(test, value).otherwise(chosen)
    return chosen


def _with_lead(text: Column) -> Column:
    return F.concat(F.lit("\n"), text)


def _cut(text: Column, patterns: list[str], whole: str) -> Column:
    """Everything ``whole`` (a template around the line pattern) covers, from the start."""
    lead = _with_lead(text)
    lines = [_from_line_start(p) for p in patterns]
    return _by_priority(
        [
            (lead.rlike(_LINES + p), F.regexp_extract(lead, _LINES + whole.replace("LINE", p), 0))
            for p in lines
        ]
    )


def through_header(text: Column, patterns: list[str] = HEADER_PATTERNS) -> Column:
    """The text (with lead) up to and including the header line and its break."""
    return _cut(text, patterns, r"\A[\s\S]*?LINE[^\n]*(?:\n|\z)")


def before_footer(text: Column, patterns: list[str] = FOOTER_PATTERNS) -> Column:
    """The text (with lead) before the footer line."""
    return _cut(text, patterns, r"\A[\s\S]*?(?=LINE)")


def count_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def header_line(text: Column, patterns: list[str] = HEADER_PATTERNS) -> Column:
    """0-based number of the header line, NULL without a header."""
    head = F.regexp_replace(through_header(text, patterns), r"\n\z", "")
    return count_breaks(head) - 1


def footer_line(text: Column, patterns: list[str] = FOOTER_PATTERNS) -> Column:
    """0-based number of the footer line, NULL without a footer."""
    return count_breaks(before_footer(text, patterns)) - 1


def document_id(text: Column, markers: list[str] = ID_MARKERS) -> Column:
    """The number behind the first marker that occurs, NULL when there is none."""
    found = _by_priority(
        [(F.contains(text, F.lit(m)), F.regexp_extract(text, rf"\Q{m}\E([^\]\n]*)", 1)) for m in markers]
    )
    return F.nullif(F.regexp_replace(found, "[^0-9]", ""), F.lit(""))
