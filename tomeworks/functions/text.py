"""Tokens and terms, as built-in column expressions.

A *token* is a run of ASCII word characters; anything else, accented letters
included, separates tokens.  A *term* is a token in lower case without
underscores that has more than two characters, is not a number and is not a
number with a ``th`` or ``st`` ending.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from a token, and the list of function words.
MARKS = ".,;_"
FUNCTION_WORDS = [
    "in", "on", "of", "out", "by", "from", "to", "over", "under", "the", "a", "when",
    "where", "what", "who", "whom", "you", "thou", "go", "must", "i", "me", "my", "myself",
]

# Tokens that are dropped once their digits are taken away: nothing is left
# (a number), or "th" or "st" is left (an ordinal).
NUMBER_OR_ORDINAL = r"^(?:[0-9]+|[0-9]*t[0-9]*h[0-9]*|[0-9]*s[0-9]*t[0-9]*)$"


def split_words(text: Column) -> Column:
    """Every token of ``text``, empty ones at the edges included."""
    return F.split(text, r"\W+")


def fold_case(token: Column) -> Column:
    """Lower case, applied to tokens: these are ASCII, so no locale matters."""
    return F.lower(token)


def strip_marks(token: Column) -> Column:
    """Remove ``. , ; _`` from any string."""
    return F.translate(token, MARKS, "")


def is_ordinal(token: Column) -> Column:
    """Whether a token is ``th`` or ``st`` once digits and dots are removed."""
    return F.regexp_replace(token, "[0-9.]", "").isin("th", "st")


def is_number(token: Column) -> Column:
    return token.rlike("^[0-9]+$")


def is_term(token: Column) -> Column:
    """Whether a cleaned token counts as a term."""
    return (F.length(token) > 2) & ~token.rlike(NUMBER_OR_ORDINAL)


def is_function_word(token: Column) -> Column:
    return token.isin(FUNCTION_WORDS)


def word_runs(text: Column) -> Column:
    """The runs of ASCII word characters that may become terms, in reading order.

    Whole documents are tokenised at once: a line break is a separator like any
    other.  Runs of one or two characters can never become terms, so they are
    not even extracted.
    """
    return F.regexp_extract_all(text, F.lit(r"\w{3,}"), F.lit(0))


def terms(text: Column) -> Column:
    """The terms of ``text`` in reading order, repeats kept.

    After extraction only ``_`` of the marks can occur.
    """
    cleaned = F.transform(word_runs(text), lambda t: F.replace(F.lower(t), F.lit("_"), F.lit("")))
    return F.filter(cleaned, is_term)
