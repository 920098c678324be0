"""What the operators share: document keys, word rules and the query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A table of short keys is broadcast up to this many rows (some 20 MB); a larger one is joined by shuffling.
BROADCAST_ROWS = 300_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text, F.lit(""))


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Names a document by its id and its text, also when the id is null or repeated.

    Rows that agree in both are copies of one row and are always treated alike.
    """
    number = F.coalesce(F.col(doc_id).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(number, F.lit(":"), whole(F.col(text)))))


def small_join(left: DataFrame, right: DataFrame, rows: int, condition: Column | list[str], how: str) -> DataFrame:
    """A join whose right side, known to have ``rows`` rows, is broadcast only when that is few."""
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, condition, how)


def with_text(docs: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The columns of ``docs`` with a new text, and ``n_chars`` following it where there is one."""
    made = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return docs.select(*[made[c].alias(c) if c in made else F.col(c) for c in columns])


_HELD: list = []


def sole(memory) -> None:
    """``memory`` is what this Python worker remembers from now on; it forgets that of another operator.

    Workers serve the stages of a job one after the other.  Each memory bounds its own
    bytes; this keeps them from adding up.
    """
    if not _HELD or _HELD[0] is not memory:
        if _HELD:
            _HELD[0].forget()
        _HELD[:] = [memory]
