"""Term counts and max-normalised term frequency.

A document is one row, so everything about one document is computed inside that
row.  Counting terms therefore needs no shuffle, however large the corpus; only
statistics across documents do.

Spark extracts the runs of word characters; numpy and Arrow kernels fold, filter
and count them for some documents at a time: distinct words are numbered, and
equal (document, word) numbers are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomeworks.functions.text import NUMBER_OR_ORDINAL, word_runs

_TERMS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]))
_AT_ONCE = 4 << 20  # characters counted at a time, or one document


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of about ``_AT_ONCE`` characters."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, "right")))
        yield batch.slice(at, until - at)
        at = until


def _counted(rows: pa.RecordBatch, runs: str) -> list[pa.Array]:
    """``terms`` and ``max_n`` of rows whose ``runs`` are ASCII words between blanks."""
    words = pc.split_pattern(pc.replace_substring(pc.ascii_lower(rows.column(runs)), "_", ""), " ")
    sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    numbered = words.flatten().dictionary_encode()
    known = numbered.dictionary
    is_term = pc.and_(pc.greater(pc.binary_length(known), 2), pc.invert(pc.match_substring_regex(known, NUMBER_OR_ORDINAL)))
    is_term = is_term.to_numpy(zero_copy_only=False).astype(bool)
    order = pc.sort_indices(known).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    word = numbered.indices.to_numpy()
    used = is_term[word]
    doc = np.repeat(np.arange(len(rows)), sizes)[used]
    cells, n = np.unique(doc * max(1, len(known)) + place[word[used]], return_counts=True)
    doc, term = np.divmod(cells, max(1, len(known)))
    ends = np.cumsum(np.bincount(doc, minlength=len(rows)))
    none = rows.column(runs).is_null().to_numpy(zero_copy_only=False)
    offsets = pa.array(np.append(0, ends), pa.int32(), mask=np.append(none, False))
    entries = pa.StructArray.from_arrays([known.take(pa.array(order[term])), pa.array(n, pa.int64())], ["term", "n"])
    largest = np.zeros(len(rows), np.int64)
    np.maximum.at(largest, doc, n)
    return [pa.ListArray.from_arrays(offsets, entries), pa.array(largest, pa.int64(), mask=largest == 0)]


def term_bags(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """(doc_id, *keep, terms ARRAY<STRUCT<term, n>>, max_n) from one row per document, terms in order.

    ``max_n`` is NULL for a document without terms.
    """
    names = ["doc_id", *keep]
    runs = docs.select(*names, F.array_join(word_runs(F.col(text)), " ").alias("_runs"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _parts(batch, "_runs"):
                columns = [*map(rows.column, names), *_counted(rows, "_runs")]
                yield pa.RecordBatch.from_arrays(columns, [*names, "terms", "max_n"])

    made = [T.StructField("terms", _TERMS), T.StructField("max_n", T.LongType())]
    return runs.mapInArrow(bags, T.StructType([*runs.schema.fields[:-1], *made]))


def term_counts(bags: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, *keep, term, n): one row per document and term."""
    # inline_outer with a filter after it: for plain inline the optimizer adds
    # "array is not empty" below, which would build every bag twice
    rows = bags.select("doc_id", *keep, F.inline_outer("terms"))
    return rows.where(F.col("term").isNotNull())


def term_frequencies(bags: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, *keep, term, n, tf) with ``tf = n / largest n of the document``."""
    rows = bags.select("doc_id", *keep, "max_n", F.inline_outer("terms"))
    return rows.where(F.col("term").isNotNull()).select(
        "doc_id", *keep, "term", "n", (F.col("n") / F.col("max_n")).alias("tf")
    )
