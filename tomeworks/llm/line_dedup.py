"""Repeated blocks of lines, in chunks whose limits the lines themselves choose.

A hash rolls over the hashes of the worded lines, ROLL lines at a time.  Between the lines it covers lies a
boundary unless its highest BITS bits are all zero, so whether two neighbouring lines are parted depends on these two only,
and limits move along with text that is inserted or removed elsewhere.  The lines between two boundaries are a piece, with the blank
lines among them.  Chunks are the pieces of two worded lines or more, and around each
boundary its seam, the last line before it with the first one after it, so that passages of short pieces are found too.
A passage of k lines in two texts is missed only if none of the k - 1 places inside it is a
boundary and the pieces at its ends differ.

Digests that occur more than once nominate chunks.  Their bytes are compared with the first occurrence of the digest, in
the order of (doc_id, text digest, place); equal ones are removed but for this first, and other bytes stay.
A single worded line is never removed by itself, nor are blank lines around a passage.

The counting of digests and the search for the first are summed on the map side.  First occurrences are
sent everywhere while they are few in bytes; beyond that only those of frequent digests are, and the rest is
shuffled, so that no popular chunk fills a task.  The documents are shuffled once, to meet their removed chunks.

Null and empty texts have no chunks and stay as they are.  Rows that agree in id
and text are copies of one document: they keep and lose the same lines.
A null doc_id comes first in the order.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import doc_key, documents, query, small_join, with_text
from tomeworks.operators.lookup import keyed_lookup
from tomeworks.staging import stage

ROLL, BITS = 2, 3  # a boundary at 7 of 8 places
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_LEAVING = pow(_BASE, ROLL, 1 << 64)
_FIRSTS_BYTES = 16 << 20
_BLANKS = " \t\v\f\r"


def boundaries(lines: list[str]) -> list[int]:
    """The places i where a boundary parts line i - 1 from line i."""
    hashes = [xxhash.xxh3_64_intdigest(line.encode()) for line in lines]
    found, roll = [], 0
    for i, h in enumerate(hashes):
        roll = (roll * _BASE + h - (_LEAVING * hashes[i - ROLL] if i >= ROLL else 0)) & _MASK
        if i >= ROLL - 1 and roll >> (64 - BITS):
            found.append(i)
    return found


def chunks_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(first line, line after the last, text) of the chunks that may be removed."""
    lines = text.split("\n")
    worded = [i for i, line in enumerate(lines) if line.strip(_BLANKS)]
    at = 0
    for end in [*boundaries([lines[i] for i in worded]), len(worded)]:
        spans = [(at, end)] if end - at > 1 else []
        if end < len(worded):
            spans.append((end - 1, end + 1))
        for a, b in spans:
            first, stop = worded[a], worded[b - 1] + 1
            yield first, stop, "\n".join(lines[first:stop])
        at = end


_CHUNKS = "doc_id bigint, key binary, first int, stop int, digest binary, chunk string"


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("key", pa.binary()), ("first", pa.int32()), ("stop", pa.int32()), ("digest", pa.binary()), ("chunk", pa.string())]
    )
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(*(batch.column(c) for c in ("doc_id", "key", "text"))):
            text = text.as_py()
            if text and "\n" in text:
                doc = (doc_id.as_py(), key.as_py())
                rows += [(*doc, a, b, xxhash.xxh3_128_digest(c.encode()), c) for a, b, c in chunks_of(text)]
        columns = zip(*rows) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(columns, schema.types)], schema=schema)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, key, first, stop): every chunk whose bytes occurred before."""
    keyed = docs.select(F.col("doc_id").cast("bigint"), doc_key().alias("key"), "text")
    chunks = keyed.mapInArrow(_chunk_rows, _CHUNKS)
    place = F.struct("doc_id", "key", "first")
    # staged without the bytes, which are cut again for the few digests that repeat
    found = stage(chunks.select("digest", "doc_id", "key", "first"), "line-chunks")
    often = stage(found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "digests")
    doubtful = stage(small_join(chunks, often, often.count(), ["digest"], "left_semi"), "repeated-line-chunks")
    # equal digests may still be different bytes
    earliest = [F.min(place).alias("earliest"), F.min_by("chunk", place).alias("bytes"), F.count("*").alias("n")]
    firsts = stage(doubtful.groupBy("digest").agg(*earliest), "first-line-chunks")
    both = keyed_lookup(doubtful, firsts, "digest", "n", _FIRSTS_BYTES)
    same = both.where((F.col("chunk") == F.col("bytes")) & (place != F.col("earliest")))
    return same.select("doc_id", "key", "first", "stop").distinct()


def _kept_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed, total = [], [], []
        for text, cuts in zip(batch.column("text"), batch.column("_cuts")):
            text = text.as_py()
            lines = [] if text is None else text.split("\n")
            kept, at, gone = [], 0, 0
            for cut in cuts.as_py() or ():
                kept += lines[at : cut["first"]]
                gone += cut["stop"] - max(at, cut["first"])  # chunks share a line with their neighbours
                at = cut["stop"]
            kept += lines[at:]
            texts.append(None if text is None else "\n".join(kept))
            removed.append(gone)
            total.append(len(lines))
        place = batch.schema.get_field_index("text")
        batch = batch.set_column(place, "text", pa.array(texts, pa.string())).drop_columns(["_cuts"])
        yield batch.append_column("n_lines", pa.array(total, pa.int64())).append_column("n_removed", pa.array(removed, pa.int64()))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated chunks of lines, with n_lines (before) and n_removed.

    ``docs`` is read twice.  Columns named like the two new ones are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    gone = repeated_chunks(docs).groupBy(F.col("key").alias("_k"))
    cuts = gone.agg(F.sort_array(F.collect_list(F.struct("first", "stop"))).alias("_cuts"))
    both = docs.withColumn("_key", doc_key()).join(cuts, F.col("_key") == F.col("_k"), "left").drop("_key", "_k")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_lines bigint, n_removed bigint"
    return both.mapInArrow(_kept_lines, schema)


def stage_docs(docs: DataFrame) -> DataFrame:
    """For a pipeline: documents that lost all they said go, the others keep what is left of their text."""
    cut = remove_repeats(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return with_text(cut.where(left), F.col("text"), docs.columns)


@query
def op1_line_dedup(spark, folder):
    """Every document with what line dedup leaves of it."""
    cut = remove_repeats(documents(spark, folder).select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "text")
