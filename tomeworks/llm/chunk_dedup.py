"""Repeated passages, found by content-defined chunks.

A gear hash rolls over the bytes of a text: each step doubles it and adds a
number that belongs to the byte, so in 16 bits it depends on the last 16 bytes
only.  A chunk ends where the top bits are zero, hence an insertion moves the
ends near it and no others.  Chunks have 16 to 96 bytes, some 45 on average, so
that a passage of 50 words holds several whole ones.

Chunks are deduplicated by a 128-bit digest: all but the first occurrence, in
the order of the rows, are repeats.  Neighbouring repeats form a run, and a run
of MIN_RUN bytes or more is a repeated passage; single chunks of everyday words
are no passage.  Counting digests is summed on the map side, so a chunk that is
everywhere costs no more than another.

Null and empty texts have no chunks.  Rows are told apart by their place in the
stage table, so null and repeated ids do no harm; of repeated rows the first
stays.  An empty table gives an empty result.  Columns named like the results
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query
from tomeworks.staging import stage

LEAST, MOST = 16, 96
_MASK = np.uint16(0xF800)  # five bits: an end every 32 bytes
MIN_RUN = 96
_PART = 1 << 22

# One number per byte value, the same everywhere.
_GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b])) & 0xFFFF for b in range(256)], dtype=np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The hash after each byte: the sum of the last 16 bytes' numbers, each doubled once per later byte."""
    h = _GEAR[data]
    for reach in (1, 2, 4, 8):
        h[reach:] = h[reach:] + (h[:-reach] << np.uint16(reach))
    return h


def chunk_ends(data: bytes) -> list[int]:
    """The end of every chunk, the last being the length of the text."""
    found = []
    for start in range(0, len(data), _PART):  # bounded memory for very long texts
        lead = min(start, 15)
        part = np.frombuffer(data, np.uint8, min(_PART, len(data) - start) + lead, start - lead)
        found.append(np.flatnonzero((gear_hashes(part)[lead:] & _MASK) == 0) + start + 1)
    ends, last, size = [], 0, len(data)
    for end in np.concatenate(found).tolist() if found else []:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST:
            ends.append(end)
            last = end
    while size - last > MOST:
        last += MOST
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        high, low, ends, offsets = [], [], [], [0]
        for text in batch.column("text"):
            data = (text.as_py() or "").encode()
            at = chunk_ends(data)
            start = 0
            for end in at:
                digest = xxhash.xxh3_128_digest(data[start:end])
                high.append(digest)
                start = end
            ends.extend(at)
            offsets.append(len(ends))
        pairs = np.frombuffer(b"".join(high), dtype=">i8").astype(np.int64).reshape(-1, 2)
        places = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(places, pa.array(v)) for v in (pairs[:, 0], pairs[:, 1], np.array(ends, np.int32))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "d1", "d2", "ends"])


def chunked(docs: DataFrame) -> DataFrame:
    """(row, doc_id, d1, d2, ends): digests and ends of the chunks of every row, staged; ``row`` is in input order."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    made = rows.mapInArrow(_chunks, "doc_id bigint, d1 array<bigint>, d2 array<bigint>, ends array<int>")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "chunks")


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """(row, place, first_row): every chunk that occurred before, with the row of its first occurrence."""
    pairs = F.posexplode(F.arrays_zip("d1", "d2"))
    rows = chunks.select("row", pairs.alias("place", "d")).select("row", "place", "d.d1", "d.d2")
    first = (
        rows.groupBy("d1", "d2")
        .agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("first"))
        .where("n > 1")
        .select("d1", "d2", F.col("first.row").alias("first_row"), F.col("first.place").alias("first_place"))
    )
    found = rows.join(first, ["d1", "d2"])
    later = (F.col("row") != F.col("first_row")) | (F.col("place") != F.col("first_place"))
    return found.where(later).select("row", "place", "first_row")


def passages(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(row, doc_id, start, stop, n_chunks, first_doc_id): the repeated passages, in bytes of the text's UTF-8."""
    chunks = chunked(docs)
    places = repeated_chunks(chunks).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "first_row"))).alias("repeats"))
    rows = chunks.select("row", "doc_id", "ends").join(places, "row")
    # a run is a stretch of places without a gap
    run = F.expr(
        """aggregate(repeats, cast(array() as array<struct<a:int,b:int,f:bigint>>), (runs, x) ->
             if(size(runs) > 0 and element_at(runs, -1).b + 1 = x.place,
                concat(slice(runs, 1, size(runs) - 1),
                       array(struct(element_at(runs, -1).a as a, x.place as b, element_at(runs, -1).f as f))),
                concat(runs, array(struct(x.place as a, x.place as b, x.first_row as f)))))"""
    )
    runs = rows.select("row", "doc_id", "ends", F.explode(run).alias("run")).select(
        "row",
        "doc_id",
        F.when(F.col("run.a") > 0, F.get("ends", F.col("run.a") - 1)).otherwise(0).alias("start"),
        F.get("ends", F.col("run.b")).alias("stop"),
        (F.col("run.b") - F.col("run.a") + 1).alias("n_chunks"),
        F.col("run.f").alias("first_row"),
    )
    kept = runs.where(F.col("stop") - F.col("start") >= min_run)
    firsts = chunks.select(F.col("row").alias("first_row"), F.col("doc_id").alias("first_doc_id"))
    return kept.join(firsts, "first_row").drop("first_row")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, cuts in zip(batch.column("text"), batch.column("_cuts")):
            data, kept, at = (text.as_py() or "").encode(), [], 0
            for cut in cuts.as_py() or ():
                kept.append(data[at : cut["start"]])
                at = cut["stop"]
            # a cut may fall inside a character
            texts.append(None if text.as_py() is None else b"".join([*kept, data[at:]]).decode(errors="ignore"))
        place = batch.schema.get_field_index("text")
        yield batch.set_column(place, "text", pa.array(texts, pa.string())).drop_columns(["_cuts"])


def remove_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` without its repeated passages; rows keep their other columns."""
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = passages(rows.select(F.col("_row").alias("doc_id"), "text"), min_run)
    cuts = found.groupBy(F.col("doc_id").alias("_r")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_cuts"))
    both = rows.join(cuts, F.col("_row") == F.col("_r"), "left").select(*docs.columns, "_cuts")
    return both.mapInArrow(_without, docs.schema)


@query
def op10_chunk_dedup(spark, folder):
    """One row per repeated passage: its document, its bytes, and a document that had it before."""
    found = passages(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("start").cast("bigint").alias("start_byte"),
        F.col("stop").cast("bigint").alias("stop_byte"),
        F.col("n_chunks").cast("bigint").alias("n_chunks"),
        "first_doc_id",
    )
