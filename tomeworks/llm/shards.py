"""Balanced shards by histogram sort, with built-in functions only.

Documents are ordered by (hash of the text, doc_id), so equal texts are
neighbours.  The shards are ranges of this order with nearly equal bytes.  Their
limits are found by counting, not by sampling: in every round one aggregation
counts the exact bytes below each probe key, over all partitions, and brings
back one row per gap between probes.  A gap that holds a wanted limit gets new
probes between its smallest and largest key, until a limit is within the
tolerance or its gap holds a single key.  The driver sees at most PROBES + 2 rows per limit.
Then the rows move once, to their shard and a slab within it; slabs are numbered
by themselves and shifted by the sizes of those before.

A group of equal texts shares a shard, unless a limit falls inside it: then it
continues in the next one, ordered by doc_id.  A null text counts as empty, of
size 1; a null doc_id comes first.  Repeated rows are kept and get slots of
their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query, small_join, whole
from tomeworks.staging import stage

SHARDS = 8
TOLERANCE = 0.001  # of an even share
PROBES = 6  # per limit and round
SLAB_ROWS = 20_000
_LEAST = -(1 << 63)

Key = tuple[int, int]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the order (_k1, _k2), the size in bytes and the checksum."""
    text = whole(F.col("text"))
    return docs.withColumns(
        {
            "_k1": F.xxhash64(text),
            "_k2": F.coalesce(F.col("doc_id"), F.lit(_LEAST)),
            "size": F.octet_length(text).cast("bigint") + 1,
            "text_crc32": F.crc32(text),
        }
    )


def _number(key: Key) -> int:
    return ((key[0] - _LEAST) << 64) + (key[1] - _LEAST)


def _key(number: int) -> Key:
    return (number >> 64) + _LEAST, (number & ((1 << 64) - 1)) + _LEAST


def _from(key: Key) -> Column:
    """Whether a row is at or after the key."""
    k1, k2 = F.lit(key[0]).cast("bigint"), F.lit(key[1]).cast("bigint")
    return (F.col("_k1") > k1) | ((F.col("_k1") == k1) & (F.col("_k2") >= k2))


def _place(keys: Sequence[Key]) -> Column:
    """How many of the keys, which ascend, are at or before the row."""
    place = F.lit(0)
    for key in keys:
        place = place + _from(key).cast("int")
    return place


def splitters(rows: DataFrame, n: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[Key]:
    """The first keys of the shards after the first; ``rows``: a stage table with _k1, _k2 and size."""
    key = F.struct("_k1", "_k2")
    whole_range = rows.agg(F.sum("size").alias("size"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    total = whole_range["size"] or 0
    if not total:
        return []
    near = tolerance * total / n
    wanted = [total * i / n for i in range(1, n)]
    # of each wanted limit: bytes before the gap that holds it, the gap's bytes, its smallest and largest key
    gaps = [(0, total, _number(tuple(whole_range["low"])), _number(tuple(whole_range["high"])))] * (n - 1)
    found: list[int | None] = [None] * (n - 1)
    while None in found:
        tried = set()
        for i, (_, _, low, high) in enumerate(gaps):
            if found[i] is None:
                tried |= {low, high} | {low + (high - low) * p // (probes + 1) for p in range(1, probes + 1)}
        ordered = sorted(tried)
        counted = (
            rows.select("_k1", "_k2", "size", _place([_key(x) for x in ordered]).alias("gap"))
            .groupBy("gap")
            .agg(F.sum("size").alias("size"), F.min(key).alias("low"), F.max(key).alias("high"))
            .orderBy("gap")
            .collect()
        )
        before = 0
        for row in counted:
            low, high = _number(tuple(row["low"])), _number(tuple(row["high"]))
            for i, target in enumerate(wanted):
                if found[i] is not None or not before <= target < before + row["size"]:
                    continue
                left, right = target - before, before + row["size"] - target
                if min(left, right) <= near or low == high:
                    found[i] = low if left <= right else high + 1
                gaps[i] = (before, row["size"], low, high)
            before += row["size"]
    return [_key(x) for x in sorted(found)]


def shard(docs: DataFrame, n: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with size, text_crc32, shard (0 to n-1) and slot (gapless from 0 in each shard).

    ``docs`` is read twice.  Columns of these names are replaced.
    """
    rows = keyed(docs)
    limits = splitters(stage(rows.select("_k1", "_k2", "size"), "order-keys"), n, tolerance)
    return _slots(rows.withColumn("shard", _place(limits)))


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each shard; this is the one exchange of the rows."""
    # narrower than the rows, counted before they move
    counts = rows.groupBy("shard").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    slabs = 1 + most // SLAB_ROWS
    slab = F.pmod(F.xxhash64("_k1", "_k2"), F.lit(slabs)).alias("slab")
    sizes = stage(rows.groupBy("shard", slab).agg(F.count("*").alias("n")), "slab-sizes")
    before = Window.partitionBy("shard").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("shard").alias("_s"), F.col("slab").alias("_b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("shard", "_slab").orderBy("_k1", "_k2")
    numbered = rows.withColumn("_slab", slab).withColumn("_rank", F.row_number().over(inside))
    same = (F.col("shard") == F.col("_s")) & (F.col("_slab") == F.col("_b"))
    placed = small_join(numbered, offsets, sizes.count(), same, "inner")
    slot = (F.col("_offset") + F.col("_rank") - 1).cast("bigint")
    return placed.withColumn("slot", slot).drop("_k1", "_k2", "_slab", "_rank", "_s", "_b", "_offset")


def write_shards(docs: DataFrame, path: str, n: int = SHARDS, tolerance: float = TOLERANCE) -> None:
    """Writes the documents as one folder per shard, each as several files in the global order."""
    shard(docs, n, tolerance).write.partitionBy("shard").parquet(path)


@query
def op3_histogram_shards(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    # the text itself need not move for the assignment
    rows = stage(keyed(docs).drop("text"), "order-keys")
    placed = _slots(rows.withColumn("shard", _place(splitters(rows, SHARDS))))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
