"""Joining many rows to one row per key when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64
_FINEST = 20  # a key with 1 / 2**20 of the rows may still count as frequent


def _row_bytes(df: DataFrame, overhead: int = _ROW_OVERHEAD) -> Column:
    """The size of a row: strings by their length, everything else by a fixed width."""
    size = F.lit(overhead)
    for f in df.schema.fields:
        text = f.dataType.typeName() in ("string", "binary")
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) if text else F.lit(16))
    return size


def hot_keys(
    keys: DataFrame,
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    overhead: int = _ROW_OVERHEAD,
    finest: int = _FINEST,
) -> Column | None:
    """Which rows of ``keys`` are frequent (see ``keyed_lookup``); None if all rows fit the limit.

    ``overhead`` is what a row takes besides its columns; H is at most 2**finest.
    """
    bytes_of = _row_bytes(keys, overhead)
    total = keys.agg(F.sum(bytes_of).alias("bytes"), F.sum(weight).alias("rows")).first()
    if (total["bytes"] or 0) <= broadcast_bytes:
        return None
    share = lambda k: F.col(weight) * F.lit(1 << k) >= F.lit(total["rows"])
    sizes = keys.agg(*[F.sum(F.when(share(k), bytes_of)).alias(str(k)) for k in range(finest + 1)]).first()
    fitting = [k for k in range(finest + 1) if (sizes[str(k)] or 0) <= broadcast_bytes]
    return share(max(fitting)) if fitting else F.lit(False)


def keyed_lookup(
    facts: DataFrame,
    keys: DataFrame,
    on: str,
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``facts`` with ``keys`` (one row per key) on a string key.

    ``weight`` says how many fact rows carry the key.  Sizes are checked first:

    * a small ``keys`` table is broadcast, and ``facts`` is not shuffled at all;
    * otherwise the frequent keys are broadcast and only the rest is shuffled.
      A key is frequent when it has at least 1/H of all fact rows; no more than
      H keys can.  H is the largest power of two for which the rows of these
      keys, with all their columns, fit the broadcast limit.  What is left for
      the shuffle has no key above 1/H of the rows.

    Both inputs should be stage tables, since they are read more than once.
    """
    is_hot = hot_keys(keys, weight, broadcast_bytes)
    if is_hot is None:
        return facts.join(F.broadcast(keys), on, "inner")

    hot = F.broadcast(keys.where(is_hot))
    cold = keys.where(~is_hot)
    frequent = facts.join(hot, on, "inner")
    rare = facts.join(hot.select(on), on, "left_anti").join(cold, on, "inner")
    return frequent.unionByName(rare)
