"""Global numbering and running totals without a single-task sort.

A window ordered over a whole table would put the table into one task.  Here the
keys are range-partitioned into slabs, each slab is numbered by itself, and only
one row per slab (as many as there are shuffle partitions) is combined globally.
Keys must be unique, so no slab can grow beyond its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomeworks.staging import stage


def _slabs(df: DataFrame, key: str, *others: str) -> DataFrame:
    """Staged, because slab limits come from sampling: both passes must see the same slabs."""
    ranged = df.select(key, *others).repartitionByRange(key)
    return stage(ranged.withColumn("_slab", F.spark_partition_id()), "slabs")


def _offsets(slabs: DataFrame, amount: Column) -> DataFrame:
    before = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slabs.groupBy("_slab").agg(amount.alias("_size"))
    return sizes.select("_slab", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def dense_sequence(df: DataFrame, key: str) -> DataFrame:
    """(key, position): 0-based positions in the order of a unique key."""
    slabs = _slabs(df, key)
    local = F.row_number().over(Window.partitionBy("_slab").orderBy(key))
    # one row per shuffle partition, whatever the size of the data
    offsets = F.broadcast(_offsets(slabs, F.count("*")))
    numbered = slabs.withColumn("_local", local).join(offsets, "_slab")
    return numbered.select(key, (F.col("_offset") + F.col("_local") - 1).alias("position"))


def running_total(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` plus the sum of ``value`` over all rows up to and including this one."""
    others = [c for c in df.columns if c != key]
    slabs = _slabs(df, key, *others)
    upto = Window.partitionBy("_slab").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    offsets = F.broadcast(_offsets(slabs, F.sum(value)))
    summed = slabs.withColumn("_local", F.sum(value).over(upto)).join(offsets, "_slab")
    return summed.select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))
