"""A persisted set of string keys that answers which of some new keys it has.

Keys lie in folders by hash bucket.  In front of them is a Bloom filter made of
64-bit words: a key belongs to one word of its bucket and sets up to PROBES bits there, so
a probe is one row of a join and building it is one ``bit_or``.  Keys that
the filter excludes are new; only buckets with keys left over are read, and of
those only the key column.  False positives cost reading, never a wrong answer.

Each batch of keys is added under a name of its own.  What is not
named in the commit log is not seen, so adding under the same name again
after a failure, or twice, changes nothing.  ``compact`` merges all batches into one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.sources.commits import CommitLog
from tomeworks.staging import remove, stage

PROBES = 4
_SALT = 1_000_003


@dataclass(frozen=True)
class Layout:
    """``words`` of 64 bits a bucket; 16 bits a key keep false positives near one in a hundred."""

    buckets: int = 256
    words: int = 1 << 16


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def bucket_of(key: Column, layout: Layout) -> Column:
    return F.pmod(_hash(key), F.lit(layout.buckets)).cast("int")


def _word_of(key: Column, layout: Layout) -> Column:
    return F.pmod(F.shiftright(_hash(key), 20), F.lit(layout.words)).cast("int")


def _mask_of(key: Column) -> Column:
    """The bits of a key in its word; two of them may coincide."""
    second = F.xxhash64(key, F.lit(_SALT))
    mask = F.lit(0).cast("bigint")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


class KeyIndex:
    def __init__(self, spark: SparkSession, folder: str, layout: Layout = Layout()):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/commits")
        last = self.log.last()
        # an existing index keeps the layout it was made with
        self.layout = Layout(last["buckets"], last["words"]) if last else layout

    def _batches(self) -> list[dict]:
        """The batches that make up the index now."""
        last = self.log.last()
        return last["batches"] if last else []

    def names(self) -> set[str]:
        return {name for batch in self._batches() for name in batch["names"]}

    def _write(self, keys: DataFrame, names: list[str]) -> dict:
        """Keys by bucket, and their filter; ``keys`` has one column ``key``, without repeats."""
        place = uuid.uuid4().hex
        key = F.col("key")
        rows = keys.withColumn("bucket", bucket_of(key, self.layout))
        # one file a bucket and task: rows of a bucket come together first
        rows.repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(
            f"{self.folder}/keys/{place}"
        )
        written = self._read([{"place": place}], "keys", "key string, bucket int")
        filters = written.groupBy("bucket", _word_of(key, self.layout).alias("word")).agg(
            F.bit_or(_mask_of(key)).alias("bits")
        )
        filters.write.parquet(f"{self.folder}/filter/{place}")
        return {"place": place, "names": names}

    def _read(self, batches: list[dict], part: str, schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        read = None
        for batch in batches:
            one = self.spark.read.schema(schema).parquet(f"{self.folder}/{part}/{batch['place']}")
            read = one if read is None else read.unionByName(one)
        return read

    def add(self, keys: DataFrame, name: str) -> None:
        """Adds the keys of the only column of ``keys`` (no repeats, none in the index) under a name."""
        batches = self._batches()
        if name in self.names():
            return
        batch = self._write(keys.toDF("key").select(F.col("key").cast("string")), [name])
        self._commit([*batches, batch])

    def drop(self, name: str) -> None:
        """Takes back the last batch if it was added under this name alone."""
        batches = self._batches()
        if batches and batches[-1]["names"] == [name]:
            self._commit(batches[:-1])

    def _commit(self, batches: list[dict]) -> None:
        self.log.append({"buckets": self.layout.buckets, "words": self.layout.words, "batches": batches})

    def compact(self, keep_names: bool = True, but: str | None = None) -> None:
        """Merges all batches into one, except the one named ``but``; old folders go after the new one is committed.

        Without ``keep_names`` the index no longer knows under which names its keys
        were added: for callers that never add under an old name again.
        """
        batches = [b for b in self._batches() if b["names"] != [but]]
        rest = [b for b in self._batches() if b["names"] == [but]]
        if len(batches) < 2:
            return
        names = sorted({n for b in batches for n in b["names"]}) if keep_names else []
        merged = self._write(self._read(batches, "keys", "key string, bucket int").select("key"), names)
        self._commit([merged, *rest])
        self.log.forget()
        for batch in batches:
            for part in ("keys", "filter"):
                remove(self.spark, f"{self.folder}/{part}/{batch['place']}")

    def candidates(self, keys: DataFrame) -> DataFrame:
        """(key, bucket) of the keys that the filter does not exclude."""
        probes = keys.toDF("key").select(
            F.col("key").cast("string").alias("key"),
            bucket_of(F.col("key").cast("string"), self.layout).alias("bucket"),
            _word_of(F.col("key").cast("string"), self.layout).alias("word"),
            _mask_of(F.col("key").cast("string")).alias("mask"),
        )
        filters = self._read(self._batches(), "filter", "bucket int, word int, bits bigint")
        merged = filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        return probes.join(merged, ["bucket", "word"]).where(hit).select("key", "bucket")

    def seen(self, keys: DataFrame) -> DataFrame:
        """(key): those of the keys (one column, no repeats) that the index has."""
        batches = self._batches()
        if not batches:
            return self.spark.createDataFrame([], "key string")
        left = stage(self.candidates(keys), "candidates")
        touched = [r["bucket"] for r in left.select("bucket").distinct().collect()]  # as many as there are buckets
        stored = self._read(batches, "keys", "key string, bucket int").where(F.col("bucket").isin(touched))
        return left.join(stored, ["bucket", "key"], "left_semi").select("key")
