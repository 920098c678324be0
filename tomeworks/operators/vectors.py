"""Weighted hashing vectors: sums per bucket, sparse arrays and ML vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomeworks.functions.hashing import BUCKET_FUNCTIONS, DEFAULT_BUCKETS, md5_buckets
from tomeworks.operators.lookup import BROADCAST_BYTES, hot_keys
from tomeworks.staging import stage_path


def hash_terms(
    rows: DataFrame, buckets: int = DEFAULT_BUCKETS, hash_name: str = "md5"
) -> DataFrame:
    """``rows`` with the bucket of each ``term``."""
    return rows.withColumn("bucket", BUCKET_FUNCTIONS[hash_name](F.col("term"), buckets))


def bucket_sums(rows: DataFrame, weight: str) -> DataFrame:
    """(doc_id, bucket, w): weights summed per document and bucket.

    Rows are clustered by document alone, which serves this aggregation and a
    later one per document: one shuffle for both.  Few terms of one document
    share a bucket, so summing before the shuffle would save next to nothing.
    """
    narrow = rows.select("doc_id", "bucket", F.col(weight).alias("w")).repartition("doc_id")
    return narrow.groupBy("doc_id", "bucket").agg(F.sum("w").alias("w"))


def _starts(ids: pa.Array) -> np.ndarray:
    """Where a run of equal ids begins; NULL equals NULL."""
    after, before = ids.slice(1), ids.slice(0, max(0, len(ids) - 1))
    changed = pc.fill_null(pc.not_equal(after, before), False).to_numpy(zero_copy_only=False)
    changed = changed | (after.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))
    return np.concatenate([[0], np.flatnonzero(changed) + 1])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, buckets, weights): neighbouring rows of one document as one row."""
    for batch in batches:
        if not len(batch):
            continue
        ids = batch.column("doc_id")
        starts = _starts(ids)
        offsets = pa.array(np.append(starts, len(batch)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, batch.column(c)) for c in ("bucket", "w")]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(starts)), *lists], ["doc_id", "buckets", "weights"])


_AT_ONCE = 2_000_000  # entries summed at a time


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, vec) from rows ordered by document; the last document of a batch may go on in the next."""

    def vectors(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, lists = rows.column("doc_id"), rows.column("buckets")
        starts = _starts(ids)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows)))), sizes)
        bucket, w = lists.flatten().to_numpy(), rows.column("weights").flatten().to_numpy()
        order = np.lexsort((bucket, doc))
        doc, bucket, w = doc[order], bucket[order], w[order]
        heads = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(bucket) != 0)))
        offsets = np.append(0, np.cumsum(np.bincount(doc[heads], minlength=len(starts))))
        entries = pa.StructArray.from_arrays(
            [pa.array(bucket[heads], pa.int32()), pa.array(np.add.reduceat(w, heads))], ["bucket", "w"]
        )
        vec = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(starts)), vec], ["doc_id", "vec"])

    held: list[pa.RecordBatch] = []
    entries = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        entries += len(batch.column("buckets").flatten())
        if entries < _AT_ONCE:
            continue
        rows = pa.concat_batches(held)
        last = int(_starts(rows.column("doc_id"))[-1])
        if last:
            yield vectors(rows.slice(0, last))
        held = [rows.slice(last)]
        entries = len(held[0].column("buckets").flatten())
    if held:
        yield vectors(pa.concat_batches(held))


def weighted_vectors(rows: DataFrame, weight: str) -> DataFrame:
    """(doc_id, vec ARRAY<STRUCT<bucket, w>>) in bucket order: weights summed per document and bucket.

    What ``sparse_vectors`` makes of ``bucket_sums``, without a group or an exchanged
    row per entry: entries that follow each other are put together first, so an
    exchange by document moves little more than a row a document, and only those
    rows are sorted.
    """
    return _by_document(_entry_runs(rows.select("doc_id", "bucket", F.col(weight).alias("w"))))


def _entry_runs(entries: DataFrame) -> DataFrame:
    kind = entries.schema["doc_id"].dataType.simpleString()
    return entries.mapInArrow(_runs, f"doc_id {kind}, buckets array<int>, weights array<double>")


def _by_document(parts: DataFrame) -> DataFrame:
    """(doc_id, vec) of (doc_id, buckets, weights), any number of rows a document."""
    kind = parts.schema["doc_id"].dataType.simpleString()
    ordered = parts.repartition("doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(_merged, f"doc_id {kind}, vec array<struct<bucket:int,w:double>>")


_FINEST = 30  # a term with 1 / 2**30 of the entries may still be looked up in the row


def _bag_entries(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """Row, numbered term and count of every entry of the bags."""
    lists = batch.column("terms")
    entries = lists.flatten()
    row = np.repeat(np.arange(len(batch)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    return row, entries.field("term").dictionary_encode(), entries.field("n").to_numpy()


def _summed(row: np.ndarray, bucket: np.ndarray, w: np.ndarray, rows: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Offsets, buckets and sums of the rows, in bucket order."""
    width = int(bucket.max(initial=0)) + 1
    cells, at = np.unique(row * width + bucket, return_inverse=True)
    row, bucket = np.divmod(cells, width)
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=rows)))
    return pa.array(offsets, pa.int32()), pa.array(bucket, pa.int32()), np.bincount(at, w, minlength=len(cells))


def tfidf_vectors(bags: DataFrame, idf: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, vec): what ``weighted_vectors`` makes of ``weights.tfidf``, from the stage tables of bags and of (term, df, idf, bucket).

    The frequent terms, as many as fit the limit, are in every task, and a bag is weighted and
    summed in its row.  Only entries of other terms become rows, for the join; most entries never do.
    """
    keys = idf.select("term", "df", "idf", "bucket")
    is_hot = hot_keys(keys, "df", broadcast_bytes, overhead=0, finest=_FINEST)
    hot = (keys if is_hot is None else keys.where(is_hot)).select("term", "idf", "bucket").toArrow()  # within the limit
    columns = [hot.column(c).combine_chunks() for c in ("term", "idf", "bucket")]
    shared = bags.sparkSession.sparkContext.broadcast(columns)

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]:
        """Row, term, place among the frequent ones or -1, and TF of every entry."""
        row, term, n = _bag_entries(batch)
        place = pc.fill_null(pc.index_in(term.dictionary, value_set=shared.value[0]), -1).to_numpy()
        return row, term, place[term.indices.to_numpy()], n / batch.column("max_n").to_numpy(zero_copy_only=False)[row]

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bucket = (c.to_numpy() for c in shared.value[1:])
        for batch in batches:
            row, _, place, tf = found(batch)
            known = place >= 0
            place = place[known]
            offsets, buckets, sums = _summed(row[known], bucket[place], tf[known] * weight[place], len(batch))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (buckets, pa.array(sums))]
            some = pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "buckets", "weights"])
            yield some.filter(pc.greater(lists[0].value_lengths(), 0))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, place, tf = found(batch)
            at = np.flatnonzero(place < 0)
            term = term.dictionary.take(term.indices.take(pa.array(at)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row[at])), term, pa.array(tf[at])], ["doc_id", "term", "tf"])

    kind = bags.schema["doc_id"].dataType.simpleString()
    rows = bags.select("doc_id", "terms", "max_n")
    parts = rows.mapInArrow(frequent, f"doc_id {kind}, buckets array<int>, weights array<double>")
    if is_hot is not None:
        rare = rows.mapInArrow(others, f"doc_id {kind}, term string, tf double").join(keys.where(~is_hot), "term")
        parts = parts.unionByName(_entry_runs(rare.select("doc_id", "bucket", (F.col("tf") * F.col("idf")).alias("w"))))
    return _by_document(parts)


def sparse_entries(batch: pa.RecordBatch, column: str, value: str = "w") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of every entry of a column of sparse vectors."""
    lists = batch.column(column)
    entries = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(batch)), sizes)
    return row, entries.field("bucket").to_numpy(), entries.field(value).to_numpy()


def bag_vectors(bags: DataFrame, buckets: int = DEFAULT_BUCKETS, hash_name: str = "md5") -> DataFrame:
    """(doc_id, vec): the TF vector of each bag, made inside its row, without any exchange.

    Documents without terms have none.
    """
    columns = ["doc_id", "max_n", "terms"]
    if hash_name != "md5":  # other hashes come from Spark, entry by entry
        columns.append(F.transform("terms", lambda t: BUCKET_FUNCTIONS[hash_name](t["term"], buckets)).alias("buckets"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term, n = _bag_entries(batch)
            if hash_name == "md5":
                bucket = md5_buckets(term.dictionary, buckets)[term.indices.to_numpy()]
            else:
                bucket = batch.column("buckets").flatten().to_numpy()
            offsets, bucket, sums = _summed(row, bucket, n, len(batch))
            size = np.diff(offsets.to_numpy())
            w = sums / np.repeat(batch.column("max_n").to_numpy(), size)
            entries = pa.StructArray.from_arrays([bucket, pa.array(w)], ["bucket", "w"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, entries)], ["doc_id", "vec"])

    kind = bags.schema["doc_id"].dataType.simpleString()
    full = bags.where(F.col("max_n").isNotNull()).select(*columns)
    return full.mapInArrow(vectors, f"doc_id {kind}, vec array<struct<bucket:int,w:double>>")


def sparse_vectors(sums: DataFrame) -> DataFrame:
    """(doc_id, vec ARRAY<STRUCT<bucket, w>>) in bucket order.

    A document's array has at most as many entries as there are buckets.
    """
    entries = F.sort_array(F.collect_list(F.struct("bucket", "w")))
    return sums.groupBy("doc_id").agg(entries.alias("vec"))


def with_ml_vectors(df: DataFrame, buckets: int = DEFAULT_BUCKETS, vec: str = "vec") -> DataFrame:
    """``df`` with ``vec`` turned into a spark.ml sparse vector column ``features``.

    Written with the vector's storage layout and read back with the vector type,
    so no row passes through Python.  As a stage table it also serves the many
    model fits that follow.
    """
    spark = df.sparkSession
    others = [f for f in df.schema.fields if f.name != vec]
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(buckets).alias("size"),
        F.col(f"{vec}.bucket").alias("indices"),
        F.col(f"{vec}.w").alias("values"),
    )
    path = stage_path(spark, "vectors")
    df.select(*[f.name for f in others], stored.alias("features")).write.parquet(path)
    schema = T.StructType([*others, T.StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)
