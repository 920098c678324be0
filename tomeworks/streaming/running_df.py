"""Running document frequency.

Two forms with the same result:

* ``running_frequency`` keeps the counts in Spark's state store and emits the
  terms that changed;
* ``start_frequency_log`` keeps no state.  Every micro-batch is reduced to
  (term, df) and written to its own folder, named after the batch, so that a
  batch replayed after a failure replaces its own output.  From time to time the
  folders are merged into a state table; ``snapshot`` adds up the newest one and
  the batches after it.

IDF is computed from a snapshot: N changes with every document, so an IDF inside
the stream would have to touch every term each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tomeworks.functions.text import terms
from tomeworks.operators.terms import term_bags
from tomeworks.operators.vocabulary import document_count, document_frequency
from tomeworks.sources.key_index import KeyIndex, Layout
from tomeworks.staging import children, exists, remove, stage

DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)


_SCHEMAS = {"terms": "term string, df bigint", "docs": "n_docs bigint"}


def document_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, name_glob: str = "*.parquet"
) -> DataFrame:
    """New Parquet files of (doc_id, text) below ``folder`` as a stream."""
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def running_frequency(documents: DataFrame, drop_replays: bool = False) -> DataFrame:
    """Streaming (term, df).

    Each document is reduced to its distinct terms inside its row, so the only
    state is one count per term, in RocksDB (``session.SETTINGS``).  ``drop_replays`` also
    remembers every doc_id for ever: for a stream without end use the log, whose
    ids are a table, or an event-time column with ``dropDuplicatesWithinWatermark``.
    """
    if drop_replays:
        documents = documents.dropDuplicates(["doc_id"])
    each = documents.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    return each.groupBy("term").agg(F.count("*").alias("df"))


def start_frequency_log(
    documents: DataFrame,
    folder: str,
    checkpoint: str,
    merge_every: int = 20,
    drop_replays: bool = False,
    layout: Layout = Layout(),
) -> StreamingQuery:
    """Log the document frequencies of each micro-batch below ``folder`` until none are left.

    Every ``merge_every`` batches the log is merged into one state table and the
    merged folders go, so a snapshot reads a bounded number of them.  ``drop_replays``
    leaves out documents whose id an earlier batch has logged.  The ids are a key
    index below ``folder``, not operator state: a batch reads its filter, whose
    size is bounded by ``layout``, and only buckets that may hold one of its ids.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select("doc_id", "text")
        if drop_replays:
            index, name = KeyIndex(spark, f"{folder}/ids", layout), f"batch-{batch_id}"
            index.drop(name)  # its own ids are there when the batch is run again
            if batch_id % merge_every == 0:
                # all of these batches are committed, or this one would not run
                index.compact(keep_names=False)
            fresh = stage(fresh.dropDuplicates(["doc_id"]), "arrived")
            key = F.col("doc_id").cast("string").alias("key")
            seen = index.seen(fresh.where(F.col("doc_id").isNotNull()).select(key))
            fresh = fresh.join(seen, fresh["doc_id"].cast("string") == seen["key"], "left_anti")
        # several small results from one pass over the batch
        bags = stage(term_bags(fresh), "stream-bags")
        document_frequency(bags).write.mode("overwrite").parquet(f"{folder}/terms/batch={batch_id}")
        document_count(bags).write.mode("overwrite").parquet(f"{folder}/docs/batch={batch_id}")
        if drop_replays:
            index.add(bags.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("string")), name)
        if (batch_id + 1) % merge_every == 0:
            merge(spark, folder, batch_id)

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _merged(spark: SparkSession, folder: str) -> list[int]:
    """The last batches of the complete state tables, ascending."""
    path = f"{folder}/merged"
    if not exists(spark, path):
        return []
    return sorted(int(p.rsplit("=", 1)[1]) for p in children(spark, path) if exists(spark, f"{p}/docs/_SUCCESS"))


def _parts(spark: SparkSession, folder: str, kind: str, upto: int | None = None) -> DataFrame:
    """The newest state table and the batches after it, up to a given one."""
    done = _merged(spark, folder)
    # the schema is given: the folders of all batches may have been merged and removed
    log = spark.read.schema(f"{_SCHEMAS[kind]}, batch bigint").parquet(f"{folder}/{kind}")
    log = log.where(F.col("batch") > (done[-1] if done else -1))
    if upto is not None:
        log = log.where(F.col("batch") <= upto)
    log = log.drop("batch")
    if not done:
        return log
    return spark.read.schema(_SCHEMAS[kind]).parquet(f"{folder}/merged/upto={done[-1]}/{kind}").unionByName(log)


def _summed(spark: SparkSession, folder: str, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
    frequencies = _parts(spark, folder, "terms", upto).groupBy("term").agg(F.sum("df").alias("df"))
    documents = _parts(spark, folder, "docs", upto).agg(F.sum("n_docs").alias("n_docs"))
    return frequencies, documents


def merge(spark: SparkSession, folder: str, upto: int) -> None:
    """One state table of everything up to batch ``upto``; batches run again later do not change it.

    The table counts as soon as its second part is complete.  Then the folders that
    the previous state table had not merged stay for readers that still use it;
    what is older goes.
    """
    done = _merged(spark, folder)
    if done and done[-1] >= upto:
        return
    frequencies, documents = _summed(spark, folder, upto)
    frequencies.write.mode("overwrite").parquet(f"{folder}/merged/upto={upto}/terms")
    documents.write.mode("overwrite").parquet(f"{folder}/merged/upto={upto}/docs")
    for older in done[:-1]:
        remove(spark, f"{folder}/merged/upto={older}")
    for kind in _SCHEMAS:
        for path in children(spark, f"{folder}/{kind}"):
            if done and "batch=" in path and int(path.rsplit("=", 1)[1]) <= done[-1]:
                remove(spark, path)


def last_batch(spark: SparkSession, folder: str) -> int:
    """The number of the last batch that is complete, -1 before the first."""
    paths = children(spark, f"{folder}/docs") if exists(spark, f"{folder}/docs") else []
    logged = [int(p.rsplit("=", 1)[1]) for p in paths if "batch=" in p and exists(spark, f"{p}/_SUCCESS")]
    return max([*logged, *_merged(spark, folder)], default=-1)


def snapshot(spark: SparkSession, folder: str, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(term, df) and the one-row document count of everything logged so far, or up to a batch."""
    return _summed(spark, folder, upto)
