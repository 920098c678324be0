"""TF·IDF vectors of documents as they arrive.

Every micro-batch is weighted with the IDF table that is the newest when the batch
begins.  That table is versioned: ``publish_idf`` makes a new version from the
running document frequency, and the next batch uses it.  Term counts are kept
beside the vectors, so that ``VectorStore.refresh`` brings vectors made with an
older table up to date without reading a text again.

What a batch has written counts from the moment its entry is in the commit log; a
batch that is run again replaces its rows.  A document without an id, or without
a term in the IDF table, has no vector, as in the batch job.  Of several rows
with one id in a batch one counts; in different batches each has its vector.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tomeworks.functions.hashing import DEFAULT_BUCKETS
from tomeworks.operators.lookup import BROADCAST_BYTES
from tomeworks.operators.terms import term_bags, term_frequencies
from tomeworks.operators.vectors import bucket_sums, sparse_vectors
from tomeworks.operators.weights import inverse_frequency, tfidf, with_buckets
from tomeworks.sources.commits import CommitLog
from tomeworks.sources.versions import VersionedTable
from tomeworks.staging import children, remove
from tomeworks.streaming import running_df

_SCHEMAS = {
    "bags": "doc_id bigint, batch bigint, terms array<struct<term:string,n:bigint>>, max_n bigint",
    "vectors": "doc_id bigint, batch bigint, idf_version bigint, vec array<struct<bucket:int,w:double>>",
}


def publish_idf(
    spark: SparkSession,
    log_folder: str,
    table: VersionedTable,
    buckets: int = DEFAULT_BUCKETS,
    hash_name: str = "md5",
    log: bool = True,
) -> int:
    """A new version of (term, df, idf, bucket) from what the frequency log holds now; returns its number.

    Everything up to the last batch that is complete counts, also while the stream goes on.
    """
    frequencies, n_docs = running_df.snapshot(spark, log_folder, running_df.last_batch(spark, log_folder))
    return table.write(with_buckets(inverse_frequency(frequencies, n_docs, log), buckets, hash_name))


class VectorStore:
    """The vectors of all batches: a folder for each batch since the last refresh, and one for all before it."""

    def __init__(self, spark: SparkSession, folder: str, broadcast_bytes: int = BROADCAST_BYTES):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.broadcast_bytes = broadcast_bytes
        self.log = CommitLog(spark, f"{self.folder}/commits")

    def _parts(self) -> list[dict]:
        """The entries that count: the last refresh and, of every batch after it, the last."""
        entries = self.log.entries()
        refreshed = [i for i, e in enumerate(entries) if e["batch"] is None]
        entries = entries[refreshed[-1] if refreshed else 0 :]
        return list({e["batch"]: e for e in entries}.values())

    def _read(self, kind: str, parts: list[dict]) -> DataFrame:
        reader = self.spark.read.schema(_SCHEMAS[kind])
        paths = lambda own: [f"{self.folder}/data/{e['place']}/{kind}" for e in own]
        batches = [e for e in parts if e["batch"] is not None]
        rows = reader.parquet(*paths(batches)) if batches else self.spark.createDataFrame([], _SCHEMAS[kind])
        for e in parts:
            if e["batch"] is None:
                # a batch run again after the refresh replaces what the refresh had taken from it
                again = [b["batch"] for b in batches if b["batch"] <= e["upto"]]
                rows = reader.parquet(*paths([e])).where(~F.col("batch").isin(again)).unionByName(rows)
        return rows

    def vectors(self) -> DataFrame:
        """(doc_id, batch, idf_version, vec) of everything that has arrived."""
        return self._read("vectors", self._parts())

    def bags(self) -> DataFrame:
        """(doc_id, batch, terms, max_n): the counts the vectors are made from."""
        return self._read("bags", self._parts())

    def _weighted(self, bags: DataFrame, table: VersionedTable, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], _SCHEMAS["vectors"])
        keyed = bags.select(F.struct("doc_id", "batch").alias("doc_id"), "terms", "max_n")
        rows = tfidf(term_frequencies(keyed), table.read(version), self.broadcast_bytes)
        return sparse_vectors(bucket_sums(rows, "tfidf")).select(
            "doc_id.doc_id", "doc_id.batch", F.lit(version).cast("bigint").alias("idf_version"), "vec"
        )

    def _write(self, bags: DataFrame, table: VersionedTable) -> tuple[str, int | None]:
        place, version = uuid.uuid4().hex, table.version()
        path = f"{self.folder}/data/{place}"
        bags.write.parquet(f"{path}/bags")
        counted = self.spark.read.schema(_SCHEMAS["bags"]).parquet(f"{path}/bags")
        self._weighted(counted, table, version).write.parquet(f"{path}/vectors")
        return place, version

    def add(self, batch: DataFrame, batch_id: int, idf: VersionedTable) -> None:
        """Counts and weights the documents (doc_id, text) of a batch.

        Before the first IDF version there are counts only; a refresh makes the vectors.
        """
        known = batch.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
        bags = term_bags(known).select("doc_id", F.lit(batch_id).cast("bigint").alias("batch"), "terms", "max_n")
        place, version = self._write(bags, idf)
        self.log.append({"batch": batch_id, "place": place, "version": version})

    def refresh(self, idf: VersionedTable) -> int:
        """Weights everything that has arrived with the newest IDF table; returns the version.

        Not while a batch is being written.  The folders the store consisted of stay for
        readers that began before, until the next refresh.
        """
        if idf.version() is None:
            raise FileNotFoundError(f"no version in {idf.folder}")
        parts = self._parts()
        place, version = self._write(self._read("bags", parts), idf)
        upto = max((e["upto"] if e["batch"] is None else e["batch"] for e in parts), default=-1)
        self.log.append({"batch": None, "upto": upto, "place": place, "version": version})
        self.log.forget()
        held = {place, *(e["place"] for e in parts)}
        for path in children(self.spark, f"{self.folder}/data"):
            if path.rsplit("/", 1)[1] not in held:
                remove(self.spark, path)
        return version


def start_vectors(
    documents: DataFrame,
    idf: VersionedTable,
    folder: str,
    checkpoint: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """Weight the documents (doc_id, text) of a stream until none are left; the result is ``VectorStore(spark, folder)``.

    A batch reads the IDF table once; a table too large to be broadcast is shuffled
    but for its frequent terms, so batches should then be large (``files_per_batch``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = VersionedTable(batch.sparkSession, idf.folder, idf.keep)
        VectorStore(batch.sparkSession, folder, broadcast_bytes).add(batch, batch_id, own)

    return (
        documents.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
