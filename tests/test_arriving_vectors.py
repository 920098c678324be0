"""Vectors of arriving documents against the batch job over the same documents and IDF table."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException

from tomeworks.operators.terms import term_bags, term_frequencies
from tomeworks.operators.vectors import bucket_sums, sparse_vectors
from tomeworks.operators.weights import tfidf
from tomeworks.sources.commits import CommitLog
from tomeworks.sources.versions import VersionedTable
from tomeworks.streaming import arriving_vectors as av
from tomeworks.streaming import running_df

SCHEMA = "doc_id bigint, text string"
FIRST = [(1, "red green red"), (2, "red blue blue")]
LATER = [(3, "green violet"), (4, "")]


class Setting:
    """A folder of arrivals with a frequency log, an IDF table and a store of vectors."""

    def __init__(self, spark, path):
        self.spark = spark
        self.source, self.log, self.made, *self.states = (str(path / n) for n in ("in", "log", "made", "s1", "s2"))
        self.idf = VersionedTable(spark, str(path / "idf"))
        self.store = av.VectorStore(spark, self.made)

    def arrive(self, rows):
        for row in rows:
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def stream(self):
        return running_df.document_stream(self.spark, self.source, files_per_batch=1)

    def publish(self):
        running_df.start_frequency_log(self.stream(), self.log, self.states[0]).awaitTermination()
        return av.publish_idf(self.spark, self.log, self.idf, buckets=50)

    def weigh(self, **options):
        av.start_vectors(self.stream(), self.idf, self.made, self.states[1], **options).awaitTermination()

    def batch_job(self, rows, version):
        bags = term_bags(self.spark.createDataFrame(rows, SCHEMA))
        return found(sparse_vectors(bucket_sums(tfidf(term_frequencies(bags), self.idf.read(version)), "tfidf")))


@pytest.fixture
def setting(spark, tmp_path):
    return Setting(spark, tmp_path)


def found(rows):
    got = rows.select("doc_id", "vec").collect()
    assert len({r.doc_id for r in got}) == len(got)
    return {r.doc_id: [(e.bucket, pytest.approx(e.w)) for e in r.vec] for r in got}


def versions(store):
    return {r.doc_id: r.idf_version for r in store.vectors().collect()}


def test_batches_use_the_newest_table_and_refresh_brings_all_up_to_date(setting):
    setting.arrive(FIRST)
    assert setting.publish() == 0
    setting.weigh()
    assert found(setting.store.vectors()) == setting.batch_job(FIRST, 0)
    setting.arrive(LATER)
    assert setting.publish() == 1
    setting.weigh(broadcast_bytes=0)
    assert versions(setting.store) == {1: 0, 2: 0, 3: 1}
    assert found(setting.store.vectors().where("idf_version = 1")) == setting.batch_job(LATER, 1)
    before = setting.store.vectors()
    assert setting.store.refresh(setting.idf) == 1
    assert versions(setting.store) == {1: 1, 2: 1, 3: 1}
    assert found(setting.store.vectors()) == setting.batch_job(FIRST + LATER, 1)
    assert before.count() == 3  # a reader that began before the refresh still has its folders
    setting.store.refresh(setting.idf)
    assert found(setting.store.vectors()) == setting.batch_job(FIRST + LATER, 1)
    assert len(os.listdir(f"{setting.made}/data")) == 2


def test_counts_wait_for_the_first_table(setting):
    setting.arrive(FIRST)
    setting.weigh()
    assert setting.store.vectors().count() == 0 and setting.store.bags().count() == 2
    with pytest.raises(FileNotFoundError):
        setting.store.refresh(setting.idf)
    setting.publish()
    setting.store.refresh(setting.idf)
    assert found(setting.store.vectors()) == setting.batch_job(FIRST, 0)


def test_a_batch_run_again_counts_once(setting, monkeypatch):
    setting.arrive(FIRST)
    setting.publish()
    append = CommitLog.append
    crashes = [True]

    def append_and_crash(self, entry):
        made = append(self, entry)
        if entry.get("batch") == 1 and crashes:
            crashes.pop()
            raise OSError("lost")
        return made

    monkeypatch.setattr(CommitLog, "append", append_and_crash)
    with pytest.raises(StreamingQueryException):
        setting.weigh()
    setting.store.refresh(setting.idf)  # takes the batch that the stream does not know to be complete
    assert found(setting.store.vectors()) == setting.batch_job(FIRST, 0)
    setting.weigh()
    assert found(setting.store.vectors()) == setting.batch_job(FIRST, 0)
    assert setting.store.bags().count() == 2
    setting.store.refresh(setting.idf)
    assert found(setting.store.vectors()) == setting.batch_job(FIRST, 0)


def test_odd_rows(spark, setting):
    setting.arrive(FIRST)
    setting.publish()
    odd = [(None, "red"), (7, None), (8, "unheard"), (9, "red"), (9, "red"), (10, "red " * 50_000)]
    setting.store.add(spark.createDataFrame(odd, SCHEMA), 0, setting.idf)
    setting.store.add(spark.createDataFrame([(9, "blue")], SCHEMA), 1, setting.idf)
    setting.store.add(spark.createDataFrame([], SCHEMA), 2, setting.idf)
    rows = sorted((r.doc_id, r.batch, len(r.vec)) for r in setting.store.vectors().collect())
    assert rows == [(9, 0, 1), (9, 1, 1), (10, 0, 1)]
    setting.store.refresh(setting.idf)
    assert rows == sorted((r.doc_id, r.batch, len(r.vec)) for r in setting.store.vectors().collect())


def test_a_published_table_holds_complete_batches_only(spark, setting):
    setting.arrive(FIRST)
    setting.publish()
    half = spark.createDataFrame([("half", 1)], "term string, df bigint")
    half.write.parquet(f"{setting.log}/terms/batch=2")  # a batch that is being written
    av.publish_idf(spark, setting.log, setting.idf, buckets=50)
    assert {r.term for r in setting.idf.read().collect()} == {"red", "green", "blue"}
