"""The running document frequency against the batch result."""

from __future__ import annotations

import os
import random

from pyspark.errors import StreamingQueryException

from tomeworks.operators.terms import term_bags
from tomeworks.operators.vocabulary import document_frequency
from tomeworks.plans import catalog
from tomeworks.sources.key_index import KeyIndex, Layout
from tomeworks.streaming import running_df


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.mode("append").parquet(folder)


def batch_result(spark, rows):
    bags = term_bags(spark.createDataFrame(rows, "doc_id bigint, text string"))
    return {r["term"]: r["df"] for r in document_frequency(bags).collect()}


def test_log_grows_with_arrivals(spark, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    first = [(1, "red green"), (2, "red red"), (3, "")]
    later = [(4, "green blue"), (5, "violet")]
    arrive(spark, source, first[:2])
    arrive(spark, source, first[2:])

    def run():
        arriving = running_df.document_stream(spark, source, files_per_batch=1)
        running_df.start_frequency_log(arriving, log, state).awaitTermination()
        frequencies, documents = running_df.snapshot(spark, log)
        return {r["term"]: r["df"] for r in frequencies.collect()}, documents.first()["n_docs"]

    assert run() == (batch_result(spark, first), 2)
    arrive(spark, source, later)
    assert run() == (batch_result(spark, first + later), 4)
    assert run() == (batch_result(spark, first + later), 4)


def test_snapshots_read_one_state_and_the_batches_after_it(spark, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    rows = [(i, f"red w{i} word{i % 3}") for i in range(7)]
    for row in rows:
        arrive(spark, source, [row])
    arrive(spark, source, rows[:1])  # a replay of the first document
    arriving = running_df.document_stream(spark, source, files_per_batch=1)
    running_df.start_frequency_log(arriving, log, state, merge_every=3, drop_replays=True).awaitTermination()
    frequencies, documents = running_df.snapshot(spark, log)
    assert {r["term"]: r["df"] for r in frequencies.collect()} == batch_result(spark, rows)
    assert documents.first()["n_docs"] == 7
    plan = frequencies._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and " > 5)]" in plan
    states = {f.split("/merged/")[1].split("/")[0] for f in frequencies.inputFiles() if "/merged/" in f}
    assert states == {"upto=5"}


def test_stateful_counts_ignore_replays(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(1, "red green"), (2, "red red")]
    arrive(spark, source, rows)
    arrive(spark, source, rows[:1])
    counts = running_df.running_frequency(running_df.document_stream(spark, source), drop_replays=True)
    query = (
        counts.writeStream.outputMode("complete").format("memory").queryName("running")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert {r["term"]: r["df"] for r in spark.table("running").collect()} == batch_result(spark, rows)


def test_a_long_log_stays_small_and_exact_through_replays_and_crashes(spark, tmp_path, monkeypatch):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    draw = random.Random(9)
    rows = []
    for n in range(15):
        ids = [n * 3 + k for k in range(3)] + draw.sample(range(n * 3 + 1), min(2, n))
        some = [(i, f"red w{i % 7} word{i % 3}") for i in ids]
        rows += some
        arrive(spark, source, some)
    held, crashes = [], {6, 11}  # before a merge is complete, and between the ids and the end of a batch
    merge, add = running_df.merge, KeyIndex.add

    def merge_or_crash(spark, folder, upto):
        held.append((len(os.listdir(f"{log}/terms")), len(KeyIndex(spark, f"{log}/ids")._batches())))
        if upto + 1 in crashes or upto in crashes:
            crashes.discard(upto)
            crashes.discard(upto + 1)
            raise OSError("lost")
        merge(spark, folder, upto)

    def add_or_crash(self, keys, name):
        add(self, keys, name)
        if name == "batch-11" and 11 in crashes:
            crashes.discard(11)
            raise OSError("lost")

    monkeypatch.setattr(running_df, "merge", merge_or_crash)
    monkeypatch.setattr(KeyIndex, "add", add_or_crash)
    failures = 0
    for _ in range(4):
        arriving = running_df.document_stream(spark, source, files_per_batch=1)
        layout = Layout(buckets=4, words=16)
        query = running_df.start_frequency_log(arriving, log, state, merge_every=3, drop_replays=True, layout=layout)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            failures += 1
    assert failures == 2
    frequencies, documents = running_df.snapshot(spark, log)
    distinct = sorted(dict(rows).items())
    assert {r["term"]: r["df"] for r in frequencies.collect()} == batch_result(spark, distinct)
    assert documents.first()["n_docs"] == len(distinct)
    # whatever the number of batches: no more than two merges' worth of folders, and of batches of ids
    assert max(n for n, _ in held) <= 7 and max(n for _, n in held) <= 4
    assert len(os.listdir(f"{log}/merged")) <= 2 and len(os.listdir(f"{log}/ids/commits")) < 12


def test_a_batch_of_arrivals_is_read_by_all_tasks(spark, folder):
    """The same four batches, each in as many files as tasks run at once."""
    path = catalog._document_files(spark, folder)
    files = spark.read.parquet(path).inputFiles()
    per_batch = catalog._files_per_batch(spark)
    assert per_batch == spark.sparkContext.defaultParallelism and 1 < len(files) <= 4 * per_batch
    assert len(files) > 3 * per_batch
    written = spark.read.parquet(path)
    assert sorted(written.collect()) == sorted(catalog.inputs.corpus(spark, folder).collect())
