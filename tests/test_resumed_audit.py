"""Audits in runs, the index of ids behind them, and the commit log."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from tomeworks.plans import resumed_audit
from tomeworks.plans.corpus_audit import audit
from tomeworks.plans.resumed_audit import AuditLog
from tomeworks.sources.commits import CommitLog
from tomeworks.sources.key_index import KeyIndex, Layout

SMALL = Layout(buckets=4, words=8)


def file_rows(n, start, draw):
    """Ids repeat within and across runs; some files have none."""
    ids = [draw.choice([None, *range(40)]) for _ in range(n)]
    text = lambda i: "no id" if i is None else f"Title [EBook #{i}]\nbody"
    return [(start + k, f"f{start + k}.txt", text(i)) for k, i in enumerate(ids)]


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame([(str(i),) for i in range(40) if i % 3] + [("1",)], "doc_key string")


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, file string, text string")


def outcome(df):
    return sorted((r.file, r.doc_key, r.status, r.fold) for r in df.collect())


def test_runs_equal_one_audit_of_all_files(spark, metadata, tmp_path):
    draw = random.Random(1)
    parts = [file_rows(n, s, draw) for n, s in ((30, 0), (0, 30), (25, 30), (40, 55))]
    log = AuditLog(spark, f"file:{tmp_path}/log", SMALL)
    for i, rows in enumerate(parts):
        log.audit(frame(spark, rows), metadata, f"r{i}")
        if i == 2:
            log.compact()
    whole = audit(frame(spark, sum(parts, [])), metadata)
    assert outcome(log.statuses()) == outcome(whole)
    assert log.runs() == ["r0", "r1", "r2", "r3"]
    statuses = {r.status for r in log.statuses("r3").collect()}
    assert statuses >= {"DUPLICATE", "MISSING_ID", "NO_META"}


def test_earlier_texts_and_untouched_buckets_are_not_read(spark, metadata, tmp_path):
    draw = random.Random(2)
    first, second = file_rows(60, 0, draw), [(60, "again.txt", "x [EBook #1]\n"), (61, "new.txt", "x [EBook #38]\n")]
    path = f"{tmp_path}/first.parquet"
    frame(spark, [r for r in first if "#38]" not in r[2]]).write.parquet(path)
    log = AuditLog(spark, f"file:{tmp_path}/log", Layout(buckets=16, words=64))
    log.audit(spark.read.parquet(path), metadata, "a")
    for name in glob.glob(f"{path}/*.parquet"):
        with open(name, "wb") as file:  # the earlier texts are gone
            file.write(b"")
    log.audit(frame(spark, second), metadata, "b")
    assert [r[1:] for r in outcome(log.statuses("b"))] == [("1", "DUPLICATE", None), ("38", "GOOD", log_good(log) % 10)]

    keys = spark.createDataFrame([("1",)], "doc_key string")
    found = log.index.seen(keys)
    read = [f for f in found.inputFiles() if "/keys/" in f]
    everything = log.index._read(log.index._batches(), "keys", "key string, bucket int").inputFiles()
    assert [r.key for r in found.collect()] == ["1"]
    assert len({f.split("bucket=")[1].split("/")[0] for f in everything}) > 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    assert read


def log_good(log):
    return log.log.entries()[0]["good"]


def test_a_failed_run_is_repeated_and_a_committed_one_is_not(spark, metadata, tmp_path, monkeypatch):
    draw = random.Random(3)
    first, second = file_rows(30, 0, draw), file_rows(30, 30, draw)
    log = AuditLog(spark, f"file:{tmp_path}/log", SMALL)
    log.audit(frame(spark, first), metadata, "a")

    def broken(self, entry):
        if "run" in entry:
            raise OSError("lost")
        return append(self, entry)

    append = CommitLog.append
    monkeypatch.setattr(CommitLog, "append", broken)
    with pytest.raises(OSError):
        log.audit(frame(spark, second), metadata, "b")
    monkeypatch.undo()
    assert log.runs() == ["a"] and "b" in log.index.names()
    log.compact()  # waits for the run
    assert len(log.index._batches()) == 2
    log.audit(frame(spark, second), metadata, "b")
    again = log.audit(frame(spark, first), metadata, "b")
    assert outcome(log.statuses()) == outcome(audit(frame(spark, first + second), metadata))
    assert outcome(again) == outcome(log.statuses("b"))


@pytest.mark.parametrize("layout", [Layout(1, 1), Layout(5, 3), Layout(16, 512)])
def test_index_is_exact_whatever_its_filter_lets_through(spark, tmp_path, layout):
    index = KeyIndex(spark, f"file:{tmp_path}/{layout.buckets}", layout)
    as_keys = lambda numbers: spark.createDataFrame([(f"k{i}",) for i in numbers], "k string")
    assert index.seen(as_keys(range(3))).count() == 0
    index.add(as_keys(range(0, 200)), "a")
    index.add(as_keys(range(200, 300)), "b")
    index.add(as_keys(range(900, 950)), "b")  # the name is taken: nothing happens
    asked = as_keys(range(150, 1000, 7))
    expected = {f"k{i}" for i in range(150, 1000, 7) if i < 300}
    assert {r.key for r in index.seen(asked).collect()} == expected
    index.compact()
    assert {r.key for r in index.seen(asked).collect()} == expected and index.names() == {"a", "b"}
    assert KeyIndex(spark, index.folder).layout == layout
    if layout.words == 512:  # 16 * 512 words for 300 keys: nearly all others are excluded
        assert index.candidates(asked).count() <= len(expected) + 3


def test_commits_are_numbered_and_only_one_writer_wins(spark, tmp_path):
    log = CommitLog(spark, f"file:{tmp_path}/log")
    assert log.entries() == [] and log.last() is None
    log.append({"x": "é"})
    assert log.append({"x": 2})["number"] == 1
    assert [e["x"] for e in log.entries()] == ["é", 2]
    log.last = lambda: {"number": 0}  # a writer that has not seen the second entry
    with pytest.raises(RuntimeError, match="another writer"):
        log.append({"x": 3})
    assert resumed_audit.AuditLog(spark, f"file:{tmp_path}/none").statuses().count() == 0
