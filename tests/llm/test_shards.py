from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import shards


def check(rows, n):
    for s in range(n):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_query(spark, folder):
    rows = shards.op3_histogram_shards(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    largest = max(len(t.encode()) for t in texts.values()) + 1
    assert max(sizes) - min(sizes) <= 2 * largest
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)
    assert all(zlib.crc32(texts[r.doc_id].encode()) == r.text_crc32 for r in rows)


def test_a_hot_text_is_split_evenly(spark):
    docs = make_docs(spark, ["same text"] * 500 + [f"text {i}" for i in range(700)])
    rows = shards.shard(docs, 8).collect()
    check(rows, 8)
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 10
    # the shards are ranges of one order: copies are neighbours
    held = sorted({r.shard for r in rows if r.text == "same text"})
    assert held == list(range(held[0], held[-1] + 1))


@pytest.mark.parametrize("n", [1, 3, 8])
def test_odd_rows(spark, n):
    rows = shards.shard(make_docs(spark, ODD).withColumn("slot", F.lit("clash")), n).collect()
    assert len(rows) == len(ODD)
    check(rows, n)


def test_empty_and_few(spark):
    assert shards.shard(make_docs(spark, ["a"]).limit(0)).count() == 0
    check(shards.shard(make_docs(spark, ["a", "b", "c"])).collect(), 8)
    check(shards.shard(make_docs(spark, [(7, "a", "x", "y", 1)] * 40)).collect(), 8)


def test_slabs(spark, monkeypatch):
    monkeypatch.setattr(shards, "SLAB_ROWS", 10)
    check(shards.shard(make_docs(spark, [f"text {i}" for i in range(300)]), 4).collect(), 4)


def test_write(spark, tmp_path):
    docs = make_docs(spark, [f"text {i}" for i in range(50)])
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4
