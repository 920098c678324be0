from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_line_dedup, test_near_dup, test_quality_rules
from tests.llm.helpers import ODD, folder_of, make_docs
from tests.llm.test_decontaminate import plain_template
from tomeworks.llm import bpe, quality_rules


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = corpus_pipeline.documents(spark, folder)
    made = [docs]
    for _, function in corpus_pipeline.STAGES:
        made.append(corpus_pipeline.stage(function(spark, made[-1], folder), "test"))
    return made


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(stages):
    before, after = stages[0], stages[1]
    kept = {r.doc_id for r in quality_rules.judge(before).where("kept").collect()}
    assert set(ids(after)) == kept
    for r in before.collect():
        counts = test_quality_rules.plain_counts(r.text)
        if counts[0] < 10 or 100 * counts[5] > 20 * counts[0]:
            assert r.doc_id not in kept


def test_lines(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    left = dict(zip((i for i, _ in before), test_line_dedup.brute(before)))
    expected = {i: t for i, t in left.items() if t.split() or t == dict(before)[i]}
    assert {r.doc_id: r.text for r in stages[2].collect()} == expected
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_near_duplicate_stays(stages):
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    component, sizes = test_near_dup.brute(texts, 5)
    assert ids(stages[3]) == sorted(i for i in texts if component[i] == i or not sizes[i])


def test_benchmark(spark, stages, folder):
    items = [" ".join(plain_template(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in stages[3].collect() if any(f" {i} " in f" {' '.join(plain_template(r.text))} " for i in items)}
    assert set(ids(stages[3])) - set(ids(stages[4])) == whole


def test_tokens(stages):
    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)))
    rows = stages[5].collect()
    assert sorted(r.doc_id for r in rows) == ids(stages[4])
    assert all(encoder.decode(bpe.np.array(r.ids)).decode() == r.text and r.n_tokens == len(r.ids) for r in rows)


def test_run(spark, folder, stages):
    digest = lambda df: sorted((r.doc_id, hashlib.md5(r.text.encode()).hexdigest(), tuple(r.ids)) for r in df.collect())
    assert digest(corpus_pipeline.run(spark, folder)) == digest(stages[5])


def test_odd_and_empty_tables(spark, tmp_path):
    bench = spark.createDataFrame([(1, None), (2, "some item of the benchmark")], "item_id bigint, text string")
    extra = ODD + [(50 + i, f"number {i} is a text of quite enough words to be kept by the base rule", "en", "a", 1) for i in range(3)]
    for name, docs in (("odd", make_docs(spark, extra)), ("empty", make_docs(spark, ODD).limit(0))):
        docs = docs.withColumn("ids", F.lit("clash")).withColumn("kept", F.lit("clash"))
        folder = folder_of(tmp_path / name, spark, docs, benchmark=bench)
        rows = corpus_pipeline.run(spark, folder).collect()
        assert [r.doc_id for r in rows] == ([] if name == "empty" else [50, 51, 52]) or sorted(r.doc_id for r in rows) == [50, 51, 52]
