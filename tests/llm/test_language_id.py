from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, folder_of, make_docs
from tomeworks.llm import language_id as li

EN = "the weather was nice and the children went outside to play with their friends in the garden"
DE = "das wetter war schön und die kinder gingen nach draußen um mit ihren freunden im garten zu spielen"
RU = "погода была хорошая и дети вышли на улицу играть со своими друзьями в саду"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 5)]
    return li.learn(make_docs(spark, rows + [(99, None, "xx", "s", 0), (98, "a b", None, "s", 0)]))


def test_mixed_texts(spark, model):
    assert model.langs == ["de", "en", "ru"]
    text = f"{EN}. {DE}! {RU}"
    row = li.predict(make_docs(spark, [text]), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "ru"]
    assert [text[s.start : s.stop] for s in row.spans] == [EN, DE, RU]
    assert row.lang_pred == "de" and 0.3 < row.score < 0.5


def plain_search(model, ids):
    """All labellings, for a few words."""
    best = None
    for path in itertools.product(range(len(model.langs)), repeat=len(ids)):
        value = sum(model.scores[i, s] for i, s in zip(ids, path)) - model.switch * sum(a != b for a, b in zip(path, path[1:]))
        if best is None or value > best[0] + 1e-4:
            best = (value, path)
    return best[0]


def test_the_search_is_exact(model):
    rng = np.random.default_rng(3)
    words = (EN + " " + DE + " " + RU).split()
    texts = [" ".join(rng.choice(words, rng.integers(1, 7))) for _ in range(40)] + ["", "12 34"]
    for text, labels, ids in zip(texts, model.labels(texts), model.words_of(texts)):
        assert len(labels) == len(ids)
        if len(ids):
            value = sum(model.scores[i, s] for i, s in zip(ids, labels)) - model.switch * np.sum(labels[1:] != labels[:-1])
            assert value == pytest.approx(plain_search(model, ids), abs=1e-3)


def test_scripts_narrow_the_candidates(model):
    scores = model.word_scores(["дети", "children", "日本語"])
    ru = model.langs.index("ru")
    assert scores[0].argmax() == ru and sorted(scores[0])[1] < -1000
    assert scores[1, ru] < -1000
    assert (scores[2] > -1000).all()


def test_odd_rows(spark, model):
    docs = make_docs(spark, ODD + [(20, "123 456 !!", "en", "a", 1), (21, "İx ß", None, None, 1)]).withColumn("score", F.lit("clash"))
    rows = li.predict(docs, model).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.score <= 1
    assert li.predict(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, tmp_path):
    docs = make_docs(spark, [(1, EN, None, None, 1), (2, None, "en", None, 1), (None, DE, None, "x", 1)])
    rows = li.op7_language_id(spark, folder_of(tmp_path / "t", spark, docs)).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)} and len(rows) == 3


def test_sample_is_bounded(spark):
    docs = make_docs(spark, [f"text {i}" for i in range(400)])
    assert 20 < li.sampled(docs, 50).count() < 90
    assert li.sampled(docs, 500).count() == 400


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = li.op7_language_id(spark, folder).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in tested) >= 0.97 * len(tested) > 100
