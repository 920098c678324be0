from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import partial
from types import SimpleNamespace

import numpy as np
import pytest

from tests.llm.helpers import ODD, folder_of, make_docs
from tomeworks.llm import attention_lm as lm

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)) + [None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base(docs):
    counts = Counter(t for i, text in docs if not is_held_out(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for i, text in docs:
        own = tokens(text)
        logs = math.fsum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        yield i, is_held_out(i), len(own), sum(counts[t] > 0 for t in own), total, logs


def compare(rows, docs):
    order = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=order)
    want = sorted(base(docs), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


@pytest.fixture(scope="module")
def scored(spark, folder):
    return lm.op9_attention_lm(spark, folder).collect()


def test_query(spark, folder, scored):
    compare(scored, [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])


def test_training_helps_on_unseen_documents(spark, folder, scored, untrained):
    before = {r.doc_id: r.score for r in untrained}
    unseen = [r for r in scored if r.held_out]
    assert sum(r.score for r in unseen) > 0.97 * sum(before[r.doc_id] for r in unseen)
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


@pytest.fixture(scope="module")
def untrained(spark, folder):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm, "HOT", 5)  # so that nearly all counts come from the join
        patch.setattr(lm, "ROUNDS", 0)
        return lm.op9_attention_lm(spark, folder).collect()


def test_rare_words_by_join(spark, folder, untrained):
    compare(untrained, [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])


def test_gradients():
    rng = np.random.default_rng(1)
    w = {k: rng.standard_normal(s) * 0.3 for k, s in lm._SHAPES.items()}
    inputs = rng.integers(0, 5, (3, lm.CONTEXT))
    classes = rng.integers(0, lm.CLASSES, (3, lm.CONTEXT))
    scored = rng.random((3, lm.CONTEXT)) < 0.7
    _, g = lm.gradients(w, inputs, classes, scored)
    for name in lm._SHAPES:
        place = tuple(rng.integers(0, min(5, n)) for n in w[name].shape)
        losses = []
        for step in (1e-4, -1e-4):
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][place] += step
            losses.append(lm.gradients(moved, inputs, classes, scored)[0])
        assert g[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=1e-3, abs=1e-6), name


def small_model(n_ids=60):
    rng = np.random.default_rng(2)
    classes = lm.Classes(rng.integers(0, 50, n_ids).astype(float))
    return lm.first_weights(), classes


def test_probabilities_add_up_to_one():
    """P(end first) + sum of P(id, end) + ... : texts of up to two ids have a total below one, and most of it when ends are likely."""
    w, classes = small_model()
    w["b"][classes.of[59]] += 8  # the end is nearly certain
    scorer = lm.Scorer(w, classes)
    texts = [[]] + [[i] for i in range(59)] + [[i, j] for i in range(59) for j in range(59)]
    total = (10 ** scorer.log10([np.array(t, np.int32) for t in texts])).sum()
    share = np.bincount(classes.of, np.exp(classes.log_share), lm.CLASSES)
    assert share[share > 0] == pytest.approx(1.0)
    own = np.exp(classes.log_share[59])  # of the end's class
    assert 1 - (1 - 0.9 * own) ** 3 < total < 1 + 1e-6


@pytest.mark.parametrize("n", [0, 1, 11, 12, 15, 16, 17, 28, 29, 100])
def test_each_token_once_and_like_the_plain_model(n):
    w, classes = small_model()
    ids = np.random.default_rng(n).integers(0, 59, n).astype(np.int32)
    seen = []
    total = 0.0
    for text, inputs, targets, scored in lm.batches_of([ids], classes):
        for b in range(len(inputs)):
            x = w["E"][inputs[b]] + w["P"]
            for t in np.flatnonzero(scored[b]):
                q = x[t] @ w["Q"]
                s = np.array([q @ (x[j] @ w["K"]) for j in range(t + 1)]) / math.sqrt(lm.WIDTH)
                a = np.exp(s) / np.exp(s).sum()
                o = sum(a[j] * (x[j] @ w["V"]) for j in range(t + 1)) @ w["O"] + w["E"][inputs[b, t]]
                logits = o @ w["U"] + w["b"]
                target = targets[b, t]
                seen.append(target)
                total += logits[classes.of[target]] - np.log(np.exp(logits).sum()) + classes.log_share[target]
    assert sorted(seen) == sorted([*ids.tolist(), 59])
    assert lm.Scorer(w, classes).log10([ids])[0] == pytest.approx(total / math.log(10), rel=1e-4)


def test_odd_rows(spark, tmp_path):
    docs = make_docs(spark, ODD)
    rows = lm.op9_attention_lm(spark, folder_of(tmp_path / "odd", spark, docs)).collect()
    compare(rows, [(r[0], r[1]) for r in ODD])
    assert lm.op9_attention_lm(spark, folder_of(tmp_path / "none", spark, docs.limit(0))).count() == 0


def test_every_training_document_reaches_the_weights(spark, monkeypatch):
    """A word of one document moves its embedding, and the groups and partial sums do not depend on the partitions."""
    monkeypatch.setattr(lm, "GROUP", 40)  # 8 groups, 2 partial sums
    monkeypatch.setattr(lm, "REPEATED", 0)  # each document in one round only
    first = lm.first_weights()
    n = 300
    counts = np.ones(n + 1)
    classes = lm.Classes(counts)
    docs = make_docs(spark, [f"{i} {i} {i}" for i in range(n)]).select(lm.doc_key().alias("key"), "text")
    encoder = spark.sparkContext.broadcast(SimpleNamespace(encode=partial(np.fromstring, dtype=np.int32, sep=" ")))
    after = lm.fit(docs.repartition(3), classes, encoder)
    moved = np.abs(after["E"] - first["E"]).max(axis=1) > 0
    assert moved[classes.input[:n]].all()
    again = lm.fit(docs.repartition(7), classes, encoder)
    assert all((after[k] == again[k]).all() for k in after)


def test_every_group_trains_in_a_task_of_its_own(spark):
    rows = spark.range(600).selectExpr("id % 6 as group", "id as key")
    by_task = lambda df: [{r.group for r in rows} for rows in df.rdd.glom().collect()]
    assert max(map(len, by_task(rows.repartition(6, "group")))) > 1
    assert sorted(map(tuple, by_task(lm._apart(rows, 6, "group")))) == [(i,) for i in range(6)]
