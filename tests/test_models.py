"""Naive Bayes against spark.ml, trees and regressions on toy and real vectors."""

from __future__ import annotations

import struct

import pytest
import xxhash
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tomeworks.operators.metrics import accuracy, binary_metrics, confusion
from tomeworks.operators.naive_bayes import fit_naive_bayes, predict_naive_bayes
from tomeworks.operators.trees import predictions
from tomeworks.operators.vectors import (
    bag_vectors,
    bucket_sums,
    hash_terms,
    sparse_vectors,
    tfidf_vectors,
    weighted_vectors,
    with_ml_vectors,
)
from tomeworks.operators.weights import tfidf
from tomeworks.plans import catalog, experiments, inputs, oracles
from tomeworks.plans.features import Features, Settings

# Toy labelled vectors (label, [x, y]) per split.
TOY = {
    "train": [(0.0, [0.0, 3.4]), (1.0, [1.0, 4.3]), (1.0, [2.0, 1.2])],
    "test": [(0.0, [0.0, 3.4]), (0.0, [3.0, 1.3]), (1.0, [2.5, 1.2])],
    "validate": [(0.0, [2.0, 5.4]), (1.0, [1.0, 4.3]), (0.0, [2.5, 1.2])],
}


@pytest.fixture(scope="module")
def toy(spark):
    rows, doc_id = [], 0
    for split, members in TOY.items():
        for label, values in members:
            doc_id += 1
            vec = [(b, w) for b, w in enumerate(values) if w]
            rows.append((doc_id, split, [label, 1.0 - label, 1.0], vec))
    return spark.createDataFrame(
        rows, "doc_id bigint, split string, labels array<double>, vec array<struct<bucket:int,w:double>>"
    )


@pytest.fixture(scope="module")
def real(spark, folder):
    features = Features(inputs.corpus(spark, folder), Settings(buckets=500))
    return experiments.labelled_examples(features, inputs.metadata(spark, folder), k=6)


def test_ml_vectors(toy):
    row = with_ml_vectors(toy, buckets=4).where("doc_id = 1").first()
    assert row["features"] == Vectors.sparse(4, {1: 3.4})


def ml_bayes(vectors, position):
    data = vectors.select("split", F.get("labels", F.lit(position)).alias("label"), "features")
    model = experiments.ml_naive_bayes().fit(data.where("split = 'train'"))
    wide = vectors.select("doc_id", "split", F.get("labels", F.lit(position)).alias("label"), "features")
    return model, {r["doc_id"]: r["prediction"] for r in model.transform(wide).collect()}


def test_naive_bayes_equals_spark_ml_on_toy_vectors(toy):
    names = ["a", "not a", "all"]
    model = fit_naive_bayes(toy, names, buckets=2)
    vectors = with_ml_vectors(toy, buckets=2)
    theta = {(r["subject"], r["label"], r["bucket"]): r["theta"] for r in model.table().collect()}
    pi = {(r["subject"], r["label"]): r["pi"] for r in model.priors().collect()}
    ours = {(r["subject"], r["doc_id"]): r["prediction"] for r in predict_naive_bayes(model, toy).collect()}
    for i, name in enumerate(names[:2]):
        ml, predicted = ml_bayes(vectors, i)
        for label in (0, 1):
            assert pi[name, float(label)] == pytest.approx(ml.pi[label], abs=1e-9)
            for b in range(2):
                assert theta[name, float(label), b] == pytest.approx(ml.theta.toArray()[label, b], abs=1e-9)
        assert {d: ours[name, d] for d in predicted} == predicted
    # a class without training documents is left out
    assert ("all", 0.0) not in pi
    assert all(p == 1.0 for (name, _), p in ours.items() if name == "all")


def test_naive_bayes_equals_spark_ml_on_documents(real):
    assert (real.buckets, real.weighting, real.log_idf) == (500, "tfidf", True)
    predictions = experiments.naive_bayes_predictions(real).collect()
    vectors = with_ml_vectors(real.rows, 500)
    for i, name in enumerate(real.names):
        _, want = ml_bayes(vectors, i)
        assert {r["doc_id"]: r["prediction"] for r in predictions if r["subject"] == name} == want


def test_tree_experiment_counts_what_the_trees_predict(real):
    table = {(r.subject, r.setting): r for r in experiments.decision_tree_experiment(real, depths=(1, 3)).collect()}
    found = predictions(experiments.grown_trees(real, 3), real.rows, [1, 3]).collect()
    for (subject, setting), row in table.items():
        for split in experiments.SPLITS:
            mine = [r for r in found if (r.subject, str(r.depth), r.split) == (subject, str(setting), split)]
            assert row[f"{split}_docs"] == len(mine)
            hits = sum(r.label == r.prediction for r in mine)
            assert row[f"{split}_accuracy"] == pytest.approx(hits / len(mine))
        assert row.train_accuracy >= row.train_majority - 1e-9


def test_fits_take_a_bounded_sample_and_score_everything(real):
    vectors = experiments.ml_vectors(real, max_training_rows=40)
    n_train, n_fit = (vectors.where(c).count() for c in ("split = 'train'", "in_fit"))
    assert 0 < n_fit < n_train and vectors.where("in_fit and split <> 'train'").count() == 0
    rows = experiments.logistic_regression_experiment(real.first(1), max_training_rows=40).collect()
    assert rows[0]["train_docs"] == n_train
    assert vectors.count() == real.rows.count()


def test_fits_take_all_training_rows(real, monkeypatch):
    """However many there are; the number of rows decides nothing."""
    n_train, n_all = real.rows.where("split = 'train'").count(), real.rows.count()
    monkeypatch.setattr(type(real.rows), "count", lambda rows: 1 << 40)
    vectors = experiments.ml_vectors(real).select("split", "in_fit").collect()
    assert len(vectors) == n_all and sum(r.in_fit for r in vectors) == n_train
    assert all(r.in_fit == (r.split == "train") for r in vectors)


def test_settings_travel_with_the_examples(real):
    row = experiments.naive_bayes_experiment(real).first()
    assert (row["buckets"], row["log_used"]) == (500, True)


def test_bag_vectors_are_the_summed_buckets_without_an_exchange(spark, folder):
    features = Features(inputs.corpus(spark, folder), Settings(buckets=300))
    made = features.vectors("tf")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    summed = bucket_sums(hash_terms(features.tf, 300), "tf")
    both = made.select("doc_id", F.inline("vec")).join(summed.withColumnRenamed("w", "v"), ["doc_id", "bucket"], "full")
    assert both.where("w is null or v is null or abs(w - v) > 1e-9").count() == 0


def test_bayes_scoring_reads_the_examples_once(real):
    plan = experiments.naive_bayes_predictions(real)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [doc_id") == 1


def test_decision_tree_experiment(real):
    examples, names = real.rows, real.names
    rows = experiments.decision_tree_experiment(real).collect()
    assert {(r["subject"], r["setting"]) for r in rows} == {(n, d) for n in names for d in "234"}
    majority = examples.where("split = 'train'").select(
        *[F.avg(F.get("labels", F.lit(i))).alias(str(i)) for i in range(len(names))]
    ).first()
    for r in rows:
        share = majority[str(names.index(r["subject"]))]
        assert r["train_majority"] == pytest.approx(max(share, 1 - share))
        assert r["train_accuracy"] >= max(share, 1 - share) - 1e-9
        assert r["train_docs"] + r["test_docs"] + r["validate_docs"] == examples.count()


def test_logistic_regression_experiment(real, toy):
    names = real.names
    rows = experiments.logistic_regression_experiment(real.first(2), reg_params=(0.01, 0.3)).collect()
    assert len(rows) == 4
    used = {(r["subject"], r["setting"]): r["n_coefficients"] for r in rows}
    assert all(used[n, "0.01"] > 0 and used[n, "0.01"] >= used[n, "0.3"] for n in names[:2])
    assert all(0.5 <= r["train_accuracy"] <= 1.0 for r in rows)
    by = {(r["subject"], r["setting"]): r["train_accuracy"] for r in rows}
    assert by[names[0], "0.01"] >= by[names[0], "0.3"] - 1e-9
    rows = experiments.decision_tree_experiment(experiments.Examples(toy, ["a"], 2), depths=(2,)).collect()
    assert rows[0]["train_accuracy"] == 1.0 and rows[0]["test_accuracy"] == pytest.approx(2 / 3)


def test_metrics(spark):
    cells = [("s", 1.0, 1.0, 3), ("s", 0.0, 1.0, 1), ("s", 0.0, 0.0, 4), ("s", 1.0, 0.0, 2), ("t", 0.0, 0.0, 5)]
    rows = [(s, y, p) for s, y, p, n in cells for _ in range(n)]
    predictions = spark.createDataFrame(rows, "subject string, label double, prediction double")
    counts = confusion(predictions, "subject")
    assert sorted(map(tuple, counts.collect())) == sorted(cells)
    got = {r["subject"]: r for r in binary_metrics(counts, "subject").collect()}
    s, t = got["s"], got["t"]
    assert (s["accuracy"], s["error_rate"], s["recall"], s["precision"], s["specificity"]) == (0.7, 0.3, 0.6, 0.75, 0.8)
    assert (s["positives"], s["negatives"]) == (5, 5)
    assert t["accuracy"] == 1.0 and t["recall"] is None and t["precision"] is None and t["specificity"] == 1.0
    assert {r["subject"]: r["accuracy"] for r in accuracy(predictions, "subject").collect()} == {"s": 0.7, "t": 1.0}


def test_vectors_keep_their_weight(real):
    examples = real.rows
    dense = with_ml_vectors(examples, 500).select("doc_id", vector_to_array("features").alias("a"))
    both = dense.join(examples.select("doc_id", "vec"), "doc_id").select(
        F.aggregate("a", F.lit(0.0), lambda x, y: x + y).alias("d"),
        F.aggregate("vec", F.lit(0.0), lambda x, e: x + e["w"]).alias("s"),
    )
    assert both.where("abs(d - s) > 1e-9").count() == 0


def signed_xxh64(data: bytes) -> int:
    value = xxhash.xxh64(data, seed=42).intdigest()
    return value - (1 << 64) if value >> 63 else value


def test_fast_buckets_and_hashed_folds_equal_the_hash_of_another_library(spark, folder):
    fold = {r.doc_id: r.fold for r in catalog.w1_hashed_folds(spark, folder).collect()}
    assert len(fold) == 200
    assert fold == {i: signed_xxh64(struct.pack("<q", i)) % 10 for i in fold}
    weights = {}
    for r in Features(inputs.corpus(spark, folder)).tfidf.collect():
        key = (r.doc_id, signed_xxh64(r.term.encode()) % 10_000)
        weights[key] = weights.get(key, 0) + r.tfidf
    got = {(r.doc_id, r.bucket): r.w for r in catalog.m5_hash_vectors_fast(spark, folder).collect()}
    assert got == pytest.approx(weights, abs=2e-6)


FIT_REPORTS = [
    "m10_decision_tree", "m10_embedding_trees", "m11_decision_tree_sweep", "m11_decision_tree_tf_sweep",
    "m12_logistic_regression", "m12_embedding_regressions", "m13_logistic_regression_sweep",
    "m13_logistic_regression_tf_sweep",
]


def test_fit_reports_say_whether_training_reaches_the_majority(spark):
    rows = [(name, "s", 10, 0, 0, 3, 0.7, accuracy) for name, accuracy in (("a", 0.7), ("b", 0.66), ("c", 0.6))]
    columns = "subject string, setting string, train_docs long, test_docs long, validate_docs long, train_positives long"
    table = spark.createDataFrame(rows, f"{columns}, train_majority double, train_accuracy double")
    reached = {r["subject"]: r["reaches_majority"] for r in catalog._fit_report(table).collect()}
    assert reached == {"a": True, "b": False, "c": False}
    reached = {r["subject"]: r["reaches_majority"] for r in catalog._regression_report(table).collect()}
    assert reached == {"a": True, "b": True, "c": False}


@pytest.mark.parametrize("name", FIT_REPORTS)
def test_sql_of_fit_reports_has_the_majority_column(name):
    assert "reaches_majority" in oracles.ORACLES[name]


def test_bayes_scores_neither_sort_nor_exchange_entries(toy):
    model = fit_naive_bayes(toy, ["a", "not a", "all"], buckets=2)
    plan = predict_naive_bayes(model, toy)._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline_outer(vec" not in plan and "Generate inline(vec" not in plan


def test_bayes_scores_of_a_model_too_large_for_every_task(spark, monkeypatch):
    """Repeated and missing ids, empty vectors and buckets without weight: both ways score them alike."""
    rows = [
        (1, "train", [1.0], [(0, 2.0), (3, 1.0)]), (2, "train", [0.0], [(1, 1.5)]), (3, "test", [0.0], []),
        (4, "test", [1.0], [(2, 1.0), (7, 3.0)]), (4, "test", [1.0], [(0, 0.5)]), (None, "test", [0.0], [(1, 2.0)]),
    ]
    examples = spark.createDataFrame(
        rows, "doc_id bigint, split string, labels array<double>, vec array<struct<bucket:int,w:double>>"
    )
    model = fit_naive_bayes(examples, ["a"], buckets=8)

    def found():
        scored = predict_naive_bayes(model, examples).collect()
        return {r["doc_id"]: (r["split"], r["label"], round(r["margin"], 9), r["prediction"]) for r in scored}

    small = found()
    monkeypatch.setattr("tomeworks.operators.naive_bayes.BROADCAST_BYTES", 0)
    assert found() == small and set(small) == {1, 2, 3, 4, None}


def test_vectors_of_runs_equal_summed_buckets(spark, monkeypatch):
    """Documents over several batches and tasks, repeated ones and one without an id."""
    rows = [(None if i % 41 == 40 else i * 7 // 60 % 9, i * i % 11, float(i % 5)) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id bigint, bucket int, x double").repartition(3)
    summed = {r["doc_id"]: r["vec"] for r in sparse_vectors(bucket_sums(table, "x")).collect()}
    monkeypatch.setattr("tomeworks.operators.vectors._AT_ONCE", 20)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        for df in (table, table.coalesce(1).orderBy("doc_id"), table.where("bucket < 0")):
            expected = summed if df.count() else {}
            assert {r["doc_id"]: r["vec"] for r in weighted_vectors(df, "x").collect()} == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_vectors_are_made_without_a_group_per_entry(spark, folder):
    features = Features(inputs.corpus(spark, folder), Settings(buckets=500))
    plan = features.vectors()._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "sum(" not in plan


@pytest.mark.parametrize("limit", [0, 600, 1 << 26])
def test_bags_are_weighted_in_their_row(spark, limit):
    """No, some and all terms in every task; repeated documents, one without an id, one without terms."""
    texts = ["red green red", "green blue w1", "w2 w3 red violet", None, "", "12", *[f"red word{i % 5} t{i} t{i}" for i in range(20)]]
    rows = [(None if i == 8 else i // 2 if i > 20 else i, t) for i, t in enumerate(texts)]
    features = Features(spark.createDataFrame(rows, "doc_id bigint, text string"), Settings(buckets=7, broadcast_bytes=limit))
    made = tfidf_vectors(features.bags, features.idf, limit)
    plan = made._jdf.queryExecution().executedPlan().toString()
    # entries of frequent terms are neither taken apart nor joined; with all of them known there is no join
    assert "Generate" not in plan and ("Join" in plan) == (limit < 1 << 26)
    expected = {r["doc_id"]: r["vec"] for r in weighted_vectors(tfidf(features.tf, features.idf), "tfidf").collect()}
    got = {r["doc_id"]: r["vec"] for r in made.collect()}
    assert got.keys() == expected.keys() and None in got
    for doc_id, vec in got.items():
        assert [e["bucket"] for e in vec] == [e["bucket"] for e in expected[doc_id]]
        assert [e["w"] for e in vec] == pytest.approx([e["w"] for e in expected[doc_id]])


@pytest.mark.parametrize("hash_name", ["md5", "xxhash64", "string"])
def test_tf_vectors_by_any_hash(spark, folder, hash_name):
    features = Features(inputs.corpus(spark, folder), Settings(buckets=300, hash_name=hash_name))
    made = bag_vectors(features.bags, 300, hash_name)
    # entries are not sorted by an expression
    assert "sort_array" not in made._jdf.queryExecution().executedPlan().toString()
    summed = bucket_sums(hash_terms(features.tf, 300, hash_name), "tf")
    both = made.select("doc_id", F.inline("vec")).join(summed.withColumnRenamed("w", "v"), ["doc_id", "bucket"], "full")
    assert both.where("w is null or v is null or abs(w - v) > 1e-9").count() == 0 < both.count()


def test_terms_are_counted_once_for_all_settings(spark, folder):
    first = catalog._features(spark, folder)
    bags = first.bags
    for settings in (Settings(buckets=6000), Settings(log_idf=False)):
        other = catalog._features(spark, folder, settings)
        assert other.settings == settings and other.bags is bags and other.idf is not first.idf
    assert catalog._features(spark, folder, Settings(stop_after=3)).bags is not bags
