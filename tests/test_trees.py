"""Trees of all subjects against an independent one in numpy and against spark.ml."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tomeworks.operators import trees
from tomeworks.plans import experiments
from tomeworks.staging import stage

SCHEMA = "doc_id bigint, split string, labels array<double>, vec array<struct<bucket:int,w:double>>"


def examples(spark, values, labels, splits):
    rows = [
        (i, splits[i], [float(y) for y in labels[i]], [(b, float(w)) for b, w in enumerate(v) if w])
        for i, v in enumerate(values)
    ]
    return stage(spark.createDataFrame(rows, SCHEMA), "rows")


def entropy(y):
    p = np.mean(y)
    return -sum(x * math.log2(x) for x in (p, 1 - p) if x > 0)


def cuts_of(values, bins):
    """Cuts of one column, zeros included."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= bins:
        return [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
    cuts, step = [], len(values) / bins
    target, seen = step, 0
    for k in range(1, len(distinct)):
        seen += counts[k - 1]
        if abs(seen - target) < abs(seen + counts[k] - target):
            cuts.append((distinct[k - 1] + distinct[k]) / 2)
            target += step
    return cuts


def numpy_tree(x, y, depth, bins=5):
    """{node: (n, positives, bucket, threshold)} by trying every cut of every column."""
    cuts = [cuts_of(x[:, j], bins) for j in range(x.shape[1])]
    nodes, members = {}, {1: np.arange(len(y))}
    for i in range(1, 2 ** (depth + 1)):
        if i not in members:
            continue
        rows = members[i]
        best = None
        if i < 2**depth and 0 < y[rows].sum() < len(rows):
            for j, some in enumerate(cuts):
                for cut in some:
                    left = x[rows, j] <= cut
                    if 0 < left.sum() < len(rows):
                        parts = rows[left], rows[~left]
                        gain = entropy(y[rows]) - sum(len(p) / len(rows) * entropy(y[p]) for p in parts)
                        if round(gain, 12) > (best[0] if best else 0):
                            best = (round(gain, 12), j, cut, parts)
        nodes[i] = (len(rows), int(y[rows].sum()), best and best[1], best and best[2])
        if best:
            members[2 * i], members[2 * i + 1] = best[3]
    return nodes


def random_set(seed, n=160, columns=7, subjects=3, sparse=True, negative=False):
    draw = np.random.default_rng(seed)
    x = draw.exponential(size=(n, columns)) - (1 if negative else 0)
    if sparse:
        x *= draw.random((n, columns)) < 0.4
        x[:, 0] = np.round(x[:, 0])  # few values
        x[:, 1] = 0
    noise = draw.normal(size=(n, subjects)) * 0.4
    y = (x[:, -subjects:] + x[:, :subjects] * 0.3 + noise > 0.4).astype(int)
    splits = draw.choice(["train", "train", "train", "test", "validate"], size=n).tolist()
    return x, y, splits


def found_nodes(grown, s):
    return {i: (x.n, int(x.positives), x.bucket, x.threshold) for i, x in grown.nodes[s].items()}


@pytest.mark.parametrize("seed,sparse,negative", [(1, True, False), (2, False, True), (3, True, True)])
def test_nodes_and_splits_equal_an_independent_tree(spark, seed, sparse, negative):
    x, y, splits = random_set(seed, sparse=sparse, negative=negative)
    grown = trees.grow(examples(spark, x, y, splits), ["a", "b", "c"], depth=4)
    train = np.array([s == "train" for s in splits])
    for s in range(3):
        want = numpy_tree(x[train], y[train, s], 4)
        got = found_nodes(grown, s)
        assert got.keys() == want.keys()
        for i in want:
            assert got[i][:3] == want[i][:3]
            assert got[i][3] == pytest.approx(want[i][3], abs=1e-12) if want[i][3] is not None else got[i][3] is None


def test_predictions_equal_spark_ml(spark):
    x, y, splits = random_set(5, n=300, sparse=False)
    rows = examples(spark, x, y, splits)
    grown = trees.grow(rows, ["a", "b", "c"], depth=4)
    ours = trees.predictions(grown, rows, [2, 3, 4]).collect()
    dense = rows.withColumn("features", array_to_vector(F.transform("vec", lambda e: e["w"])))
    for s, name in enumerate("abc"):
        data = dense.select("doc_id", "split", F.get("labels", F.lit(s)).alias("label"), "features")
        for depth in (2, 3, 4):
            model = experiments.decision_tree(depth).fit(data.where("split = 'train'"))
            want = {r.doc_id: r.prediction for r in model.transform(data).collect()}
            got = {r.doc_id: r.prediction for r in ours if r.subject == name and r.depth == depth}
            assert got == want


def test_a_cut_tree_is_the_tree_of_that_depth(spark):
    x, y, splits = random_set(6)
    rows = examples(spark, x, y, splits)
    deep = trees.grow(rows, ["a", "b", "c"], depth=4)
    key = lambda r: (r.doc_id, r.subject)
    for depth in (0, 1, 3):
        alone = trees.grow(rows, ["a", "b", "c"], depth=depth)
        want = {key(r): r.prediction for r in trees.predictions(alone, rows, [depth]).collect()}
        assert {key(r): r.prediction for r in trees.predictions(deep, rows, [depth]).collect()} == want


def test_nothing_to_split(spark):
    constant = examples(spark, [[1.0, 0.0]] * 6, [[i % 2, 1] for i in range(6)], ["train"] * 4 + ["test"] * 2)
    grown = trees.grow(constant, ["half", "all"], depth=3)
    assert [list(n) for n in grown.nodes] == [[1], [1]]
    got = {(r.subject, r.prediction) for r in trees.predictions(grown, constant, [3]).collect()}
    assert got == {("half", 0.0), ("all", 1.0)}
    empty = trees.grow(constant.limit(0), ["half"], depth=2)
    assert empty.table(spark).first().n_docs == 0


def test_cuts_come_from_a_bounded_number_of_rows(spark):
    x, y, splits = random_set(7, n=400)
    rows = examples(spark, x, y, splits).where("split = 'train'")
    few = {r.bucket: r.cuts for r in trees.thresholds(rows, split_rows=60).collect()}
    everything = {r.bucket: r.cuts for r in trees.thresholds(rows).collect()}
    assert few.keys() <= everything.keys() and few != everything
    train = np.array([s == "train" for s in splits])
    for j, cuts in everything.items():
        assert cuts == pytest.approx(cuts_of(x[train, j], 5), abs=1e-12)


def test_binning_keeps_a_document_in_its_row(spark, monkeypatch):
    """Without an exchange and a collected list, and as the join does it; buckets without cuts are left out."""
    rows = [(1, [1.0], [(0, 0.5), (2, 3.0), (9, 1.0)]), (2, [0.0], [(2, -1.0), (5, 2.0)]), (3, [0.0], [(7, 1.0)]), (4, [0.0], [])]
    train = spark.createDataFrame(rows, "doc_id bigint, labels array<double>, vec array<struct<bucket:int,w:double>>")
    cuts = spark.createDataFrame([(2, [-1.0, 0.0, 2.0], 1), (0, [0.25], 0), (5, [2.5], 0)], "bucket int, cuts array<double>, zero_bin int")
    binned = trees.binned_rows(train, cuts, 5)
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "collect_list" not in plan

    def found(df):
        return {r["doc_id"]: sorted(map(tuple, r["entries"])) for r in df.collect() if r["entries"]}

    assert found(binned) == {1: [(0, 1), (2, 3)], 2: [(2, 0), (5, 0)]}
    monkeypatch.setattr(trees, "BROADCAST_BYTES", 0)
    assert found(trees.binned_rows(train, cuts, 5)) == found(binned)
    monkeypatch.undo()
    assert found(trees.binned_rows(train, cuts.where("bucket < 0"), 5)) == {}


def test_repeated_ids_grow_as_rows_of_their_own(spark):
    """Depth 2 asks for buckets of a document again; a repeated id is no repeated bucket."""
    values = [[1.0, 1.0], [1.0, 3.0], [2.0, 1.0], [2.0, 3.0]] * 5
    rows = [(i // 2, "train", [float(v == [2.0, 3.0])], list(enumerate(v))) for i, v in enumerate(values)]
    table = stage(spark.createDataFrame(rows, SCHEMA), "repeated")
    grown = trees.grow(table, ["a"], 2)
    assert {i: (x.n, x.positives) for i, x in grown.nodes[0].items()} == {1: (20, 5.0), 2: (10, 0.0), 3: (10, 5.0), 6: (5, 0.0), 7: (5, 5.0)}


def test_cells_are_counted_once_a_node_and_bucket_in_a_task(spark, monkeypatch):
    rows = [
        (i, "train", [float(i % 2), None if i % 5 == 0 else float(i % 3 == 0)], [(b, float(i * b % 7)) for b in range(i % 4)] or None)
        for i in range(200)
    ]
    schema = "doc_id bigint, split string, labels array<double>, vec array<struct<bucket:int,w:double>>"
    table = stage(spark.createDataFrame(rows, schema).repartition(3), "cells")
    one = trees.grow(table, ["a", "b"], 3)
    cuts = stage(trees.thresholds(table), "cuts")
    buckets = np.array(sorted(r["bucket"] for r in cuts.collect()))
    binned = trees.binned_rows(table, cuts, trees.BINS)
    root = trees.Trees(["a", "b"], 3, [{1: trees.Node(200, 100.0)}, {1: trees.Node(200, 60.0)}])
    cells = trees._level_histograms(binned, root, 0, buckets, trees.BINS)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    # no document is taken apart into a row for each subject and entry
    assert "Generate" not in plan and plan.count("Exchange") == 1
    found = {(r["subject"], r["bucket"]): (sum(r[f"n{b}"] for b in range(5)), sum(r[f"p{b}"] for b in range(5))) for r in cells.collect()}
    for s in (0, 1):
        for bucket in (1, 2):
            some = [r for r in rows if any(b == bucket for b, _ in r[3] or ())]
            assert found[s, bucket] == (len(some), sum(r[2][s] or 0 for r in some))
    # subjects in parts give the same trees
    monkeypatch.setattr(trees, "_CELL_BYTES", 1)
    assert trees.grow(table, ["a", "b"], 3).nodes == one.nodes
