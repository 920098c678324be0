"""Mini-batch regressions against numpy on the same draws."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_trees import examples, random_set
from tomeworks.operators import gradient_regression as gr


def numpy_fit(x, y, slices, reg, iterations, tolerance=gr.TOLERANCE):
    """Dense, one model, one row at a time."""
    w, steps = np.zeros(x.shape[1] + 1), 0
    for t in range(1, iterations + 1):
        drawn = set(gr.drawn_slices(t))
        rows = [np.append(v, 1.0) for v, s in zip(x, slices) if s in drawn]
        labels = [label for label, s in zip(y, slices) if s in drawn]
        if not rows:
            continue
        gradient = sum((1 / (1 + np.exp(-w @ v)) - label) * v for v, label in zip(rows, labels)) / len(rows)
        size = 1 / np.sqrt(t)
        new = w - size * gradient
        new = np.array([max(abs(a) - size * reg, 0) * (1 if a > 0 else -1) for a in new])
        change, w, steps = np.linalg.norm(new - w), new, t
        if t > 1 and change < tolerance * max(np.linalg.norm(w), 1):
            break
    return w, steps


@pytest.fixture(scope="module")
def case(spark):
    x, y, splits = random_set(11, n=400, columns=9)
    rows = examples(spark, x, y, splits)
    slices = [r.s for r in rows.select(gr.slice_of().alias("s"), "doc_id").orderBy("doc_id").collect()]
    return x, y, splits, rows, slices


def test_coefficients_equal_numpy_on_the_same_draws(spark, case):
    x, y, splits, rows, slices = case
    train = [s == "train" for s in splits]
    model = gr.fit(rows, ["a", "b", "c"], buckets=9, reg_params=(0.3, 0.01), iterations=25)
    assert model.models == [(n, r) for r in (0.3, 0.01) for n in "abc"]
    for i, (name, reg) in enumerate(model.models):
        of = "abc".index(name)
        want, steps = numpy_fit(x[train], y[train][:, of], np.array(slices)[train], reg, 25)
        assert model.weights[i] == pytest.approx(want, abs=1e-9)
        assert model.steps[i] == steps
        assert model.coefficients()[i] == np.count_nonzero(np.abs(want[:-1]) > 0)
    assert max(model.coefficients()) > 3


def test_predictions(spark, case):
    x, y, splits, rows, _ = case
    model = gr.fit(rows, ["a", "b", "c"], buckets=9, reg_params=(0.01,), iterations=15)
    got = {(r.doc_id, r.subject): r for r in gr.predict(model, rows).collect()}
    assert len(got) == 3 * len(x)
    for (i, subject), r in got.items():
        s = "abc".index(subject)
        margin = model.weights[s] @ np.append(x[i], 1.0)
        assert r.margin == pytest.approx(margin, abs=1e-9)
        assert (r.prediction, r.label, r.split) == (float(margin > 0), float(y[i, s]), splits[i])
    test = [r for r in got.values() if r.split == "test"]
    majority = sum(max(n, 1 - n) for n in (np.mean([r.label for r in test if r.subject == s]) for s in "abc")) / 3
    assert np.mean([r.prediction == r.label for r in test]) > majority


def test_a_step_reads_its_slices_only(spark, case):
    rows = case[3]
    train = gr.stage(rows.select("labels", "vec", gr.slice_of().alias("slice")), "slices", partition_by=("slice",))
    drawn = gr.drawn_slices(3)
    assert len(set(drawn)) == 5 and drawn == gr.drawn_slices(3) != gr.drawn_slices(4)
    plan = train.where(F.col("slice").isin(drawn))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [slice" in plan


def test_no_training_rows(spark, case):
    rows = case[3].where("split = 'test'")
    model = gr.fit(rows, ["a", "b", "c"], buckets=9, iterations=3)
    assert not model.weights.any() and model.steps == [0, 0, 0]
    assert {r.prediction for r in gr.predict(model, rows).collect()} == {0.0}
