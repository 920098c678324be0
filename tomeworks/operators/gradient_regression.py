"""Logistic regression by mini-batch gradient descent with L1, for many subjects and settings at once.

The weights of all models, one for every (subject, regularisation), form one
matrix of models * (buckets + 1), the intercept last; it goes to every task.  A
step reads one mini-batch, computes the gradients of all models from its
sparse rows, and sums them by bucket in one exchange, so the driver gets at most
one row a bucket, whatever the number of tasks.  All rows take part over the
steps; nothing is bounded by a number of training rows.

Step t, with step size s / sqrt(t):

    w <- soft(w - s_t * mean gradient of the batch, s_t * reg)

soft() moves each weight, also the intercept, towards 0 by the second
argument.  A model is finished when a step changes it by less than ``tolerance`` of its
length, or of 1 if that is more; an empty batch is skipped.

A mini-batch is drawn by hash: training rows are laid out in SLICES by a hash of
their id, and each step draws ``fraction`` of the slices, so a step reads that part
of the table only.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.operators.vectors import sparse_entries
from tomeworks.staging import stage

SLICES = 50
FRACTION = 0.1
STEP = 1.0
ITERATIONS = 100
TOLERANCE = 0.001


@dataclass
class Regressions:
    """``weights`` has a row for each of ``models``, (subject, regularisation); the last column is the intercept."""

    models: list[tuple[str, float]]
    names: list[str]
    weights: np.ndarray
    steps: list[int] = field(default_factory=list)

    def positions(self) -> list[int]:
        """Where the labels of each model are."""
        return [self.names.index(subject) for subject, _ in self.models]

    def coefficients(self) -> list[int]:
        """Coefficients that are not 0, without the intercept."""
        return [int(n) for n in np.count_nonzero(self.weights[:, :-1], axis=1)]


def slice_of(doc_id: str = "doc_id", seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(SLICES)).cast("int")


def drawn_slices(step: int, fraction: float = FRACTION, seed: int = 0) -> list[int]:
    """The slices of a step: the same for the same step and seed, everywhere."""
    return random.Random(f"{seed}/{step}").sample(range(SLICES), max(1, round(SLICES * fraction)))


def _margins(weights: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """One row a model, one column a document."""
    return np.stack([np.bincount(row, w[bucket] * value, minlength=n) + w[-1] for w in weights])


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    small = np.exp(-np.abs(margin))
    return np.where(margin >= 0, 1, small) / (1 + small)


def _gradients(rows: DataFrame, shared, positions: list[int]) -> pa.Table:
    """(bucket, g ARRAY<DOUBLE>): gradients of all models; the bucket after the last is the intercept's, -1 has the number of rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        total, seen = np.zeros_like(weights), 0
        for batch in batches:
            if not len(batch):
                continue
            row, bucket, value = sparse_entries(batch, "vec")
            labels = batch.column("labels").flatten().to_numpy().reshape(len(batch), -1).T[positions]
            excess = _sigmoid(_margins(weights, row, bucket, value, len(batch))) - labels
            for model, one in enumerate(excess):
                total[model, :-1] += np.bincount(bucket, one[row] * value, minlength=weights.shape[1] - 1)
                total[model, -1] += one.sum()
            seen += len(batch)
        if seen:
            touched = np.flatnonzero(total.any(axis=0))
            count = np.full((1, len(weights)), float(seen))
            values = np.concatenate([count, total.T[touched]])
            offsets = np.arange(len(values) + 1) * len(weights)
            buckets = pa.array(np.concatenate([[-1], touched]), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([buckets, lists], ["bucket", "g"])

    parts = rows.select("labels", "vec").mapInArrow(partial, "bucket int, g array<double>")
    sums = [F.sum(F.get("g", F.lit(i))).alias(f"g{i}") for i in range(len(positions))]
    return parts.groupBy("bucket").agg(*sums).toArrow()  # at most buckets + 2 rows


def soft_threshold(weights: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(weights) * np.maximum(np.abs(weights) - by, 0)


def fit(
    examples: DataFrame,
    names: list[str],
    buckets: int,
    reg_params: Iterable[float] = (0.3,),
    iterations: int = ITERATIONS,
    step: float = STEP,
    fraction: float = FRACTION,
    tolerance: float = TOLERANCE,
    seed: int = 0,
) -> Regressions:
    """A model for every name and regularisation, from the ``train`` rows of (doc_id, split, labels ARRAY<DOUBLE>, vec)."""
    context = examples.sparkSession.sparkContext
    models = [(name, float(reg)) for reg in reg_params for name in names]
    found = Regressions(models, list(names), np.zeros((len(models), buckets + 1)), [0] * len(models))
    reg = np.array([[r] for _, r in models])
    going = np.ones(len(models), bool)
    train = examples.where(F.col("split") == "train").select("labels", "vec", slice_of(seed=seed).alias("slice"))
    # a slice lies in one folder, in as many files as the rows have tasks
    train = stage(train, "slices", partition_by=("slice",))
    for t in range(1, iterations + 1):
        batch = train.where(F.col("slice").isin(drawn_slices(t, fraction, seed)))
        shared = context.broadcast(found.weights)
        table = _gradients(batch, shared, found.positions())
        shared.unpersist()
        if not len(table):
            continue
        values = np.stack([table.column(f"g{i}").to_numpy() for i in range(len(models))])
        where = table.column("bucket").to_numpy()
        gradient = np.zeros_like(found.weights)
        gradient[:, where[where >= 0]] = values[:, where >= 0] / values[:, where < 0]
        size = step / np.sqrt(t)
        moved = soft_threshold(found.weights - size * gradient, size * reg)
        change = np.linalg.norm(moved - found.weights, axis=1)
        found.weights = np.where(going[:, None], moved, found.weights)
        found.steps = [t if g else s for g, s in zip(going, found.steps)]
        # the first step starts from nothing and is not judged
        going &= (change >= tolerance * np.maximum(np.linalg.norm(moved, axis=1), 1)) | (t == 1)
        if not going.any():
            break
    return found


def predict(model: Regressions, examples: DataFrame) -> DataFrame:
    """(doc_id, split, subject, reg_param, label, margin, prediction) for every example and model."""
    shared = examples.sparkSession.sparkContext.broadcast(model.weights)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            found = _margins(weights, *sparse_entries(batch, "vec"), len(batch)).T
            offsets = pa.array(np.arange(len(batch) + 1) * len(weights), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            columns = [batch.column(c) for c in ("doc_id", "split", "labels")]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "split", "labels", "margins"])

    rows = examples.select("doc_id", "split", "labels", "vec")
    kind = examples.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(margins, f"doc_id {kind}, split string, labels array<double>, margins array<double>")

    def outcome(i: int, position: int) -> Column:
        margin = F.get("margins", F.lit(i))
        return F.struct(
            F.lit(model.models[i][0]).alias("subject"),
            F.lit(model.models[i][1]).alias("reg_param"),
            F.get("labels", F.lit(position)).alias("label"),
            margin.alias("margin"),
            (margin > 0).cast("double").alias("prediction"),
        )

    outcomes = [outcome(i, position) for i, position in enumerate(model.positions())]
    return scored.select("doc_id", "split", F.inline(F.array(*outcomes)))
