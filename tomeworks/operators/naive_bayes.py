"""Multinomial Naive Bayes for many subjects in one pass.

The model is closed-form, so there is nothing to iterate: one aggregation of the
training vectors by bucket gives every weight sum of every subject at once.  The
sums of the negative class are the totals minus the positive ones, so no document
is repeated per subject.

    pi(c)       = ln(docs(c) + smoothing) - ln(docs + 2 * smoothing)
    theta(c, b) = ln(w(c, b) + smoothing) - ln(sum_b w(c, b) + buckets * smoothing)
    score(d, c) = pi(c) + sum_b w(d, b) * theta(c, b)
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.functions.hashing import DEFAULT_BUCKETS
from tomeworks.operators.lookup import BROADCAST_BYTES
from tomeworks.operators.vectors import sparse_entries
from tomeworks.staging import stage


@dataclass
class NaiveBayesModel:
    """``sums`` has one row per bucket seen in training: bucket, all, pos ARRAY<DOUBLE>
    (one entry per subject).  The rest is a handful of numbers per subject."""

    names: list[str]
    sums: DataFrame
    n_docs: int
    n_pos: list[float]
    w_all: float
    w_pos: list[float]
    buckets: int
    smoothing: float

    def prior(self, i: int, label: int) -> float | None:
        """``pi``; None for a class without training documents, which is never predicted."""
        docs = self.n_pos[i] if label else self.n_docs - self.n_pos[i]
        if docs == 0:
            return None
        return math.log(docs + self.smoothing) - math.log(self.n_docs + 2 * self.smoothing)

    def _log_total(self, i: int, label: int) -> float:
        total = self.w_pos[i] if label else max(self.w_all - self.w_pos[i], 0.0)
        return math.log(total + self.buckets * self.smoothing)

    def theta(self, i: int, label: int) -> Column:
        """Log probability of the row's bucket; for a bucket without weight, of any such bucket."""
        pos = F.coalesce(F.get("pos", F.lit(i)), F.lit(0.0))
        both = F.coalesce(F.col("all"), F.lit(0.0))
        weight = pos if label else F.greatest(both - pos, F.lit(0.0))
        return F.ln(weight + F.lit(self.smoothing)) - F.lit(self._log_total(i, label))

    def table(self) -> DataFrame:
        """(subject, label, bucket, theta) for the buckets seen in training."""
        rows = [
            F.struct(
                F.lit(name).alias("subject"),
                F.lit(float(label)).alias("label"),
                self.theta(i, label).alias("theta"),
            )
            for i, name in enumerate(self.names)
            for label in (0, 1)
            if self.prior(i, label) is not None
        ]
        return self.sums.select("bucket", F.inline(F.array(*rows)))

    def priors(self) -> DataFrame:
        """(subject, label, pi)."""
        rows = [
            (name, float(label), self.prior(i, label))
            for i, name in enumerate(self.names)
            for label in (0, 1)
            if self.prior(i, label) is not None
        ]
        return self.sums.sparkSession.createDataFrame(rows, "subject string, label double, pi double")


def fit_naive_bayes(
    examples: DataFrame,
    names: list[str],
    buckets: int = DEFAULT_BUCKETS,
    smoothing: float = 1.0,
) -> NaiveBayesModel:
    """Train on the ``train`` rows of (doc_id, split, labels ARRAY<DOUBLE>, vec)."""
    train = examples.where(F.col("split") == "train")
    ks = range(len(names))
    entries = train.select("labels", F.inline("vec"))
    sums = entries.groupBy("bucket").agg(
        F.sum("w").alias("all"),
        *[F.sum(F.col("w") * F.get("labels", F.lit(i))).alias(f"_pos{i}") for i in ks],
    )
    # at most one row per bucket, whatever the size of the corpus
    sums = stage(sums.select("bucket", "all", F.array(*[f"_pos{i}" for i in ks]).alias("pos")), "nb")
    totals = sums.agg(
        F.sum("all").alias("all"), *[F.sum(F.get("pos", F.lit(i))).alias(f"p{i}") for i in ks]
    ).first()
    docs = train.agg(
        F.count("*").alias("n"), *[F.sum(F.get("labels", F.lit(i))).alias(f"p{i}") for i in ks]
    ).first()
    return NaiveBayesModel(
        names=list(names),
        sums=sums,
        n_docs=docs["n"],
        n_pos=[docs[f"p{i}"] or 0.0 for i in ks],
        w_all=totals["all"] or 0.0,
        w_pos=[totals[f"p{i}"] or 0.0 for i in ks],
        buckets=buckets,
        smoothing=smoothing,
    )


def _summed_by_join(model: NaiveBayesModel, examples: DataFrame, wide: DataFrame, unseen: list[float]) -> DataFrame:
    """(doc_id, split, labels, _s0, ...) for models too large for every task.

    Only numbers are summed by document; split and labels come back once a document.
    """
    ks = range(len(model.names))
    entries = examples.select("doc_id", F.inline("vec")).join(wide, "bucket", "left")
    sums = entries.groupBy("doc_id").agg(
        *[F.sum(F.col("w") * F.coalesce(F.col(f"_d{i}"), F.lit(unseen[i]))).alias(f"_s{i}") for i in ks]
    )
    heads = examples.groupBy(F.col("doc_id").alias("_id")).agg(
        F.first("split").alias("split"), F.first("labels").alias("labels")
    )
    return heads.join(sums, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        F.col("_id").alias("doc_id"), "split", "labels", *[f"_s{i}" for i in ks]
    )


def _summed_in_rows(model: NaiveBayesModel, examples: DataFrame, wide: DataFrame, unseen: list[float]) -> DataFrame:
    """The same with the model in every task: a vector is scored where it is, and one row a document is exchanged."""
    ks = range(len(model.names))
    known = wide.toArrow()  # at most one row a bucket
    weights = np.tile(np.array(unseen), (model.buckets + 1, 1))  # the last is that of any other bucket
    weights[known.column("bucket").to_numpy()] = np.stack([known.column(f"_d{i}").to_numpy() for i in ks], axis=1)
    shared = examples.sparkSession.sparkContext.broadcast(weights)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            row, bucket, value = sparse_entries(batch, "vec")
            at = np.where((bucket >= 0) & (bucket < len(table) - 1), bucket, len(table) - 1)
            sums = [np.bincount(row, table[at, i] * value, minlength=len(batch)) for i in ks]
            columns = [batch.column(c) for c in ("doc_id", "split", "labels")]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(s, pa.float64()) for s in sums]], ["doc_id", "split", "labels", *[f"_s{i}" for i in ks]]
            )

    kind = examples.schema["doc_id"].dataType.simpleString()
    scored = examples.select("doc_id", "split", "labels", "vec").mapInArrow(
        scores, ", ".join([f"doc_id {kind}, split string, labels array<double>", *[f"_s{i} double" for i in ks]])
    )
    # rows of one document count together
    return scored.groupBy("doc_id").agg(
        F.first("split").alias("split"),
        F.first("labels").alias("labels"),
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in ks],
    )


def predict_naive_bayes(model: NaiveBayesModel, examples: DataFrame) -> DataFrame:
    """(doc_id, split, subject, label, margin, prediction) for every example and subject.

    ``margin`` is score(1) - score(0).  All subjects are scored at once, and the
    entries of a vector are neither sorted nor exchanged unless the model is too
    large to be in every task.
    """
    ks = range(len(model.names))
    both = {i for i in ks if model.prior(i, 0) is not None and model.prior(i, 1) is not None}
    wide = model.sums.select(
        "bucket", *[(model.theta(i, 1) - model.theta(i, 0)).alias(f"_d{i}") for i in ks]
    )
    unseen = [model._log_total(i, 0) - model._log_total(i, 1) for i in ks]
    small = model.buckets * (len(model.names) + 1) * 16 <= BROADCAST_BYTES
    labelled = (_summed_in_rows if small else _summed_by_join)(model, examples, wide, unseen)

    def outcome(i: int) -> Column:
        if i in both:
            gap = F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(model.prior(i, 1) - model.prior(i, 0))
        else:
            only = float("inf") if model.prior(i, 1) is not None else float("-inf")
            gap = F.lit(only)
        return F.struct(
            F.lit(model.names[i]).alias("subject"),
            F.get("labels", F.lit(i)).alias("label"),
            gap.alias("margin"),
            (gap > 0).cast("double").alias("prediction"),
        )

    return labelled.select("doc_id", "split", F.inline(F.array(*[outcome(i) for i in ks])))
