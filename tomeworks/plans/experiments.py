"""Classifier experiments over the most frequent subjects.

Every experiment trains one binary classifier per subject on the ``train`` part
of a split plan and reports on all parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.operators.datasets import training_set
from tomeworks.operators.gradient_regression import Regressions, fit, predict
from tomeworks.operators.metrics import binary_metrics, confusion
from tomeworks.operators.naive_bayes import NaiveBayesModel, fit_naive_bayes, predict_naive_bayes
from tomeworks.operators.subjects import subject_frequency, top_names
from tomeworks.operators.trees import Trees, grow, predictions
from tomeworks.operators.vectors import with_ml_vectors
from tomeworks.plans.features import Features
from tomeworks.staging import stage

DEPTHS = (2, 3, 4)
REG_PARAMS = (0.3, 0.1, 0.01, 0.001)  # the first is the reference's
SPLITS = ("train", "test", "validate")


@dataclass(frozen=True)
class Examples:
    """A training set together with what its vectors were made with, so that no experiment can assume otherwise.

    ``rows`` is a stage table (doc_id, split, labels, vec); ``names`` are its subjects.
    """

    rows: DataFrame
    names: list[str]
    buckets: int
    weighting: str = "tfidf"
    log_idf: bool = True

    def first(self, n: int | None) -> Examples:
        """The same with only the first subjects."""
        return replace(self, names=self.names[:n])


def labelled_examples(
    features: Features,
    metadata: DataFrame,
    plan: str = "7/2/1",
    weighting: str = "tfidf",
    k: int = 10,
) -> Examples:
    """The staged training set of the run's most frequent subjects."""
    manifest = stage(features.manifest(metadata), "manifest")
    names = top_names(subject_frequency(manifest), k)
    return examples_of(features, manifest, names, plan, weighting)


def examples_of(features: Features, manifest: DataFrame, names: list[str], plan: str, weighting: str) -> Examples:
    rows = stage(training_set(features.vectors(weighting), manifest, names, plan), "examples")
    return Examples(rows, names, features.settings.buckets, weighting, features.settings.log_idf)


def naive_bayes_model(examples: Examples, smoothing: float = 1.0) -> NaiveBayesModel:
    return fit_naive_bayes(examples.rows, examples.names, examples.buckets, smoothing)


def naive_bayes_predictions(examples: Examples, smoothing: float = 1.0) -> DataFrame:
    """(doc_id, split, subject, label, margin, prediction)."""
    return predict_naive_bayes(naive_bayes_model(examples, smoothing), examples.rows)


def naive_bayes_experiment(examples: Examples, smoothing: float = 1.0) -> DataFrame:
    """All measures per subject and split."""
    predicted = naive_bayes_predictions(examples, smoothing)
    measures = binary_metrics(confusion(predicted, "subject", "split"), "subject", "split")
    return measures.withColumn("buckets", F.lit(examples.buckets)).withColumn("log_used", F.lit(examples.log_idf))


def decision_tree(depth: int) -> DecisionTreeClassifier:
    """spark.ml's tree of the same settings as those of ``grown_trees``, for a single subject."""
    return DecisionTreeClassifier(
        featuresCol="features",
        labelCol="label",
        leafCol="leaf",
        impurity="entropy",
        maxBins=5,
        maxDepth=depth,
    )


def logistic_regression(reg_param: float = 0.3) -> LogisticRegression:
    """L1 with intercept.  spark.ml optimises over all rows; there are no mini-batches."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=reg_param,
        elasticNetParam=1.0,
        fitIntercept=True,
    )


def ml_naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(featuresCol="features", labelCol="label", smoothing=smoothing)


def fitting_rows(rows: DataFrame, max_training_rows: int | None = None) -> DataFrame:
    """``rows`` with ``in_fit``: the training rows that fits use, all of them unless a caller sets a bound.

    With a bound, about ``max_training_rows`` of them are drawn by a hash of the id.  Rows of all splits are scored and
    counted whatever the bound.
    """
    is_train = F.col("split") == "train"
    if max_training_rows is None:
        return rows.withColumn("in_fit", is_train)
    n = rows.where(is_train).count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) * F.lit(float(n)) < F.lit(float(max_training_rows) * (1 << 30))
    return rows.withColumn("in_fit", is_train & draw)


def for_subject(vectors: DataFrame, position: int) -> DataFrame:
    """(split, in_fit, label, features) for one subject."""
    return vectors.select("split", "in_fit", F.get("labels", F.lit(position)).alias("label"), "features")


# (split, label, prediction, n) rows of one fitted model
Counts = list[tuple[str, float, float, int]]


def run_model(estimator: Estimator, data: DataFrame) -> tuple[Counts, int | None]:
    """Fit; confusion counts of all splits from one pass, and the number of non-zero coefficients.

    A dozen rows at most come back to the driver.
    """
    model = estimator.fit(data.where("in_fit"))
    counts = confusion(model.transform(data), "split").collect()
    used = int(model.coefficients.numNonzeros()) if hasattr(model, "coefficients") else None
    return [(r["split"], r["label"], r["prediction"], r["n"]) for r in counts], used


def _counts_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows,
        "subject string, setting string, n_coefficients int, split string, label double, prediction double, n bigint",
    )


def _per_subject(vectors: DataFrame, names: list[str], job: Callable, parallelism: int) -> list[tuple]:
    """Run ``job(data) -> {setting: (Counts, coefficients)}`` for each subject, a few at a time.

    ``vectors`` is a stage table: every fit reads it, none recomputes it.
    """

    def run(task: tuple[int, str]) -> list[tuple]:
        position, name = task
        results = job(for_subject(vectors, position))
        return [(name, str(s), used, *c) for s, (counts, used) in results.items() for c in counts]

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [row for rows in pool.map(run, enumerate(names)) for row in rows]


def accuracy_table(counts: DataFrame) -> DataFrame:
    """One row per subject and setting: documents and accuracy of each split, training positives and majority share."""
    keys = ["subject", "setting", "n_coefficients"]
    measures = binary_metrics(counts, *keys, "split")

    def of(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    table = measures.groupBy(*keys).agg(
        *[F.coalesce(of(s, "n_docs"), F.lit(0)).alias(f"{s}_docs") for s in SPLITS],
        *[of(s, "accuracy").alias(f"{s}_accuracy") for s in SPLITS],
        F.coalesce(of("train", "positives"), F.lit(0)).alias("train_positives"),
    )
    share = F.col("train_positives") / F.col("train_docs")
    return table.withColumn("train_majority", F.greatest(share, 1 - share))


def ml_vectors(examples: Examples, max_training_rows: int | None = None) -> DataFrame:
    return with_ml_vectors(fitting_rows(examples.rows, max_training_rows), examples.buckets)


def grown_trees(examples: Examples, depth: int = max(DEPTHS)) -> Trees:
    """The trees of all subjects, from all training rows."""
    return grow(examples.rows, examples.names, depth)


def decision_tree_experiment(examples: Examples, depths: Iterable[int] = DEPTHS) -> DataFrame:
    """The depth sweep: all subjects grow together, once, and are cut off at each depth; ``setting`` is the depth."""
    depths = list(depths)
    found = predictions(grown_trees(examples, max(depths)), examples.rows, depths)
    found = found.withColumn("setting", F.col("depth").cast("string"))
    counts = confusion(found, "subject", "setting", "split")
    return accuracy_table(counts.select("*", F.lit(None).cast("int").alias("n_coefficients")))


def logistic_regression_experiment(
    examples: Examples,
    reg_params: Iterable[float] = REG_PARAMS[:1],
    parallelism: int = 8,
    max_training_rows: int | None = None,
) -> DataFrame:
    """The regularisation sweep, one fit per subject and value; ``setting`` is the value.

    At the reference's 0.3 few subjects get any coefficient; ``n_coefficients`` shows it.
    """
    vectors = ml_vectors(examples, max_training_rows)

    def job(data: DataFrame) -> dict[float, tuple]:
        return {r: run_model(logistic_regression(r), data) for r in reg_params}

    rows = _per_subject(vectors, examples.names, job, parallelism)
    return accuracy_table(_counts_table(examples.rows.sparkSession, rows))


def gradient_models(examples: Examples, reg_params: Iterable[float] = REG_PARAMS[:1], **options) -> Regressions:
    """Mini-batch regressions of all subjects and settings, fitted together over all training rows."""
    return fit(examples.rows, examples.names, examples.buckets, reg_params, **options)


def gradient_regression_experiment(
    examples: Examples, reg_params: Iterable[float] = REG_PARAMS[:1], **options
) -> DataFrame:
    """The regularisation sweep with the mini-batch optimiser; ``setting`` is the value."""
    models = gradient_models(examples, reg_params, **options)
    used = {m: n for m, n in zip(models.models, models.coefficients())}
    counts = confusion(predict(models, examples.rows), "subject", "reg_param", "split").collect()  # a few a model
    rows = [
        (r["subject"], str(r["reg_param"]), used[r["subject"], r["reg_param"]], r["split"], r["label"], r["prediction"], r["n"])
        for r in counts
    ]
    return accuracy_table(_counts_table(examples.rows.sparkSession, rows))
