"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job is timed from its inputs: the raw documents for the feature jobs, the
staged training set for the model jobs.  Results are consumed in full.
"""

from __future__ import annotations

import json
import os
import time

from tomeworks.operators import boilerplate, vocabulary
from tomeworks.plans import catalog, experiments, inputs
from tomeworks.plans.corpus_audit import audit
from tomeworks.plans.features import Features, Settings
from tomeworks.session import local_session
from tomeworks.staging import stage_path
from tomeworks.streaming import running_df

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(cpus=CPUS, name="bench")
    # the table is one small file: its scan alone would not use the cores
    corpus = lambda: inputs.corpus(spark, FOLDER, partitions=CPUS)
    marked = lambda: inputs.marked(spark, FOLDER, partitions=CPUS)
    meta = inputs.metadata(spark, FOLDER)
    seconds: dict[str, float] = {}

    def timed(name, job):
        started = time.monotonic()
        result = job()
        seconds[name] = round(time.monotonic() - started, 3)
        return result

    consume(catalog.top_terms(Features(inputs.corpus(spark, "/root/testdata/sf0.001"))))  # JVM warm-up

    timed("strip_boilerplate", lambda: consume(boilerplate.strip_boilerplate(marked())))
    timed("strip_with_cap", lambda: consume(Features(marked(), Settings(strip=True, stop_after=1000)).bodies))
    timed("corpus_audit", lambda: consume(audit(marked(), inputs.metadata_keys(spark, FOLDER))))
    timed("eligible_corpus", lambda: consume(catalog.QUERIES["p1_eligible_corpus"](spark, FOLDER)))
    timed("tf", lambda: consume(Features(corpus()).tf))
    timed("idf", lambda: consume(Features(corpus()).idf))
    timed("tfidf", lambda: consume(Features(corpus()).tfidf))
    timed("tfidf_without_broadcast", lambda: consume(Features(corpus(), Settings(broadcast_bytes=0)).tfidf))
    timed("tf_vectors", lambda: consume(Features(corpus()).vectors("tf")))
    timed("hash_vectors", lambda: consume(Features(corpus()).vectors()))
    timed("top_tfidf_terms", lambda: consume(catalog.top_terms(Features(corpus()))))
    timed("vocabulary_growth", lambda: consume(vocabulary.vocabulary_growth(Features(corpus()).bags)))

    def stream():
        source = stage_path(spark, "bench-arrivals")
        corpus().write.parquet(source)
        arriving = running_df.document_stream(spark, source)
        log = stage_path(spark, "bench-log")
        running_df.start_frequency_log(arriving, log, stage_path(spark, "bench-state")).awaitTermination()
        consume(running_df.snapshot(spark, log)[0])

    timed("running_df_stream", stream)
    examples = timed("training_set", lambda: experiments.labelled_examples(Features(corpus()), meta))
    names = examples.names
    tf_examples = timed("tf_training_set", lambda: experiments.labelled_examples(Features(corpus()), meta, "4/3/3", "tf"))
    trees, regressions = experiments.decision_tree_experiment, experiments.logistic_regression_experiment
    timed("naive_bayes_10_subjects", lambda: consume(experiments.naive_bayes_experiment(examples)))
    timed("decision_tree_1_subject_1_depth", lambda: consume(trees(examples.first(1), depths=(2,))))
    timed("decision_tree_10_subjects_3_depths", lambda: consume(trees(examples)))
    timed("decision_tree_tf_10_subjects_3_depths", lambda: consume(trees(tf_examples)))
    timed("logistic_regression_10_subjects", lambda: consume(regressions(examples)))
    timed("logistic_regression_tf_10_subjects", lambda: consume(regressions(tf_examples)))
    timed("logistic_regression_10_subjects_4_settings", lambda: consume(regressions(examples, experiments.REG_PARAMS)))

    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "documents": inputs.documents(spark, FOLDER).count(),
                "naive_bayes_sec_per_subject": round(seconds["naive_bayes_10_subjects"] / len(names), 3),
                "decision_tree_sec_per_subject": round(
                    seconds["decision_tree_10_subjects_3_depths"] / (len(names) * len(experiments.DEPTHS)), 3
                ),
                "logistic_regression_sec_per_subject": round(
                    seconds["logistic_regression_10_subjects"] / len(names), 3
                ),
            }
        )
    )


if __name__ == "__main__":
    main()
