"""Numbering, lookups, vocabulary, audit and plans."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tomeworks.operators import audit, boilerplate, eligibility, folds
from tomeworks.operators.lookup import keyed_lookup
from tomeworks.operators.ordering import dense_sequence, running_total
from tomeworks.operators.terms import term_bags, term_counts, term_frequencies
from tomeworks.operators.vocabulary import document_frequency, merge_frequencies, vocabulary_growth
from tomeworks.operators.weights import inverse_frequency
from tomeworks.plans.eligible_corpus import eligible_corpus
from tomeworks.plans.features import Features, Settings
from tomeworks.sources.tables import read_features
from tomeworks.sources import corpus
from tomeworks.staging import stage

TEXTS = ["red green blue", "red red green", "red yellow", "", "blue blue violet"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sequence_and_running_total(spark):
    keys = [(i * 7919) % 100_003 * 10**9 - 5 for i in range(3000)]
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k bigint, v bigint").repartition(16)
    got = {r["k"]: r["position"] for r in dense_sequence(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    totals = {r["k"]: r["total"] for r in running_total(df, "k", "v", "total").collect()}
    running, want = 0, {}
    for k in sorted(keys):
        running += k % 7
        want[k] = running
    assert totals == want


def test_folds(spark):
    df = spark.range(95).select(F.col("id").alias("doc_id"))
    sizes = {r["fold"]: r["n"] for r in folds.cyclic_folds(df).groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sizes == {f: 10 if f < 5 else 9 for f in range(10)}
    split = df.select(folds.split_of(F.pmod("doc_id", F.lit(10)), "7/2/1").alias("split"))
    assert {r["split"]: r["n_docs"] for r in folds.split_sizes(split).collect()} == {
        "train": sum(1 for i in range(95) if i % 10 < 7),
        "test": sum(1 for i in range(95) if i % 10 in (7, 8)),
        "validate": sum(1 for i in range(95) if i % 10 == 9),
    }
    hashed = df.select(folds.hashed_fold(F.col("doc_id")).alias("fold"))
    assert hashed.where("fold between 0 and 9").count() == 95


@pytest.mark.parametrize("limit", [0, 1, 3, 50, 10**6])
def test_document_cap(spark, limit):
    df = spark.range(100).select((F.col("id") * 3).alias("doc_id"))
    got = sorted(r["doc_id"] for r in eligibility.first_documents(df, limit).collect())
    assert got == [i * 3 for i in range(100)][: limit or None]


def test_document_cap_with_null_and_repeated_keys(spark):
    rows = [(None, "a"), (None, "b"), (5, "x/5"), (5, "y/5"), (2, "z/2"), (9, "w/9")]
    df = spark.createDataFrame(rows, "doc_id bigint, path string")
    got = eligibility.first_documents(df, 2, "doc_id", "path").collect()
    assert sorted(map(tuple, got)) == [(2, "z/2"), (5, "x/5")]


def book(number, body):
    return f"Title [EBook #{number}]\n*** START OF X ***\n{body}\n*** END OF THIS X ***\nlegal"


def test_eligible_corpus_keeps_each_book_once(spark, tmp_path):
    """File names share digits or have none; the id comes from the text."""
    names = {
        "10.txt": book(10, "ten"),
        "truck10.txt": book(110, "truck"),
        "10136.txt": book(10136, "long number"),
        "1013-6.txt": book(6, "other"),
        "readme.txt": book(44, "no digits in the name"),
        "again.txt": book(44, "a second copy"),
        "none.txt": "no id here",
        "unknown.txt": book(999, "no metadata"),
        "big.txt": book(45, "excluded"),
        "huge.txt": book("9" * 30, "beyond the numbers"),
    }
    (tmp_path / "deep").mkdir()
    for name, text in names.items():
        (tmp_path / "deep" / name).write_text(text)
    files = corpus.text_documents(spark, str(tmp_path))
    keys = ["10", "110", "10136", "6", "44", "45", "9" * 30]
    metadata = spark.createDataFrame([(k,) for k in keys], "doc_key string")
    exclusions = spark.createDataFrame([("big.txt",)], "file string")
    docs = eligible_corpus(files, metadata, exclusions)
    assert sorted((r["doc_id"], r["text"].strip()) for r in docs.collect()) == [
        (6, "other"), (10, "ten"), (44, "a second copy"), (110, "truck"), (10136, "long number"),
    ]
    capped = eligible_corpus(files, metadata, exclusions, stop_after=3)
    assert sorted(r["doc_id"] for r in capped.collect()) == [6, 10, 44]
    assert Features(docs).n_docs.first()["n_docs"] == 5


@pytest.mark.parametrize("limit", [0, 10_000, 10**9])
def test_lookup_is_the_same_join_at_any_limit(spark, limit):
    """One key holds a third of all rows."""
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot" * 200).otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("key")
    )
    keys = facts.groupBy("key").agg(F.count("*").alias("n")).where("key <> 'k7'")
    facts, keys = stage(facts, "facts"), stage(keys, "keys")
    joined = keyed_lookup(facts, keys, "key", "n", broadcast_bytes=limit)
    assert joined.columns == ["key", "id", "n"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, facts.join(keys, "key").collect()))


def test_lookup_broadcasts_frequent_keys_and_shuffles_the_rest(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key")
    )
    keys = facts.groupBy("key").agg(F.count("*").alias("n"))
    facts, keys = stage(facts, "facts"), stage(keys, "keys")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keyed_lookup(facts, keys, "key", "n", broadcast_bytes=100_000)
        plan = plan_of(joined)
        # the frequent keys, once to take their rows and once to leave them out
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
        assert joined.count() == 3000 and joined.where("key = 'hot'").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_frequencies_and_idf(docs):
    features = Features(docs)
    want = Counter(t for text in TEXTS for t in set(text.split()))
    rows = {r["term"]: r for r in features.idf.collect()}
    assert {t: r["df"] for t, r in rows.items()} == want
    for t, r in rows.items():
        assert r["idf"] == pytest.approx(math.log(4 / want[t]))
    plain = inverse_frequency(document_frequency(features.bags), features.n_docs, log=False)
    assert {r["term"]: r["idf"] for r in plain.collect()} == {t: 4 / n for t, n in want.items()}
    assert features.n_docs.first()["n_docs"] == 4


def test_two_documents_are_not_smoothed(spark):
    two = spark.createDataFrame([(1, "common rare"), (2, "common")], "doc_id bigint, text string")
    idf = {r["term"]: r["idf"] for r in Features(two).idf.collect()}
    assert idf == {"common": 0.0, "rare": pytest.approx(0.693147, abs=1e-6)}


@pytest.mark.parametrize("limit", [0, 64 * 1024 * 1024])
def test_tfidf_and_vectors(docs, limit):
    features = Features(docs, Settings(buckets=7, broadcast_bytes=limit))
    got = {(r["doc_id"], r["term"]): r["tfidf"] for r in features.tfidf.collect()}
    df = Counter(t for text in TEXTS for t in set(text.split()))
    want = {}
    for i, text in enumerate(TEXTS):
        counts = Counter(text.split())
        for t, n in counts.items():
            want[i, t] = n / max(counts.values()) * math.log(4 / df[t])
    assert got == pytest.approx(want)
    # hashing loses no weight
    per_doc = {r["doc_id"]: sum(e["w"] for e in r["vec"]) for r in features.vectors().collect()}
    sums = Counter()
    for (i, _), w in want.items():
        sums[i] += w
    assert per_doc == pytest.approx(dict(sums))
    for r in features.vectors().collect():
        assert [e["bucket"] for e in r["vec"]] == sorted({e["bucket"] for e in r["vec"]})


def test_merge_and_growth(docs):
    bags = stage(term_bags(docs), "bags")
    halves = [document_frequency(bags.where(F.col("doc_id") % 2 == h)) for h in (0, 1)]
    assert sorted(merge_frequencies(*halves).collect()) == sorted(document_frequency(bags).collect())
    seen, want = set(), []
    for i, text in enumerate(TEXTS):
        words = set(text.split())
        if words:
            new = words - seen
            seen |= words
            want.append((i, len(words), len(words) - len(new), len(new), len(seen)))
    got = [tuple(r) for r in vocabulary_growth(bags).orderBy("doc_id").collect()]
    assert got == want


def test_saved_features(docs, spark, tmp_path):
    subjects = spark.createDataFrame([(i, ["s"]) for i in range(4)], "doc_id bigint, subjects array<string>")
    features, folder = Features(docs), str(tmp_path)
    features.save(folder, subjects)
    manifest = spark.read.parquet(f"{folder}/manifest").orderBy("doc_id").collect()
    # document 3 has no terms and document 4 no metadata; folds leave no gap
    assert [(r["doc_id"], r["fold"]) for r in manifest] == [(0, 0), (1, 1), (2, 2)]
    vectors = read_features(spark, f"{folder}/vectors", folds=[1, 2])
    assert sorted(r["doc_id"] for r in vectors.collect()) == [1, 2]
    assert spark.read.parquet(f"{folder}/idf").count() == spark.read.parquet(f"{folder}/df").count() == 5
    assert spark.read.parquet(f"{folder}/tf").count() == features.tf.count()
    stats = {r["doc_id"]: r["n_words"] for r in features.vector_stats(features.manifest(subjects)).collect()}
    assert stats == {0: 3, 1: 2, 2: 2}


def test_cap_before_or_after_the_header_test(spark):
    texts = ["no header", "*** START x\nalpha", "*** START x\nbeta", "*** START x\ngamma"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    after = Features(df, Settings(strip=True, stop_after=2))
    before = Features(df, Settings(strip=True, stop_after=2, cap_before_header_test=True))
    assert sorted(r["doc_id"] for r in after.bodies.collect()) == [1, 2]
    assert sorted(r["doc_id"] for r in before.bodies.collect()) == [1]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_statuses(spark, limit):
    rows = [(i, "popular" if i % 3 == 0 else f"id{i % 50}") for i in range(300)]
    rows += [(300 + i, "unknown" if i % 2 else None) for i in range(20)]
    files = stage(spark.createDataFrame(rows, "seq bigint, doc_key string"), "files")
    meta = spark.createDataFrame([("popular",)] + [(f"id{i}",) for i in range(40)], "doc_key string")
    known, seen, want = {"popular"} | {f"id{i}" for i in range(40)}, set(), {}
    for seq, key in rows:
        if key is None:
            want[seq] = "MISSING_ID"
        elif key in seen:
            want[seq] = "DUPLICATE"
        elif key not in known:
            want[seq] = "NO_META"
        else:
            want[seq] = "GOOD"
            seen.add(key)
    statuses = audit.file_statuses(files, meta, broadcast_bytes=limit)
    assert {r["seq"]: r["status"] for r in statuses.collect()} == want
    totals = audit.audit_totals(statuses).first()
    counts = Counter(want.values())
    assert (totals["files"], totals["duplicates"]) == (320, counts["DUPLICATE"])
    assert (totals["no_id"], totals["no_meta"]) == (counts["MISSING_ID"], counts["NO_META"])
    good = [s for s in sorted(want) if want[s] == "GOOD"]
    with_folds = {r["seq"]: r["fold"] for r in audit.with_audit_folds(stage(statuses, "s")).collect()}
    assert with_folds == {s: good.index(s) % 10 if s in good else None for s in want}


def test_listed_once(spark):
    files = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",), ("d.txt",)], "file string")
    statuses = spark.createDataFrame(
        [("a.txt", "GOOD"), ("b.txt", "GOOD"), ("b.txt", "GOOD"), ("c.txt", "NO_META")], "file string, status string"
    )
    assert [r["file"] for r in eligibility.good_files(files, statuses).collect()] == ["a.txt"]
    excluded = spark.createDataFrame([("a.txt",), ("a.txt",)], "file string")
    kept = eligibility.without_excluded(files, excluded).collect()
    assert sorted(r["file"] for r in kept) == ["b.txt", "c.txt", "d.txt"]


def test_counting_terms_needs_no_shuffle(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plan = plan_of(term_frequencies(term_bags(boilerplate.strip_boilerplate(docs))))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    # filters on the result do not move below it and double the work
    plan = plan_of(term_counts(term_bags(docs).where(F.col("max_n").isNotNull())).where("term = 'the'"))
    assert plan.count("regexp_extract_all") == 1


def test_document_frequency_shuffles_counts_once(spark, folder):
    bags = stage(term_bags(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")), "bags")
    plan = plan_of(document_frequency(bags))
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<terms:array<struct<term:string>>>" in plan
