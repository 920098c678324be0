"""Tokens, terms and per-document counts against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomeworks.functions import hashing, text
from tomeworks.operators import terms as term_operators
from tomeworks.operators.terms import term_bags, term_counts, term_frequencies


def python_terms(document: str) -> list[str]:
    kept = []
    for token in re.split(r"\W+", document, flags=re.ASCII):
        token = re.sub("[.,;_]", "", token.lower())
        if re.sub("[0-9.]", "", token) in ("th", "st"):
            continue
        if len(token) > 2 and not re.fullmatch("[0-9]+", token):
            kept.append(token)
    return kept


CASES = {
    "accents split": ("Über naïve café", ["ber", "caf"]),
    "underscore": ("foo_bar _x_ a_b", ["foobar"]),
    "ordinals": ("19th 1st 22nd 3rd th st 1t2h", ["22nd", "3rd"]),
    "numbers": ("1234 12a 007", ["12a"]),
    "short": ("a an the of to", ["the"]),
    "case": ("The THE tHe", ["the", "the", "the"]),
    "kelvin sign is a separator": ("abKcd kelvin", ["kelvin"]),
    "punctuation": ("one,two;three.four", ["one", "two", "three", "four"]),
    "lines": ("first\nsecond\n\nthird", ["first", "second", "third"]),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", CASES)
def test_terms(spark, name):
    document, expected = CASES[name]
    assert python_terms(document) == expected
    df = spark.createDataFrame([(document,)], "text string")
    assert df.select(text.terms(F.col("text")).alias("t")).first()["t"] == expected


def test_single_steps(spark):
    df = spark.createDataFrame([("Foo_Bar;x",)], "t string")
    row = df.select(
        text.split_words(F.col("t")).alias("words"),
        text.fold_case(F.col("t")).alias("lower"),
        text.strip_marks(F.col("t")).alias("bare"),
        text.is_ordinal(F.lit("19th")).alias("ordinal"),
        text.is_ordinal(F.lit("22nd")).alias("not_ordinal"),
        text.is_number(F.lit("12")).alias("number"),
        text.is_function_word(F.lit("the")).alias("function_word"),
    ).first()
    assert row["words"] == ["Foo_Bar", "x"]
    assert row["lower"] == "foo_bar;x"
    assert row["bare"] == "FooBarx"
    assert row["ordinal"] and not row["not_ordinal"] and row["number"] and row["function_word"]


def check_documents(spark, documents: list[str]) -> None:
    rows = list(enumerate(documents))
    bags = term_bags(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {(r["doc_id"], r["term"]): r["n"] for r in term_counts(bags).collect()}
    want = {(i, t): n for i, d in rows for t, n in Counter(python_terms(d)).items()}
    assert got == want
    for r in term_frequencies(bags).collect():
        largest = max(n for (i, _), n in want.items() if i == r["doc_id"])
        assert r["tf"] == r["n"] / largest
    sizes = {r["doc_id"]: (len(r["terms"]), r["max_n"]) for r in bags.collect()}
    for i, d in rows:
        counts = Counter(python_terms(d))
        assert sizes[i] == (len(counts), max(counts.values(), default=None))


def test_bags_of_cases(spark):
    check_documents(spark, [d for d, _ in CASES.values()] + ["aaa bbb aaa ccc bbb aaa", "zzz", "one one"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aabbTHst_01é .\n", max_size=80), min_size=1, max_size=20))
def test_bags_of_random_documents(spark, documents):
    check_documents(spark, documents)


def test_tf_is_one_at_most_and_once_at_least(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    tf = term_frequencies(term_bags(docs)).groupBy("doc_id").agg(F.max("tf").alias("hi"), F.min("tf").alias("lo"))
    assert tf.where("hi <> 1.0 or lo <= 0").count() == 0


def plain_string_hash(data):
    """Python integers, cut to 64 bits."""
    h = data[0] << 7 if data else 0
    for byte in data:
        h = (h * 1000003 ^ byte) % 2**64
    h ^= len(data)
    h -= 2**64 if h >= 2**63 else 0
    return -2 if h == -1 else h


def test_string_hash(spark):
    texts = ["", "a", "b", "abc", "hello world", "Äpfel und Öl", "日本語", "\U0001f600", "x\x00y", "\x00", "z" * 300]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select(
        "t", hashing.string_hash(F.col("t")).alias("h"), hashing.string_bucket(F.col("t"), 100).alias("b")
    )
    got = {r.t: (r.h, r.b) for r in rows.collect()}
    assert got.pop(None) == (None, None)
    assert got == {t: (plain_string_hash(t.encode()), plain_string_hash(t.encode()) % 100) for t in texts}
    # fixed values, as printed by such a Python
    assert got["a"][0] == 12416037344 and got[""][0] == 0


def test_bags_are_counted_some_documents_at_a_time(spark, monkeypatch):
    rows = [(1, "b a_a aaa the THE 1st 1sts 22 222 t2h"), (2, None), (None, ""), (4, "xyz " * 50), (4, "_ __ ___ é")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    plan = term_bags(docs)._jdf.queryExecution().executedPlan().toString()
    # no expression is evaluated token by token
    assert "MapInArrow" in plan and "sort_array" not in plan and "transform(" not in plan
    got = [(r["doc_id"], r["terms"] and [tuple(t) for t in r["terms"]], r["max_n"]) for r in term_bags(docs).collect()]
    assert got == [
        (1, [("1sts", 1), ("aaa", 1), ("the", 2)], 2), (2, None, None), (None, [], None), (4, [("xyz", 50)], 50), (4, [], None)
    ]
    batch = pa.RecordBatch.from_pydict({"_runs": ["aaa bbb", None, "", "ccc " * 9, "ddd"]})
    monkeypatch.setattr(term_operators, "_AT_ONCE", 8)
    parts = list(term_operators._parts(batch, "_runs"))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) > 2
    whole = term_operators._counted(batch, "_runs")[0].to_pylist()
    assert [x for p in parts for x in term_operators._counted(p, "_runs")[0].to_pylist()] == whole
