"""Every query against its SQL, at the smallest scale."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracles import TABLES, canonical

# Swept by test_models already; slow here.
SLOW = {
    "m11_decision_tree_sweep", "m11_decision_tree_tf_sweep", "m12_logistic_regression",
    "m13_logistic_regression_sweep", "m13_logistic_regression_tf_sweep",
}
# Checked against brute force in tests/llm, where there is no SQL.
BRUTE = {name for name in contract.queries() if name == "pipeline" or re.match(r"op\d+_", name)}
# Learned or hashed values that SQL does not give: compared with numpy, spark.ml or another hash library in
# test_trees, test_gradient_regression and test_models.
BRUTE |= {
    "m5_hash_vectors_fast", "w1_hashed_folds", "m10_tree_nodes", "m11_tree_accuracies", "m11_tree_tf_accuracies",
    "m12_regression_accuracies", "m12_gradient_embedding_coefficients", "m13_gradient_sweep",
}
QUERIES = {name: q for name, q in contract.queries().items() if name not in BRUTE}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, folder, db, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    result = df.toPandas()
    assert len(result) > 0
    if name in ORACLES:
        expected = db.execute(ORACLES[name]).fetch_df()
        assert canonical(result).equals(canonical(expected))


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["doc_id", "term", "tfidf", "rank"]
    assert df.count() > 0
