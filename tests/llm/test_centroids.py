from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import folder_of
from tomeworks.llm import centroids as kmeans

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, k=16, rounds=3, dims=64, scale=64):
    """(vec_id, cluster, distance, digest) of every kept vector, in whole numbers of Python."""
    fine = lambda e: e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in e]) for i, e, *_ in rows if fine(e)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda x: (name(x[0]), x[0] is not None, x[0] or 0, x[1]))
    middle = [list(v) for _, v in order[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((away(v, c), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(middle)):
            members = [v for (_, v), c in zip(kept, of) if c == j]
            if members:
                middle[j] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    return [(i, c, d, hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest()) for i, c, d in found]


def blobs(n, dims=64, spread=0.2, centres=20, seed=1):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, dims))
    return [(i, (middle[i % centres] + spread * draw.normal(size=dims)).tolist(), 0) for i in range(n)]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_odd_rows(spark, tmp_path):
    good = blobs(60)
    some = good[0][1]
    rows = [
        *good,
        *[good[3]] * 30,  # copies
        (3, good[5][1], None),
        (None, some, 1),
        (None, some, 1),
        (70, None, 0),
        (71, [], 0),
        (72, some[:-1], 0),
        (73, [*some, 1.0], 0),
        (74, [None, *some[1:]], 0),
        (75, [float("nan"), *some[1:]], 0),
        (76, [float("-inf"), *some[1:]], 0),
        (77, [0.0] * 64, 0),
        (78, [-1e-6] * 64, 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "q": F.lit("x"), "cluster": F.lit(0)})
    got = kmeans.op11_centroids(spark, folder_of(tmp_path, spark, docs, embeddings=docs)).collect()
    expected = brute_force(rows)
    assert sorted((tuple(r)[:3] + (r.centroid_sha256,) for r in got), key=key) == sorted(expected, key=key)
    for r in got:
        assert r.cluster_inertia == sum(e[2] for e in expected if e[1] == r.cluster)
        assert r.inertia == sum(e[2] for e in expected)


@pytest.mark.parametrize("rows", [[], [(1, [1.0] * 64, 0)], [(i, [float(i // 2)] * 64, 0) for i in range(9)]])
def test_few_vectors(spark, rows):
    found, centroids = kmeans.cluster(spark.createDataFrame(rows, SCHEMA))
    expected = sorted(e[:3] for e in brute_force(rows))
    assert sorted((r.id, r.cluster, r.distance) for r in found.collect()) == expected
    assert len(centroids) == len(rows)


def test_components_whose_distances_would_not_fit(spark):
    rows = [(1, [3e7] * 64, 0)]
    with pytest.raises(Exception, match="is beyond"):
        kmeans.cluster(spark.createDataFrame(rows, SCHEMA))


def test_ties_go_to_the_smaller_number(spark):
    # small whole numbers in few dimensions: many equal distances
    draw = random.Random(4)
    rows = [(i, [float(draw.randrange(3)) for _ in range(4)], 0) for i in range(300)]
    found, _ = kmeans.cluster(spark.createDataFrame(rows, SCHEMA), k=6, rounds=5, dims=4, scale=1)
    expected = sorted(e[:3] for e in brute_force(rows, 6, 5, 4, 1))
    assert sorted((r.id, r.cluster, r.distance) for r in found.collect()) == expected


def test_bounds_spare_most_comparisons(spark):
    rows = blobs(600, dims=8, spread=0.02, centres=6)
    found, _ = kmeans.cluster(spark.createDataFrame(rows, SCHEMA), k=6, rounds=6, dims=8, scale=1000)
    assert found.agg(F.avg("scans")).first()[0] < 3  # of 7


def test_loosening_is_safe_and_less_than_the_drift():
    draw = np.random.default_rng(2)
    spared = 0
    for n in range(300):
        dims = int(draw.integers(1, 6))
        old = draw.integers(-1000, 1000, size=(4, dims))
        new = old + draw.integers(-300, 300, size=(4, dims)) // draw.integers(1, 50)
        radius = draw.uniform(0, 1500, size=4) * draw.integers(0, 2, size=4)
        bound = kmeans.loosening(old, new, radius)
        drift = kmeans.lengths_of(new - old)
        for i in range(4):
            others = [j for j in range(4) if j != i]
            assert bound[i] <= drift[others].max() + 1e-9
            spared += bound[i] < drift[others].max() * 0.9
            way = draw.normal(size=(400, dims))
            way /= np.linalg.norm(way, axis=1, keepdims=True)
            inside = old[i] + way * radius[i] * draw.uniform(0.0, 1, size=(400, 1)) ** draw.integers(0, 2)
            for j in others:
                nearer = np.linalg.norm(inside - old[j], axis=1) - np.linalg.norm(inside - new[j], axis=1)
                assert nearer.max() <= bound[i] + 1e-9
    assert spared > 300


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = kmeans.op11_centroids(spark, folder).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == sorted(brute_force(rows))
