"""Centroid clustering in whole numbers, with geometric drift tightening.

Vectors become integers, so distances, sums and ties are exact whatever the
order of the rows.  Every vector keeps its cluster, an upper bound on the
distance to its own centroid and a lower bound on the distance to every other.
When centroids move, the upper bound grows by the drift of its own.  The lower
bound shrinks by what the geometry allows, not by the full drift of the farthest
mover: all vectors of a cluster lie in a ball around its old centroid, whose
radius is their greatest upper bound.  For another centroid moving from a to b,
a point that is seen from the middle of the move at an angle t from its
direction comes nearer by less than |ab| cos t, and not at all beyond a right
angle.  In the plane of a, b and the ball's centre, the ball spans the
angles asin(radius / distance) to both sides of its centre.  So no vector of
the ball comes nearer than |ab| times the cosine of the least angle it spans;
only when the middle of the move lies in the ball is that the full drift.

A vector whose upper bound is below its lower bound keeps its cluster.
Otherwise the distance to its own centroid is computed, and if that does not
decide, it is compared with all centroids exactly; ties go to the smaller number.

The driver holds the centroids: k rows.  Each round reads and writes one narrow
stage table and exchanges k sums a task.  A cluster may hold any share of the rows.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite;
``floor(scale * x)`` must be within 2^27, or the job fails with that message
(a squared distance would not fit a long).  Repeated rows are vectors of their own.
Fewer vectors than ``k`` give as many centroids; a null id hashes like an empty
one; equal hashes are ordered by id, then by components.  An empty table gives
an empty result.  Columns besides id and vector are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import query
from tomeworks.sources.tables import read_table
from tomeworks.staging import stage

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
_LARGEST = 1 << 27
# Bounds are doubles: each is moved outwards by more than the rounding of its computation.
_OUT, _IN = 1 + 1e-12, 1 - 1e-12
_ROWS = 8192  # compared at a time

_STATE = "id bigint, q array<int>, cluster int, upper double, lower double, scans int"
_STATE_TYPE = pa.schema(
    [
        ("id", pa.int64()),
        ("q", pa.list_(pa.int32())),
        ("cluster", pa.int32()),
        ("upper", pa.float64()),
        ("lower", pa.float64()),
        ("scans", pa.int32()),
    ]
)


def whole_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """(id, q): the kept vectors as integers."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    steps = F.transform(x, lambda v: v.cast("double") * scale)
    fits = F.forall(steps, lambda v: F.floor(v).between(-_LARGEST, _LARGEST))
    too_large = F.raise_error(F.lit(f"floor({scale} * x) of a component is beyond {_LARGEST}"))
    whole = F.when(fits, F.transform(steps, lambda v: F.floor(v).cast("int"))).otherwise(too_large)
    # size before contents: the conditions of a filter may be evaluated in any order, these not
    kept = F.when(F.size(x) == dims, finite).otherwise(F.lit(False))
    return vectors.where(kept).select(F.col(id_column).cast("bigint").alias("id"), whole.alias("q"))


def first_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors of smallest hash, by hash."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = points.orderBy(name, "id", "q").limit(k).select("q").collect()
    return np.array([r["q"] for r in rows], dtype=np.int64)


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact; one column a centroid."""
    out = np.empty((len(points), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        away = points - centroid
        np.einsum("ij,ij->i", away, away, out=out[:, j])
    return out


def lengths_of(moves: np.ndarray) -> np.ndarray:
    """Lengths of whole-number vectors along the last axis, rounded up."""
    return np.sqrt((moves * moves).sum(-1).astype(np.float64)) * _OUT


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much the distance to the nearest other centroid may have shrunk, for each cluster.

    ``radius``: of the ball around the old centroid that holds the cluster.
    """
    k = len(old)
    # twice the way from the middle of each move to each centre, and the moves; exact, then as floats
    away = (2 * old[:, None] - (old + new)[None]).astype(np.float64)
    move = (new - old)[None].astype(np.float64)
    drift = lengths_of(new - old)
    distance = np.sqrt((away * away).sum(-1)) / 2
    along = (away * move).sum(-1) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.clip(along / (distance * drift[None]), -1, 1)
        spread = np.arcsin(np.clip(radius[:, None] / distance, 0, 1))
    # rounding moves a cosine by some 1e-14, an angle by less than 1e-6
    least_angle = np.arccos(np.nan_to_num(cosine, nan=1.0)) - np.nan_to_num(spread, nan=math.pi) - 1e-6
    nearer = drift[None] * np.clip(np.cos(np.clip(least_angle, 0, math.pi)), 0, 1) * _OUT
    nearer = np.where(distance <= radius[:, None] * _OUT, drift[None], nearer)
    nearer[np.arange(k), np.arange(k)] = 0  # its own centroid is not another
    return nearer.max(axis=1) if k > 1 else np.zeros(k)


def scan(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equals), the bound above its distance and the bound below the others'."""
    squared = squared_distances(points, centroids)
    nearest = squared.argmin(axis=1)
    rows = np.arange(len(points))
    own = squared[rows, nearest]
    if len(centroids) == 1:
        second = np.full(len(points), np.inf)
    else:
        squared[rows, nearest] = np.iinfo(np.int64).max
        second = np.sqrt(squared.min(axis=1).astype(np.float64))
    return nearest, np.sqrt(own.astype(np.float64)) * _OUT, second * _IN


def reassigned(points, cluster, upper, lower, scans, centroids, drift, loosened):
    """The state after the centroids moved; ``points`` int64."""
    upper = (upper + drift[cluster]) * _OUT
    lower = (lower - loosened[cluster]) - 1e-12 * np.abs(lower)
    open_ = np.flatnonzero(upper >= lower)
    if len(open_):
        away = points[open_] - centroids[cluster[open_]]
        upper[open_] = np.sqrt(np.einsum("ij,ij->i", away, away).astype(np.float64)) * _OUT
        open_ = open_[upper[open_] >= lower[open_]]
    if len(open_):
        cluster[open_], upper[open_], lower[open_] = scan(points[open_], centroids)
        scans[open_] += 1
    return cluster, upper, lower, scans


def _points(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(1).flatten().to_numpy().reshape(len(batch), dims).astype(np.int64)


def _state(batch: pa.RecordBatch, cluster, upper, lower, scans) -> pa.RecordBatch:
    made = [pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), pa.array(scans, pa.int32())]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], schema=_STATE_TYPE)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), _ROWS):
            yield batch.slice(at, _ROWS)


def _first(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector compared with every centroid."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            found = scan(_points(batch, centroids.shape[1]), centroids)
            yield _state(batch, *found, np.ones(len(batch), np.int32))

    return points.mapInArrow(assign, _STATE)


def _next(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, loosened: np.ndarray) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            before = [batch.column(i).to_numpy().copy() for i in range(2, 6)]
            yield _state(batch, *reassigned(_points(batch, centroids.shape[1]), *before, centroids, drift, loosened))

    return state.mapInArrow(assign, _STATE)


def _moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New centroids, and the radius of the ball around each old one that holds its cluster."""
    dims = centroids.shape[1]
    sums = [F.sum(F.get("q", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(dims)]
    rows = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius"), *sums).collect()
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for row in rows:  # at most k
        new[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
        radius[row["cluster"]] = row["radius"]
    return new, radius


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(id, q, cluster, distance, scans) of every kept vector, and the final centroids.

    ``distance`` is squared; ``scans`` counts how often all centroids were compared.
    """
    points = stage(whole_vectors(vectors, id_column, vector_column, dims, scale), "vectors")
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        empty = points.selectExpr("id", "q", "0 AS cluster", "0L AS distance", "0 AS scans")
        return empty, centroids
    state = stage(_first(points, centroids), "assigned")
    for _ in range(rounds):
        moved, radius = _moved(state, centroids)
        state = _next(state, moved, lengths_of(moved - centroids), loosening(centroids, moved, radius))
        state, centroids = stage(state, "assigned"), moved

    own = F.element_at(F.lit(centroids.tolist()).cast("array<array<bigint>>"), F.col("cluster") + 1)
    gaps = F.zip_with("q", own, lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return state.select("id", "q", "cluster", distance.alias("distance"), "scans"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


@query
def op11_centroids(spark, folder):
    """Every kept vector with its cluster, squared distance, inertias and the digest of its centroid."""
    found, centroids = cluster(read_table(spark, folder, "embeddings"))
    found = stage(found.drop("q"), "clusters")
    rows = found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # at most k
    inertia = {r["cluster"]: r["inertia"] for r in rows}

    def of_cluster(values: dict[int, object], kind: str) -> Column:
        chosen = F.lit(None).cast(kind)
        for number, value in values.items():
            chosen = F.when(F.col("cluster") == number, F.lit(value)).otherwise(chosen)
        return chosen.cast(kind)

    return found.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        of_cluster(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of_cluster({i: centroid_digest(c) for i, c in enumerate(centroids)}, "string").alias("centroid_sha256"),
    )


def _sql() -> str:
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id NULLS FIRST, v) - 1 AS r,
         vec_id, v
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = {DIMS}
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
)""",
        "parts AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)",
        f"c0 AS MATERIALIZED (SELECT r AS c, i, x FROM parts WHERE r < {CLUSTERS})",
    ]
    for step in range(ROUNDS + 1):
        parts.append(f"""a{step} AS MATERIALIZED (
  SELECT r, c, d FROM (
    SELECT p.r, c.c, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{step} c USING (i) GROUP BY ALL
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if step < ROUNDS:
            parts.append(f"""c{step + 1} AS MATERIALIZED (
  SELECT c.c, c.i, coalesce((m.s - (m.s % m.n + m.n) % m.n) // m.n, c.x) AS x
  FROM c{step} c LEFT JOIN (
    SELECT a.c, p.i, sum(p.x) AS s, count(*) AS n FROM a{step} a JOIN parts p USING (r) GROUP BY ALL
  ) m USING (c, i)
)""")
    return f"""WITH {", ".join(parts)},
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS digest FROM c{ROUNDS} GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, g.digest AS centroid_sha256
FROM a{ROUNDS} a JOIN kept k USING (r) JOIN digest g USING (c)"""


SQL = _sql()
