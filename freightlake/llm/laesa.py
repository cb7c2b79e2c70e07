"""Centroid clustering (Lloyd rounds) with a LAESA pivot table.

Vectors become integers, floor(scale * x).  A few fixed pivots are chosen among
the starting centroids, farthest first; the distances of every vector to them
are computed once and stored beside it.  In each round the distances of the
centroids to the pivots give, by the triangle inequality, a lower bound of the
distance of every vector to every centroid:
``max over pivots |d(vector, pivot) - d(centroid, pivot)|``.  The centroid with the
least bound gets its exact integer distance first; then only centroids whose bound
does not exceed the best distance so far get theirs.  The bounds are widened by
more than a float's rounding, so no nearest centroid and no tie is lost, and the
result is that of comparing every vector with every centroid.

Defined results: a vector is kept if it has exactly ``dims`` components, none NULL
or non-finite, and all below 2^26 in size after scaling (so that squared distances
fit a long); others give no row.  Starting centroids are the kept vectors with the
least sha-256 of ``prefix`` and id; repeated ids are ordered by their components,
NULL ids come last.  Repeated rows are rows of their own, with equal results.
Fewer kept vectors than ``k`` give as many centroids; an empty table gives an empty
result; other columns are not read, whatever their names.

At scale: the table with pivot distances is written once to the shared folder and
read by every round.  A task sums its vectors by centroid, so a round shuffles at
most ``k`` rows for each task and the driver gets ``k`` rows of ``dims`` sums; a
centroid that holds a third of all vectors is one such row for each task.  Batches
are bounded in rows.  Centroids travel in the tasks' closure (``k * dims`` numbers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import python_workers, stage

LARGEST = 1 << 26
BATCH = 4096


class Found(NamedTuple):
    """Numbers of the nearest centroids, squared distances, and how many exact distances were computed."""

    who: np.ndarray
    distance: np.ndarray
    compared: int


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def farthest_first(c: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``c``: the first, then always the one farthest from those chosen."""
    chosen = [0]
    left = squared(c, c[0])
    while len(chosen) < min(n, len(c)):
        chosen.append(int(left.argmax()))
        left = np.minimum(left, squared(c, c[chosen[-1]]))
    return c[chosen]


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(x, p).astype(np.float64)) for p in pivots], axis=1)


def nearest(x: np.ndarray, near: np.ndarray, c: np.ndarray, c_near: np.ndarray) -> Found:
    """The nearest of the centroids ``c`` for each row of ``x`` (ties: the smaller
    number); ``near`` and ``c_near`` are distances to the pivots."""
    lower = np.zeros((len(c), len(x)))
    for p in range(near.shape[1]):
        np.maximum(lower, np.abs(c_near[:, p, None] - near[None, :, p]), out=lower)
    who = lower.argmin(axis=0)
    first = who.copy()
    best = squared(x, c[who])
    compared = len(x)
    for j in range(len(c)):
        rows = np.flatnonzero((lower[j] <= np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + 1e-3) & (first != j))
        compared += len(rows)
        d = squared(x[rows], c[j])
        closer = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
        best[rows[closer]], who[rows[closer]] = d[closer], j
    return Found(who, best, compared)


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x) of the kept vectors; x holds integers."""
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(scale * e) < LARGEST)), F.lit(False))
    return (v.where((F.size("v") == dims) & sound)
            .select("id", F.transform("v", lambda e: F.floor(scale * e).cast("int")).alias("x")))


def pivot_table(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points`` with ``near``, the distances to the pivots; written once."""
    kind, dims = points.schema["id"].dataType.simpleString(), pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = to_pivots(_matrix(b.column("x"), dims, np.int64), pivots) if b.num_rows else np.empty((0, len(pivots)))
            flat = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * len(pivots), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, flat], names=["id", "x", "near"])

    return stage(points.mapInArrow(run, f"id {kind}, x array<int>, near array<double>"), "pivots")


def _assigned(batch: pa.RecordBatch, c: np.ndarray, c_near: np.ndarray) -> tuple[np.ndarray, Found]:
    x = _matrix(batch.column("x"), c.shape[1], np.int64)
    return x, nearest(x, _matrix(batch.column("near"), c_near.shape[1], np.float64), c, c_near)


def moved(table: DataFrame, c: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means of what is nearest to them."""
    c_near, dims = to_pivots(c, pivots), c.shape[1]
    names = ["n", *(f"s{i}" for i in range(dims))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64)
        for b in batches:
            if b.num_rows:
                x, found = _assigned(b, c, c_near)
                order = np.argsort(found.who, kind="stable")
                own, at = np.unique(found.who[order], return_index=True)
                sums[own] += np.add.reduceat(x[order], at, axis=0)
                n += np.bincount(found.who, minlength=len(c))
        rows = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(n[rows]), *(pa.array(sums[rows, i]) for i in range(dims))],
            names=["cluster", *names])

    parts = table.mapInArrow(run, ", ".join(["cluster int", *(f"{x} long" for x in names)]))
    out = c.copy()
    for r in parts.groupBy("cluster").agg(*(F.sum(x).alias(x) for x in names)).collect():  # at most k rows
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 40,
            rounds: int = 5, scale: int = 256, prefix: str = "2:", n_pivots: int = 12) -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 for each kept vector."""
    spark = vectors.sparkSession
    python_workers(spark, BATCH)
    points = quantised(vectors, id_col, vec_col, dims, scale)
    order = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256).asc_nulls_last()
    start = points.orderBy(order, "x").limit(k).collect()
    kind = points.schema["id"].dataType.simpleString()
    if not start:
        return points.selectExpr(f"id AS `{id_col}`", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia",
                                 "0L AS inertia", "'' AS centroid_sha256").limit(0)
    c = np.array([r.x for r in start], dtype=np.int64)
    pivots = farthest_first(c, n_pivots)
    table = pivot_table(points, pivots)
    for _ in range(rounds):
        c = moved(table, c, pivots)
    c_near = to_pivots(c, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, found = _assigned(b, c, c_near)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(found.who.astype(np.int32)), pa.array(found.distance)], names=["id", "cluster", "distance"])

    last = stage(table.mapInArrow(run, f"id {kind}, cluster int, distance long"), "assigned")
    digests = [(j, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for j, row in enumerate(c.tolist())]
    sums = (last.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
            .join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster"))  # k rows
    total = last.agg(F.sum("distance")).first()[0]
    return (last.join(F.broadcast(sums), "cluster")
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"),
                    "centroid_sha256"))


def oracle(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """DuckDB: every vector against every centroid, round by round."""
    far = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e::DOUBLE))) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM kept ORDER BY sha256('2:' || vec_id) LIMIT {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, x, b[2] AS c, b[1] AS d FROM (
    SELECT p.vec_id, any_value(p.x) AS x, min([{far}, c.c]) AS b FROM kept p, c{r} c GROUP BY p.vec_id))""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS x FROM (
    SELECT c, i, sum(e) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, unnest(range({dims})) AS i FROM a{r}) GROUP BY c, i)
  GROUP BY c
  UNION ALL SELECT c, x FROM c{r} WHERE c NOT IN (SELECT c FROM a{r}))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"""
