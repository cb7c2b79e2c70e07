import hashlib
import math

import numpy as np

from freightlake.llm import laesa

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=40, rounds=5, dims=64):
    """Plain Lloyd rounds with Python integers."""
    kept = [(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(256 * x) < 2**26 for x in v)]
    if not kept:
        return []

    def order(r):
        return (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    centres = [x for _, x in sorted(kept, key=order)[:k]]

    def assigned():
        m = np.array(centres, dtype=object)
        out = []
        for _, x in kept:
            d = ((m - np.array(x, dtype=object)) ** 2).sum(axis=1)
            j = min(range(len(centres)), key=lambda j: (d[j], j))
            out.append((j, int(d[j])))
        return out

    for _ in range(rounds):
        own = assigned()
        for j in range(len(centres)):
            mine = [x for (_, x), (c, _) in zip(kept, own, strict=True) if c == j]
            if mine:
                centres[j] = tuple(sum(col) // len(mine) for col in zip(*mine, strict=True))
    own = assigned()
    inertia = {j: sum(d for c, d in own if c == j) for j in range(len(centres))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(kept, own, strict=True)), key=str)


def check(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as 32-bit floats
    got = laesa.cluster(df, **more)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, **{k: v for k, v in more.items() if k != "n_pivots"})


def vectors(n, seed, spread=0.1, dims=64):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, dims)) * 0.5
    return [(i, (centres[i % 8] + draw.normal(size=dims) * spread).tolist()) for i in range(n)]


def test_equals_plain_rounds(spark):
    check(spark, vectors(400, 1))
    check(spark, vectors(200, 2, spread=2.0), k=17, rounds=3, n_pivots=5)


def test_awkward_rows(spark):
    good = vectors(60, 3)
    same = good[0][1]
    odd = [(None, same), (None, [0.5] * 64), (1000, None), (1001, []), (1002, [0.1] * 63), (1003, [0.1] * 65),
           (1004, [None] + [0.1] * 63), (1005, [float("nan")] * 64), (1006, [float("inf")] + [0.0] * 63), (1007, [-0.0] * 64),
           (1008, [3e38] * 64), (1009, [1e5] * 64), (1010, [-1e5] * 64), (0, same), (0, same), (0, good[1][1])]
    check(spark, good + odd)
    check(spark, good + [(5000 + i, same) for i in range(300)])  # a third and more in one point: ties and empty clusters
    check(spark, good[:7])  # fewer vectors than centroids
    check(spark, [(i, [0.25] * 64) for i in range(50)])  # all equal


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert laesa.cluster(none).count() == 0 and laesa.cluster(none).columns[0] == "vec_id"
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in vectors(30, 4)], "vec_id long, embedding array<double>, x string, cluster int")
    assert laesa.cluster(df.withColumnsRenamed({"vec_id": "id"}), id_col="id", k=3).count() == 30


def test_bounds_spare_distances_and_lose_none():
    draw = np.random.default_rng(5)
    c = draw.integers(-300, 300, (40, 64))
    x = c[draw.integers(0, 40, 2000)] + draw.integers(-20, 20, (2000, 64))
    p = laesa.farthest_first(c, 12)
    found = laesa.nearest(x, laesa.to_pivots(x, p), c, laesa.to_pivots(c, p))
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (found.who == d.argmin(axis=1)).all() and (found.distance == d.min(axis=1)).all()
    assert found.compared < 0.25 * d.size
