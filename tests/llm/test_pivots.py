"""Centroid clustering by pivots, against a direct form."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import types as T

from speedloom.llm import pivots

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("cluster", T.StringType()),
    T.StructField("x", T.IntegerType()), T.StructField("distance", T.LongType()),
])


def direct(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(v))) for v in x]) for i, x in rows if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    centroids = [x for _, x in order[:k]]
    distance = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    assign = lambda: [min((distance(x, c), n) for n, c in enumerate(centroids)) for _, x in kept]
    for _ in range(rounds):
        of = assign()
        for c in range(len(centroids)):
            if mine := [x for (_, x), (_, n) in zip(kept, of) if n == c]:
                centroids[c] = [sum(v) // len(mine) for v in zip(*mine)]
    of = assign()
    total = [sum(d for d, n in of if n == c) for c in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, n, d, total[n], sum(total), names[n]) for (i, _), (d, n) in zip(kept, of))


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "c", 1, 2) for i, x in rows], VECTORS)


def test_clusters_equal_the_direct_form(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) + 3 * (i % 5)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # equal vectors
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63)]
    got = sorted(map(tuple, pivots.cluster_vectors(frame(spark, rows)).collect()))
    assert got == direct(rows)


def test_few_none_and_odd_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert sorted(map(tuple, pivots.cluster_vectors(frame(spark, rows)).collect())) == direct(rows)
    assert pivots.cluster_vectors(frame(spark, [])).collect() == []
    odd = [(None, [0.5] * 64), (1, [0.0] * 64), (1, [0.0] * 64), (2, [3e38] * 64)]
    got = pivots.cluster_vectors(frame(spark, odd))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(r.distance for r in got.collect()) == [0, 0, 0, 0]


def test_bounds_spare_distances_and_lose_none():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (2000, 64)) + 4000 * rng.integers(0, 8, (2000, 1))
    centroids = x[:8].copy()
    centroids[5] = centroids[2]  # ties go to the smaller number
    p = x[:16]
    cluster, distance, measured = pivots.nearest(x, pivots.pivot_table(x, p), centroids, p)
    every = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < every.size / 2
