"""The silhouette where groups fill many tiles, against all distances."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from speedloom.operators import silhouettes


@pytest.mark.parametrize("unit", [True, False])
def test_many_tiles_and_chunks(spark, monkeypatch, unit):
    """Vectors of one norm, as embeddings have, and of many norms; a tile holds 16 groups, a block 4."""
    monkeypatch.setattr(silhouettes, "TILE_ROWS", 16)
    rng = random.Random(3)
    x = np.array([[rng.gauss(0, 1) for _ in range(5)] for _ in range(600)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    if not unit:
        x *= np.array([[rng.uniform(1, 30)] for _ in range(600)])
    g = np.array([i // 3 if i > 40 else i for i in range(600)])  # groups of one and more
    df = spark.createDataFrame([(i, v.tolist(), f"g{k}") for i, (v, k) in enumerate(zip(x, g))], "i int, x array<double>, g string")
    all_pairs = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    want = {}
    for i in range(600):
        mean = {k: all_pairs[i][g == k].mean() for k in set(g.tolist())}
        n, a = (g == g[i]).sum(), mean.pop(int(g[i]))
        a, b = a * n / max(n - 1, 1), min(mean.values())
        want[i] = 0.0 if n == 1 else (b - a) / max(a, b)
    got = {r.i: r.silhouette for r in silhouettes.silhouette_values(df, "x", "g", block_groups=4).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_rows_follow_points_and_groups_not_their_product(spark):
    """4,000 vectors in 2,000 groups of about one norm: a point meets a tile in one row and not each group in a row of its own."""
    points = spark.range(4000).select(F.col("id").alias("i"), (F.col("id") % 2000).alias("g"), F.array(
        F.cos("id"), F.sin("id"), F.lit(9.0)).alias("x"))
    lean = points.select(F.col("i").alias("_id"), F.col("g").alias("_label"), F.col("x").alias("_x"), silhouettes._dot("x", "x").alias("_sq"))
    groups = silhouettes.stage(silhouettes.group_moments(lean), "test-groups")
    out = silhouettes.nearest_other(lean, groups, 16)
    assert out.count() == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_vectors_that_are_no_numbers(spark):
    """They leave the other vectors' values as they are without them, and have NaN themselves."""
    nan = float("nan")
    rows = [(0, [0.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [5.0, 5.0], 1), (3, [5.0, 6.0], 1), (4, [nan, 1.0], 2), (5, [1.0, 1.0], 2)]
    frame = lambda some: spark.createDataFrame(some, "i int, x array<double>, g int")
    got = {r.i: r.silhouette for r in silhouettes.silhouette_values(frame(rows), "x", "g").collect()}
    want = {r.i: r.silhouette for r in silhouettes.silhouette_values(frame(rows[:4]), "x", "g").collect()}
    assert {i: got[i] for i in want} == pytest.approx(want) and np.isnan(got[4]) and np.isnan(got[5])
