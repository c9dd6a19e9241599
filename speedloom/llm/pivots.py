"""Centroid clustering (13): nearest centroids by a table of distances to fixed pivots (LAESA).

A vector's components become integers floor(SCALE * x). PIVOTS vectors are fixed once; every vector's distance to each of them
is stored beside it. In a round only the pivots' distances to the centroids are new: by the triangle inequality the largest
difference between a vector's and a centroid's distance to one pivot is a lower bound of their distance. The centroid with
the least bound is measured first; another is measured, in exact integers, only if its bound does not exceed that
distance. Each task sums its vectors per centroid; Spark adds the sums, and the driver sees k x components of them.

Kept are vectors of exactly DIMENSIONS components, none null or non-finite; others give no row. Integers beyond +-LARGEST
count as that bound, so that squared distances fit in 64 bits. Vectors with equal components share a centroid; the first
centroids are the vectors first in (hash of vec_id, vec_id, components), so a repeated vec_id can give two, and null
vec_ids come last. With fewer than k kept vectors there are as many centroids. An empty table gives an empty result.
Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from speedloom.llm.common import stage

DIMENSIONS, SCALE = 64, 1024
K, ROUNDS, SEED = 8, 10, 3
#: Fixed pivots; the first K of them are the first centroids.
PIVOTS = 16
LARGEST = (1 << 27) - 1
#: Vectors whose bounds are held at a time.
AT_ONCE = 1 << 14


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one vector."""
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def pivot_table(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squares(x, p) for p in pivots], axis=1).astype(np.float64))


def nearest(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (the smaller of equals), its squared distance, and how many distances were measured."""
    of_centroids = pivot_table(centroids, pivots)
    bounds = np.zeros((len(x), len(centroids)))
    for c in range(len(centroids)):
        np.abs(table - of_centroids[c]).max(axis=1, out=bounds[:, c])
    first = bounds.argmin(axis=1)
    least = np.empty(len(x), np.int64)
    for c in range(len(centroids)):
        mine = first == c
        least[mine] = squares(x[mine], centroids[c])
    cluster, measured = first.copy(), len(x)
    slack = 1 + np.sqrt(least.astype(np.float64)) * (1 + 1e-9)  # rounding never excludes an equal distance
    for c in range(len(centroids)):
        some = np.flatnonzero((bounds[:, c] <= slack) & (first != c))
        distance = squares(x[some], centroids[c])
        measured += len(some)
        better = (distance < least[some]) | ((distance == least[some]) & (c < cluster[some]))
        least[some[better]], cluster[some[better]] = distance[better], c
    return cluster, least, measured


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def blocks(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of int) of the kept vectors."""
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform("embedding", lambda v: F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    return vectors.where((F.size("embedding") == DIMENSIONS) & whole).select(F.col("vec_id").cast("long"), scaled.alias("x"))


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their distances to the pivots; staged."""

    def rows(batches):
        for part in blocks(batches):
            table = pivot_table(matrix(part.column("x"), np.int64), pivots)
            offsets = pa.array(np.arange(0, table.size + 1, len(pivots), dtype=np.int32))
            yield part.append_column("to_pivots", pa.ListArray.from_arrays(offsets, pa.array(table.reshape(-1))))

    return stage(vectors.mapInArrow(rows, "vec_id long, x array<int>, to_pivots array<double>"), "pivot-table")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round."""

    def rows(batches):
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for part in blocks(batches):
            x = matrix(part.column("x"), np.int64)
            cluster, _, _ = nearest(x, matrix(part.column("to_pivots"), np.float64), centroids, pivots)
            for c in np.unique(cluster):
                mine = x[cluster == c]
                count[c] += len(mine)
                total[c] += mine.sum(axis=0)
        at, component = (i.reshape(-1) for i in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(component), pa.array(count[at]), pa.array(total.reshape(-1))], names=["cluster", "component", "n", "total"])

    sums = table.mapInArrow(rows, "cluster long, component long, n long, total long").groupBy("cluster", "component")
    out = centroids.copy()
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).where("n > 0").collect():
        out[r.cluster, r.component] = int(r.total) // r.n
    return out


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, n_pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors)
    named = kept.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = named.orderBy(F.col("hash").asc_nulls_last(), "vec_id", "x").limit(max(k, n_pivots)).collect()
    pivots = np.array([r.x for r in first[:n_pivots]], np.int64).reshape(-1, DIMENSIONS)
    centroids = np.array([r.x for r in first[:k]], np.int64).reshape(-1, DIMENSIONS)
    schema = "vec_id long, cluster int, distance long"
    if not first:
        empty = spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    table = with_pivots(kept, pivots)
    for _ in range(rounds):
        now = moved(table, centroids, pivots)
        if np.array_equal(now, centroids):
            break  # the rounds left would give the same centroids
        centroids = now

    def rows(batches):
        for part in blocks(batches):
            cluster, distance, _ = nearest(matrix(part.column("x"), np.int64), matrix(part.column("to_pivots"), np.float64), centroids, pivots)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = stage(table.mapInArrow(rows, schema), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = sum(int(r.total) for r in sums)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = spark.createDataFrame([(r.cluster, int(r.total), whole, names[r.cluster]) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # one row per centroid


def clustering_sql(k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same clustering by measuring every distance, as DuckDB SQL over ``embeddings``."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSIONS})""",
        "cells AS MATERIALIZED (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM kept)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, x FROM kept QUALIFY cluster < {k})",
    ]
    assign = "a{0} AS MATERIALIZED (SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (SELECT k.vec_id, c.cluster, list_sum(list_transform(list_zip(k.x, c.x), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT))) AS d FROM kept k CROSS JOIN c{0} c) GROUP BY vec_id)"
    for r in range(rounds):
        steps.append(assign.format(r))
        steps.append(
            f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT cluster, list(v ORDER BY i) AS x FROM
(SELECT a.cluster, e.i, CAST(sum(e.v) - (((sum(e.v) % count(*)) + count(*)) % count(*)) AS BIGINT) // count(*) AS v FROM cells e JOIN a{r} a USING (vec_id) GROUP BY a.cluster, e.i) GROUP BY cluster) m USING (cluster))"""
        )
    steps.append(assign.format(rounds))
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c USING (cluster)"""
