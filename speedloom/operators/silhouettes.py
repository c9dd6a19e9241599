"""Silhouette (squared Euclidean) of any number of groups.

A group is its moments: size, centre, and the mean squared distance of its points to the centre (its inner
spread). The mean squared distance of a point to a group is the squared distance to the centre plus that spread,
which is at least the squared difference of the two norms plus the spread. Groups lie in tiles by the norm of
their centre, and points in chunks by the tile of their own norm. A chunk is first measured against the tile around its norm;
the least distances found bound the tiles, and inside a tile the blocks, in which a nearer group can lie. A chunk meets a tile
in one task, where a block of distances is one product of matrices; the least distance per point is a partial minimum.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speedloom.operators.ordering import bucket_edges, with_bucket
from speedloom.sources.staging import stage

# Groups of a block inside a tile. Numbers in the vectors of a tile or chunk, and most rows of one. Most tiles by norm: their edges are
# plan constants.
BLOCK_GROUPS, TILE_NUMBERS, TILE_ROWS, MOST_TILES = 256, 1 << 19, 1 << 13, 1 << 14
# Relative slack of a bound, so that rounding never leaves out an equal distance.
_SLACK = 1e-9


def _dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def group_moments(points: DataFrame) -> DataFrame:
    """_label, n, centre, _norm (of the centre) and spread of the points (_label, _x, _sq)."""
    sums = points.groupBy("_label").agg(
        F.count("*").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("_x"))).alias("total"),
        F.sum("_sq").alias("sq"))
    centred = sums.withColumn("centre", F.transform("total", lambda v: v / F.col("n")))
    square = _dot("centre", "centre")
    return centred.select("_label", "n", "centre", F.sqrt(square).alias("_norm"), "sq",
                          F.greatest(F.col("sq") / F.col("n") - square, F.lit(0.0)).alias("spread"))


def _mean_distance() -> Column:
    """Mean squared distance of a point to the members of a group."""
    return F.greatest(F.col("_sq") + F.col("sq") / F.col("n") - 2 * _dot("_x", "centre"), F.lit(0.0))


def _blocked(df: DataFrame, value: Column, edges: list[float], name: str) -> DataFrame:
    return with_bucket(df.withColumn("_at", value), "_at", edges).withColumnRenamed("_bucket", name).drop("_at")


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _met(block_groups: int, points: pa.Table, groups: pa.Table) -> pa.Table:
    """_id and _b of the points of a chunk: the least of ``_first`` and the distances to the groups of a tile."""
    of = lambda table, name: table.column(name).to_numpy()
    # The distance to a group with a member that is not a number is none, and counts nowhere.
    groups = groups.filter(np.isfinite(of(groups, "_norm")))
    n, m = points.num_rows, groups.num_rows
    best = np.array(points.column("_first").fill_null(np.inf).to_numpy())
    if n and m:
        x, sq, own = _matrix(points.column("_x"), n), of(points, "_sq"), of(points, "_own")
        order = np.argsort(of(groups, "_norm"), kind="stable")
        norm, mean_sq, spread = of(groups, "_norm")[order], of(groups, "_mean_sq")[order], of(groups, "spread")[order]
        centre = _matrix(groups.column("centre"), m)[order]
        # Where the own group of a point stands in this order; m: not in this tile.
        by_number = np.argsort(of(groups, "_number")[order])
        numbers = of(groups, "_number")[order][by_number]
        at = np.minimum(np.searchsorted(numbers, own), m - 1)
        at = np.where(numbers[at] == own, by_number[at], m)
        radius = np.sqrt(sq)
        starts = np.arange(0, m, block_groups)
        # The blocks around the norms of the chunk come first.
        for a in starts[np.argsort(np.abs(norm[starts] - np.median(radius)), kind="stable")]:
            b = min(a + block_groups, m)
            gap = np.maximum(np.maximum(norm[a] - radius, radius - norm[b - 1]), 0)
            rows = np.flatnonzero(gap * gap + spread[a:b].min() <= best * (1 + _SLACK) + _SLACK)
            if not len(rows):
                continue
            some = slice(None) if len(rows) == n else rows
            far = x[some] @ centre[a:b].T
            far *= -2
            far += mean_sq[a:b]
            inside = np.flatnonzero((at[some] >= a) & (at[some] < b))
            far[inside, at[some][inside] - a] = np.inf
            best[some] = np.minimum(best[some], np.maximum(far.min(axis=1) + sq[some], 0))
        best[np.isnan(sq)] = np.nan  # a point that is not a number is as far from all groups
    found = best != np.inf
    return pa.table({"_id": of(points, "_id")[found], "_b": best[found]})


def _dealt(df: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """Add ``name``: the part of its ``_tile`` that a row is in, and ``name``s: how many the tile has, of about ``rows`` rows."""
    parts = df.groupBy("_tile").agg(F.ceil(F.count("*") / rows).alias(f"{name}s"))
    # One row per tile.
    return df.join(F.broadcast(parts), "_tile").withColumn(name, F.pmod(F.xxhash64(key), F.col(f"{name}s")))


def nearest_other(points: DataFrame, groups: DataFrame, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """_id and _b: the least mean squared distance to a group that is not the point's own (none: no row).

    points: _id, _label, _x, _sq; groups: staged ``group_moments``.
    """
    told = groups.agg(F.count("*").alias("n"), F.max(F.size("centre")).alias("width")).first()
    rows = max(1, min(TILE_ROWS, TILE_NUMBERS // max(1, told.width or 1)))
    edges = bucket_edges(groups, "_norm", max(1, min(MOST_TILES, -(-told.n // rows))))
    # Stored once: the numbers of the groups and the parts they are in stay the same.
    tiled = _blocked(groups, F.col("_norm"), edges, "_tile").select(
        "_tile", F.monotonically_increasing_id().alias("_number"), "_label", "_norm", "spread", "centre", (F.col("sq") / F.col("n")).alias("_mean_sq"))
    members = stage(_dealt(stage(tiled, "silhouette-numbered"), "_number", rows, "_part"), "silhouette-tiles")
    own = members.select("_label", F.col("_number").alias("_own"))
    at_home = _blocked(points.join(own, "_label").drop("_label"), F.sqrt("_sq"), edges, "_tile")
    chunks = stage(_dealt(at_home, "_id", rows, "_piece").withColumnRenamed("_tile", "_home"), "silhouette-chunks")
    # One row per part of a tile: what its groups have in common.
    shape = stage(members.groupBy("_tile", "_part").agg(
        F.min("_norm").alias("_low"), F.max("_norm").alias("_high"), F.min("spread").alias("_least")), "silhouette-shape")
    tile, pair = ["_tile", "_part"], ["_home", "_piece", "_tile", "_part"]
    shuffled = members.select(*tile, "_number", "_norm", "spread", "centre", "_mean_sq")

    def least(asked: DataFrame) -> DataFrame:
        """The points of ``asked`` (with a pair each) measured against the tiles of their pairs."""
        pairs = stage(asked.select(*pair).distinct(), "silhouette-pairs")
        met = shuffled.join(pairs, tile).groupBy(*pair)
        return asked.select(*pair, "_id", "_own", "_x", "_sq", "_first").groupBy(*pair).cogroup(met).applyInArrow(
            partial(_met, block_groups), "_id long, _b double").groupBy("_id").agg(F.min("_b").alias("_b"))

    home = shape.select(F.col("_tile").alias("_home"), *tile)
    first = least(chunks.join(F.broadcast(home), "_home").withColumn("_first", F.lit(None).cast("double")))
    if not edges:  # one tile: all groups have been seen
        return first
    known = stage(chunks.join(first.withColumnRenamed("_b", "_first"), "_id", "left"), "silhouette-first")
    radius = F.sqrt("_sq")
    gap = F.greatest(F.col("_low") - radius, radius - F.col("_high"), F.lit(0.0))
    near = F.col("_first").isNull() | (gap * gap + F.col("_least") <= F.col("_first") * (1 + _SLACK) + _SLACK)
    rest = least(known.join(F.broadcast(shape), (F.col("_home") != F.col("_tile")) & near))
    return known.select("_id", F.col("_first").alias("_b")).unionByName(rest).where(F.col("_b").isNotNull()).groupBy("_id").agg(
        F.min("_b").alias("_b"))


def silhouette_values(points: DataFrame, features: str, label: str, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """Add ``silhouette`` to every point; points with a null label are left out.

    A point alone in its group has 0; where there is one group only the value is null.
    """
    is_array = isinstance(points.schema[features].dataType, T.ArrayType)
    array = F.col(features).cast("array<double>") if is_array else vector_to_array(F.col(features))
    named = points.where(F.col(label).isNotNull()).select(
        "*", F.monotonically_increasing_id().alias("_id"), F.col(label).alias("_label"), array.alias("_x"))
    # Stored once: its numbers stay the same when a task is run again.
    pts = stage(named.withColumn("_sq", _dot("_x", "_x")), "silhouette-points")
    lean = pts.select("_id", "_label", "_x", "_sq")
    groups = stage(group_moments(lean), "silhouette-groups")
    other = nearest_other(lean, groups, block_groups)
    # Mean distance to the own group leaves the point itself out.
    own = F.when(F.col("n") > 1, _mean_distance() * F.col("n") / (F.col("n") - 1))
    value = (
        F.when(F.col("n") == 1, F.lit(0.0))
        .when(F.col("_b").isNull(), F.lit(None).cast("double"))
        .when(F.greatest("_a", "_b") == 0, F.lit(0.0))
        .otherwise((F.col("_b") - F.col("_a")) / F.greatest("_a", "_b"))
    )
    return (
        pts.join(groups, "_label").join(other, "_id", "left")
        .withColumn("_a", own).withColumn("silhouette", value).select(*points.columns, "silhouette")
    )


def silhouette(points: DataFrame, features: str, label: str) -> DataFrame:
    """One row: the mean silhouette."""
    return silhouette_values(points, features, label).agg(F.avg("silhouette").alias("silhouette"))
