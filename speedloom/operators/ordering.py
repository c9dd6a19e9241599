"""Order-based operators that never sort the whole table in one task.

Rows are first merged to one row per (group, distinct value), then put into value
buckets, so that a running total splits into "all earlier buckets" plus "inside my
bucket". Bucket edges come from the data's own quantiles; ties are merged before.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speedloom.functions.readings import is_finite

# Rows of a bucket, about: the number of buckets grows with the rows, not their size.
_BUCKET_ROWS = 50_000


def bucket_edges(rows: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Values that cut ``rows`` into about equal buckets (no shuffle of the rows).

    A value that fills many rows collapses into one edge, so no bucket holds more
    distinct values than an equal share of the rows.
    """
    if buckets is None:
        buckets = max(1, -(-rows.count() // _BUCKET_ROWS))
    probs = [i / buckets for i in range(1, buckets)]
    return sorted(set(rows.approxQuantile(value, probs, 1.0 / (2 * buckets)))) if probs else []


def with_bucket(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Add ``_bucket``, a whole number that grows with ``value``.

    The edges are plan constants: every use of the buckets sees the same ones, even
    when a lost task is run again.
    """
    if not edges:
        return df.withColumn("_bucket", F.lit(0.0))
    return Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol=value,
                      outputCol="_bucket", handleInvalid="error").transform(df)


def running_totals(df: DataFrame, value: str, sums: dict[str, str], edges: list[float],
                   by: tuple[str, ...] = (), totals: dict[str, str] | None = None,
                   descending: bool = False) -> DataFrame:
    """Cumulative sums of columns in ``value`` order within ``by`` groups.

    ``df`` holds one row per (``by``, ``value``) with non-null values. ``sums`` maps an
    input column to the name of its running total (this value included) and ``totals``
    an input column to the name of its group total. ``edges`` come from ``bucket_edges``.
    """
    totals = totals or {}
    # A struct key lets null group values match each other in the join.
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    bucketed = with_bucket(df, value, edges).withColumn("_group", group)

    def ordered(name: str):
        return F.col(name).desc() if descending else F.col(name).asc()

    if not edges:  # one bucket's worth of rows in all: one window, nothing to join
        all_rows = Window.partitionBy("_group")
        upto = all_rows.orderBy(ordered(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return bucketed.select(
            *df.columns, *[F.sum(c).over(upto).alias(out) for c, out in sums.items()],
            *[F.sum(c).over(all_rows).alias(out) for c, out in totals.items()])

    # One row per (group, bucket), whatever the input size.
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy(ordered("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_group", "_bucket")
        .agg(*[F.sum(c).alias(f"_sum_{c}") for c in {*sums, *totals}])
        .select(
            "_group", "_bucket",
            *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
              for c in sums],
            *[F.sum(f"_sum_{c}").over(whole).alias(out) for c, out in totals.items()],
        )
    )
    # The window leaves the rows partitioned on the join key: no second shuffle of them.
    inside = Window.partitionBy("_group", "_bucket").orderBy(ordered(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = bucketed.select("*", *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in sums])
    return running.join(offsets, ["_group", "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(out) for c, out in sums.items()],
        *totals.values(),
    )


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    by: tuple[str, ...] = (), interpolate: bool = False) -> DataFrame:
    """Exact quantiles per group; ``probs`` maps output name to probability.

    Without ``interpolate`` a quantile is the smallest value whose cumulative share
    reaches it; with it, neighbouring values are blended linearly. Null, NaN and
    infinite values do not count. Also returns ``n``, the number of values.
    """
    rows = df.where(is_finite(F.col(value))).select(*by, F.col(value).cast("double").alias("_value"))
    counts = rows.groupBy(*by, "_value").agg(F.count("*").alias("_n"))
    ranked = running_totals(counts, "_value", {"_n": "_upto"}, bucket_edges(rows, "_value"), by,
                            totals={"_n": "n"})

    def value_at(rank):
        return F.min(F.when(F.col("_upto") >= rank, F.col("_value")))

    picks = []
    for name, p in probs.items():
        if interpolate:
            place = F.lit(p) * (F.col("n") - 1)
            picks += [value_at(F.floor(place) + 1).alias(f"_lo_{name}"),
                      value_at(F.ceil(place) + 1).alias(f"_hi_{name}")]
        else:
            picks.append(value_at(F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1))).alias(name))
    out = ranked.groupBy(*by).agg(F.max("n").alias("n"), *picks)
    if not interpolate:
        return out.select(*by, "n", *probs)
    blended = []
    for name, p in probs.items():
        place = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        blended.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return out.select(*by, "n", *blended)
