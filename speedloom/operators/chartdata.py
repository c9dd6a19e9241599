"""Tables behind the charts: series ends, scatter, box and density data."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speedloom.functions.readings import bin_lower, is_finite, minute_text
from speedloom.operators.horizon import split_bucket, time_key
from speedloom.operators.ordering import exact_quantiles


def series_head(scored: DataFrame, rows: int) -> DataFrame:
    return scored.select("timestamp", "prob_congestion").orderBy("timestamp").limit(rows)


def series_tail(scored: DataFrame, rows: int = 200) -> DataFrame:
    """The last ``rows`` known probabilities in time order."""
    last = (scored.where(F.col("prob_congestion").isNotNull() & ~F.isnan("prob_congestion"))
            .select("timestamp", "prob_congestion").orderBy(F.desc("timestamp")).limit(rows))
    return last.orderBy("timestamp").select(
        minute_text(F.col("timestamp")).alias("timestamp"), F.col("prob_congestion").alias("prob"))


def last_rows(scored: DataFrame, rows: int = 500, hidden: tuple[str, ...] = (
        "features", "features_raw", "probability_lr", "rawPrediction", "weight")) -> DataFrame:
    """The latest ``rows`` rows in time order without model internals."""
    shown = scored.drop(*hidden)
    return shown.orderBy(F.desc("timestamp")).limit(rows).orderBy("timestamp")


def series_hourly(scored: DataFrame) -> DataFrame:
    """Mean known probability of every hour of the whole span."""
    hour = F.date_trunc("hour", "timestamp").alias("timestamp")
    return scored.groupBy(hour).agg(
        F.avg("prob_congestion").alias("prob_congestion"), F.count("prob_congestion").alias("count"))


def scatter_counts(labelled: DataFrame) -> DataFrame:
    """Slots of the whole span by day, speed bin and state."""
    return labelled.groupBy(
        F.to_date("timestamp").alias("date"), bin_lower(F.col("avg_speed")).alias("bin_lower"),
        "prediction", "cluster_label").agg(F.count("*").alias("count"))


def scatter_head(labelled: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` slots in time with their state, as the scatter chart shows them."""
    return labelled.select("timestamp", "avg_speed", "prediction", "cluster_label").orderBy(
        "timestamp", "prediction").limit(rows)


def scatter_spread(labelled: DataFrame, per_mille: int) -> DataFrame:
    """A share of all slots over the whole span, chosen by time stamp hash."""
    bucket = split_bucket(time_key(F.col("timestamp")), 1000)
    return labelled.where(bucket < per_mille).select(
        "timestamp", "avg_speed", "prediction", "cluster_label")


def box_stats(labelled: DataFrame, value: str = "avg_speed", by: str = "cluster_label",
              whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group; whiskers end at the outermost values within reach."""
    boxes = exact_quantiles(labelled, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, (by,),
                            interpolate=True)
    reach = whisker * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        # One row per state, and a model has few states: joined by broadcast, because a
        # shuffle on so few keys would put a whole state into one task.
        labelled.where(is_finite(F.col(value))).select(by, value)
        .join(F.broadcast(boxes), labelled[by].eqNullSafe(boxes[by])).drop(boxes[by])
        .groupBy(by)
        .agg(F.first("n").alias("n"), F.min(value).alias("min"), F.first("q1").alias("q1"),
             F.first("median").alias("median"), F.first("q3").alias("q3"), F.max(value).alias("max"),
             F.min(F.when(inside, F.col(value))).alias("whisker_low"),
             F.max(F.when(inside, F.col(value))).alias("whisker_high"),
             F.count_if(~inside).alias("outliers"))
    )


def kde_grid(labelled: DataFrame, value: str = "avg_speed", by: str = "cluster_label",
             low: float = 0.0, high: float = 120.0, points: int = 61,
             bins_per_step: int = 10) -> DataFrame:
    """Gaussian density per group on an even grid, bandwidth by Scott's rule.

    Values are first merged in bins a tenth of a grid step wide, each standing at its own
    mean, so the density sums at most points x bins_per_step weights per group and grid
    point, not every row. Valid speeds all lie between ``low`` and ``high``.
    """
    step = (high - low) / (points - 1)
    width = step / bins_per_step
    finite = labelled.where(is_finite(F.col(value))).select(by, value)
    bins = finite.groupBy(by, F.floor((F.col(value) - low) / width).alias("_bin")).agg(
        F.count("*").alias("_w"), F.sum(value).alias("_s"), F.sum(F.col(value) * F.col(value)).alias("_q"))
    # Bins of one group travel as one array: a fixed number of cells, whatever the input.
    groups = bins.groupBy(by).agg(
        F.sum("_w").alias("n"),
        F.sqrt(F.greatest(F.lit(0.0), F.try_divide(
            F.sum("_q") - F.sum("_s") * F.sum("_s") / F.sum("_w"), F.sum("_w") - 1))).alias("_sd"),
        F.collect_list(F.struct((F.col("_s") / F.col("_w")).alias("x"),
                                F.col("_w").alias("w"))).alias("_bins"),
    ).where((F.col("n") > 1) & (F.col("_sd") > 0))
    h = F.col("_sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)),
                                 lambda i: F.lit(low) + i * F.lit(step)))
    kernel = F.aggregate(
        "_bins", F.lit(0.0),
        lambda acc, b: acc + b["w"] * F.exp(
            -0.5 * F.pow((F.col("x") - b["x"]) / F.col("bandwidth"), F.lit(2.0))))
    return (
        groups.withColumn("bandwidth", h).withColumn("x", grid)
        .select(by, "x", "n", "bandwidth",
                (kernel / (F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi))).alias("density"))
    )
