"""Cells, missing-value profile, mean fill and the strict outlier rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.functions.params import parameters
from speedloom.functions.readings import is_finite, slot_start
from speedloom.operators.ordering import exact_quantiles


def slot_cells(readings: DataFrame, freq_min: int) -> DataFrame:
    """Mean speed per (slot, sensor). Partial sums keep a busy sensor off one task."""
    return readings.groupBy(
        slot_start(F.col("ts"), freq_min).alias("ts"), "sensor"
    ).agg(F.avg("speed").alias("speed"))


def sensor_means(cells: DataFrame) -> DataFrame:
    """Valid cells and mean speed per sensor; the mean is null when no cell is valid."""
    return cells.groupBy("sensor").agg(
        F.count("speed").alias("observed"), F.avg("speed").alias("mean_speed"))


def sensor_profile(cells: DataFrame) -> DataFrame:
    """Per sensor: valid and missing cells against all slots, before and after mean fill.

    A slot in which a sensor never reported is missing just like a rejected value.
    """
    slots = cells.select("ts").distinct().agg(F.count("*").alias("n")).scalar()
    missing = F.col("slots") - F.col("observed")
    return (
        sensor_means(cells)
        .withColumn("slots", slots)
        .select(
            "sensor", "slots", "observed", "mean_speed",
            missing.alias("missing_count"),
            F.round(missing / F.col("slots") * 100, 2).alias("missing_pct"),
            F.when(F.col("mean_speed").isNull(), F.col("slots")).otherwise(F.lit(0))
            .cast("long").alias("missing_after_fill"),
        )
    )


def missing_profile(profile: DataFrame, top: int = 10) -> DataFrame:
    """The sensors of ``sensor_profile`` with most missing cells."""
    return (
        profile.select("sensor", "missing_count", "missing_pct")
        .orderBy(F.desc("missing_count"), "sensor")
        .limit(top)
    )


def finite_speeds(df: DataFrame, column: str = "avg_speed") -> DataFrame:
    return df.where(is_finite(F.col(column)))


def iqr_bounds(df: DataFrame, column: str = "avg_speed", factor: float = fv.IQR_FACTOR,
               exact: bool = True) -> DataFrame:
    """One row: quartiles and the fences ``factor`` interquartile ranges outside them."""
    if exact:
        quartiles = exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75}).select("q1", "q3")
    else:
        q = F.percentile_approx(column, [0.25, 0.75])
        quartiles = df.agg(q.alias("q")).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return quartiles.select(
        "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - factor * iqr).alias("lower_bound"),
        (F.col("q3") + factor * iqr).alias("upper_bound"),
    )


def flag_outliers(df: DataFrame, bounds: DataFrame | Row, column: str = "avg_speed",
                  low: float = fv.HARD_LOW_EXCLUSIVE,
                  high: float = fv.HARD_HIGH_EXCLUSIVE) -> DataFrame:
    """Add ``is_outlier``: outside the fences or the hard limits. No fences, no outliers.

    ``bounds`` is the frame of ``iqr_bounds`` or its one row, already fetched.
    """
    lower, upper = parameters(bounds, "lower_bound", "upper_bound").values()
    v = F.col(column)
    inside = v.between(lower, upper) & (v > low) & (v < high)
    return df.withColumn("is_outlier", F.coalesce(lower.isNotNull() & ~inside, F.lit(False)))


def drop_outliers(df: DataFrame, bounds: DataFrame | Row, column: str = "avg_speed",
                  low: float = fv.HARD_LOW_EXCLUSIVE,
                  high: float = fv.HARD_HIGH_EXCLUSIVE) -> DataFrame:
    return flag_outliers(df, bounds, column, low, high).where(~F.col("is_outlier")).drop("is_outlier")


def outlier_counts(flagged: DataFrame) -> DataFrame:
    """Rows before and after the outlier rule, rows removed and their share (one pass)."""
    removed = F.count_if("is_outlier")
    return flagged.agg(
        F.count("*").alias("rows_before"),
        F.count_if(~F.col("is_outlier")).alias("rows_after"),
        removed.alias("rows_removed"),
        F.round(F.try_divide(removed, F.count("*")) * 100, 2).alias("removed_pct"),
    )


def speed_stats(df: DataFrame, column: str = "avg_speed") -> DataFrame:
    return df.agg(F.avg(column).alias("mean_speed"), F.min(column).alias("min_speed"),
                  F.max(column).alias("max_speed"))


def fill_wide(wide: DataFrame, sensors: list[str]) -> DataFrame:
    """Mean-fill a wide frame with one aggregate for all columns (for narrow frames)."""
    row = wide.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in sensors]).first()
    means = {c: row[c] for c in sensors if row[c] is not None}
    return wide.fillna(means) if means else wide


def wide_row_mean(filled: DataFrame, sensors: list[str]) -> DataFrame:
    """Row mean over all sensor columns; null if any is null."""
    total = F.col(f"`{sensors[0]}`")
    for c in sensors[1:]:
        total = total + F.col(f"`{c}`")
    return filled.withColumn("avg_speed", total / len(sensors))
