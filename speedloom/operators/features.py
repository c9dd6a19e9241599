"""Time-slot features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speedloom.operators.cleaning import sensor_means


def slot_average(cells: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Network mean speed per slot with gaps counted at each sensor's own mean.

    Filling every gap would build the slots x sensors grid. The same mean is the mean
    of the sensor means, moved by what the present cells differ from theirs. Sensors
    without any valid cell take no part. ``means`` are the sensors' means where they are
    stored already; otherwise they come from ``cells``.
    """
    means = sensor_means(cells) if means is None else means
    means = means.where(F.col("mean_speed").isNotNull()).select("sensor", "mean_speed")
    network = means.agg(
        F.struct(F.sum("mean_speed").alias("total"), F.count("*").alias("sensors")).alias("network")
    ).scalar()
    shift = F.coalesce(F.sum(F.col("speed") - F.col("mean_speed")), F.lit(0.0))
    return (
        # Left join: a slot whose only cells come from dead sensors is still a slot. The
        # sensor table grows with the network, so its join strategy is left to its size.
        cells.join(means, "sensor", "left")
        .groupBy("ts").agg(shift.alias("shift"))
        .select(F.col("ts").alias("timestamp"),
                ((network["total"] + F.col("shift")) / network["sensors"]).alias("avg_speed"))
        .where(F.col("avg_speed").isNotNull())
    )


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``hour`` (0-23) and ``weekday`` (1 = Sunday)."""
    return df.withColumns({"hour": F.hour(ts), "weekday": F.dayofweek(ts)})


def hourly_spread(df: DataFrame) -> DataFrame:
    """Sample standard deviation of the mean speed per hour; one-row hours give 0."""
    return df.groupBy("hour").agg(
        F.coalesce(F.stddev_samp("avg_speed"), F.lit(0.0)).alias("std_speed_hour"))


def with_hourly_spread(df: DataFrame, spread: DataFrame | None = None) -> DataFrame:
    """Add ``std_speed_hour`` from ``spread`` (default: from ``df`` itself)."""
    if spread is None:
        spread = hourly_spread(df)
    # An hour of the day has 24 values: the broadcast side cannot grow.
    return df.join(F.broadcast(spread), "hour", "left").fillna({"std_speed_hour": 0.0})


def slot_features(cells: DataFrame) -> DataFrame:
    base = with_calendar(slot_average(cells))
    return with_hourly_spread(base).select(
        "timestamp", "avg_speed", "hour", "weekday", "std_speed_hour")
