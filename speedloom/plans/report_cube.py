"""All slot reports from one pass: a partial cube and its roll-ups.

Nine reports over the same scored slots would read them nine times. The cube keeps
counts and sums (with the number of known values) at the finest level any report needs; its size depends on the calendar
(days x 24 hours x states x classes x speed bins), not on the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.functions.readings import bin_lower
from speedloom.operators.reports import require_columns

# Squares are summed around a mid-range speed, so the spread keeps its digits.
_SHIFT = (fv.SPEED_MIN_EXCLUSIVE + fv.SPEED_MAX_INCLUSIVE) / 2

KEYS = ("date", "hour", "weekday", "prediction", "prediction_congested", "bin_lower")
REPORTS = {
    "overview": (),
    "cluster_distribution": ("prediction",),
    "congestion_summary": ("prediction_congested",),
    "hourly_summary": ("hour",),
    "weekday_summary": ("weekday",),
    "histogram_avg_speed": ("bin_lower",),
    "daily_avg_speed": ("date",),
    "weekday_hour_heatmap": ("weekday", "hour"),
    "date_hour": ("date", "hour"),
}


def base_cube(scored: DataFrame) -> DataFrame:
    require_columns(scored)
    v = F.col("avg_speed") - F.lit(_SHIFT)
    return (
        scored.withColumns({"date": F.to_date("timestamp"), "bin_lower": bin_lower(F.col("avg_speed"))})
        .groupBy(*KEYS)
        .agg(F.count("*").alias("n"), F.count("avg_speed").alias("nv"), F.count("prob_congestion").alias("np"),
             F.sum(v).alias("sv"), F.sum(v * v).alias("svv"),
             F.sum("prob_congestion").alias("sp"), F.min("timestamp").alias("start_time"),
             F.max("timestamp").alias("end_time"))
    )


def _measures() -> list[Column]:
    n, nv, sv = F.sum("n"), F.sum("nv"), F.sum("sv")
    variance = F.try_divide(F.sum("svv") - F.try_divide(sv * sv, nv), nv - 1)
    return [
        F.coalesce(n, F.lit(0)).alias("count"), (F.try_divide(sv, nv) + F.lit(_SHIFT)).alias("avg_speed"),
        F.when(nv > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std_speed"),
        F.try_divide(F.sum("sp"), F.sum("np")).alias("avg_prob"),
        F.try_divide(F.sum(F.col("n") * F.col("prediction_congested")), n).alias("congestion_ratio"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
    ]


def roll_up(cube: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The measures by some of the cube's keys."""
    return cube.groupBy(*keys).agg(*_measures())


def report(cube: DataFrame, name: str) -> DataFrame:
    """One report, column for column, from a (stored) cube."""
    columns = [F.col(measure).alias(column) for column, measure in fv.REPORT_COLUMNS[name].items()]
    if name == "top_congestion":
        keys = REPORTS["date_hour"]
        worst = roll_up(cube.where(F.col("prediction_congested") == 1), keys)
        return worst.orderBy(F.desc("avg_prob"), F.desc("count"), *keys).limit(fv.TOP_CONGESTION_ROWS).select(*keys, *columns)
    keys = REPORTS[name]
    rows = roll_up(cube, keys)
    if name == "histogram_avg_speed":
        rows = rows.where(F.col("bin_lower").isNotNull()).withColumn("bin_upper", F.col("bin_lower") + F.lit(fv.HISTOGRAM_WIDTH))
    return (rows.orderBy(*keys) if keys else rows).select(*keys, *columns)


def all_reports(scored: DataFrame) -> DataFrame:
    """Every roll-up in one table: ``report`` names it, keys it does not use are null.

    One shuffle builds the cube; the grouping sets then work on cube rows only.
    """
    sets = [[F.col(k) for k in keys] for keys in REPORTS.values()]
    # Bit i of the grouping id (from the left) is set when key i is rolled up.
    ids = {
        sum(0 if k in keys else 1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS)): name
        for name, keys in REPORTS.items()
    }
    name = None
    for value, report in ids.items():
        test = F.col("_gid") == value
        name = F.when(test, report) if name is None else name.when(test, report)
    return (
        base_cube(scored).groupingSets(sets, *KEYS)
        .agg(F.grouping_id().alias("_gid"), *_measures())
        .withColumn("report", name)
        .select("report", *KEYS, "count", "avg_speed", "std_speed", F.col("avg_prob").alias("avg_prob_congestion"),
                "start_time", "end_time")
    )


def report_tables(cube: DataFrame) -> dict[str, DataFrame]:
    return {name: report(cube, name) for name in fv.REPORT_COLUMNS}
