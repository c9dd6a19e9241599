"""Signal plan from scored slots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speedloom.functions.readings import shown
from speedloom.functions.signals import green_extension_pct, strategy_text
from speedloom.operators.reports import require_columns


def plan_measures() -> list:
    return [F.avg("prob_congestion").alias("avg_prob"), F.avg("avg_speed").alias("avg_speed"),
            F.count("*").alias("count_samples")]


def with_signal_columns(agg: DataFrame, horizon_min: int) -> DataFrame:
    return agg.withColumn("green_extension_pct", green_extension_pct(F.col("avg_prob"))).withColumn(
        "strategy", strategy_text(F.col("avg_prob"))).withColumn(
        "horizon_min", F.lit(int(horizon_min)))


def signal_plan(scored: DataFrame, horizon_min: int) -> DataFrame:
    """Green-time change per date and hour."""
    require_columns(scored, ("prob_congestion", "avg_speed", "timestamp", "hour"))
    per_hour = scored.groupBy(F.to_date("timestamp").alias("date"), "hour").agg(*plan_measures())
    return with_signal_columns(per_hour, horizon_min).orderBy("date", "hour")


def riskiest(plan: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` plan rows by probability, then samples, as the dashboard rounds them."""
    return (
        plan.orderBy(F.desc_nulls_last("avg_prob"), F.desc_nulls_last("count_samples"), "date", "hour")
        .limit(top)
        .withColumn("avg_prob_percent", shown(F.col("avg_prob") * 100, 1))
        .withColumn("avg_speed", shown(F.col("avg_speed"), 2))
    )
