"""Logistic scoring with given coefficients, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.functions.params import parameters


def moment_aggregates(columns: tuple[str, ...] = fv.FEATURES) -> list[Column]:
    """Mean and sample standard deviation of every feature."""
    return [a for c in columns for a in (
        F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]


def feature_moments(df: DataFrame, columns: tuple[str, ...] = fv.FEATURES) -> DataFrame:
    return df.agg(*moment_aggregates(columns))


def standardize(df: DataFrame, moments: DataFrame | Row,
                columns: tuple[str, ...] = fv.FEATURES) -> DataFrame:
    """Add ``z_<feature>``; a feature without spread becomes 0, as a scaler does."""
    m = parameters(moments, *[f"{c}_{m}" for c in columns for m in ("mean", "std")])
    return df.withColumns({
        f"z_{c}": F.when(m[f"{c}_std"] > 0, (F.col(c) - m[f"{c}_mean"]) / m[f"{c}_std"])
        .otherwise(F.lit(0.0))
        for c in columns
    })


def logistic_score(df: DataFrame, coefficients: dict[str, float] | None = None,
                   intercept: float = fv.DEFAULT_INTERCEPT,
                   threshold: float = fv.DECISION_THRESHOLD) -> DataFrame:
    """Add ``prob_congestion`` and ``prediction_congested`` from the ``z_`` columns."""
    coefficients = coefficients or fv.PUBLISHED_COEFFICIENTS
    margin = F.lit(float(intercept))
    for name, weight in coefficients.items():
        margin = margin + F.lit(float(weight)) * F.col(f"z_{name}")
    scored = df.withColumn("prob_congestion", 1.0 / (1.0 + F.exp(-margin)))
    return scored.withColumn(
        "prediction_congested", (F.col("prob_congestion") > threshold).cast("double"))


def feature_importance(spark: SparkSession, coefficients: dict[str, float]) -> DataFrame:
    """Coefficient and share of the absolute coefficients per feature (a model's few rows)."""
    rows = [(i, name, float(v)) for i, (name, v) in enumerate(coefficients.items())]
    table = spark.createDataFrame(rows, "_pos int, feature string, coefficient double")
    total = table.agg(F.sum(F.abs("coefficient"))).scalar()
    share = F.when(total > 0, F.abs("coefficient") / total).otherwise(F.lit(0.0))
    return (table.withColumn("importance", share)
            .orderBy(F.desc("importance"), "_pos").drop("_pos"))
