"""Checks that a fitted model is what it claims to be, computed from the rows it was fitted on.

A fit starts from random places and stops at a tolerance, so its numbers cannot be written down beforehand. What
can be checked exactly is that it is an optimum: every row lies with its nearest centre and every centre is the mean of its
rows; the gradient of the weighted, penalised loss vanishes at the coefficients.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.operators.states import StateModel

# Distances and means agree within rounding and the tolerance of the fit.
_ROUNDING = 1e-9


def _squared(columns: tuple[str, ...], centre) -> Column:
    terms = [(F.col(c).cast("double") - F.lit(float(v))) ** 2 for c, v in zip(columns, centre)]
    return reduce(lambda a, b: a + b, terms)


def state_certificate(assigned: DataFrame, fitted: StateModel, columns: tuple[str, ...] = fv.FEATURES) -> DataFrame:
    """One row: rows, states in use, rows with a nearer centre, the largest difference of a centre from the mean of its rows.

    ``fitted`` has unscaled features. Its k centres are parameters of the plan.
    """
    centres = fitted.model.stages[-1].clusterCenters()
    distances = F.array(*[_squared(columns, c) for c in centres])
    own = F.element_at("_d", F.col("prediction") + 1)
    rows = assigned.withColumn("_d", distances)
    per_state = rows.groupBy("prediction").agg(
        F.count("*").alias("n"),
        F.count_if(own > F.array_min("_d") * (1 + _ROUNDING) + _ROUNDING).alias("far"),
        *[F.avg(c).alias(f"_mean_{c}") for c in columns])
    told = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres]), F.col("prediction") + 1)
    gap = F.greatest(*[F.abs(F.col(f"_mean_{c}") - told[i]) for i, c in enumerate(columns)])
    return per_state.agg(
        F.sum("n").alias("rows"), F.count("*").alias("states"), F.sum("far").alias("not_nearest"),
        F.max(gap).alias("centre_gap"))


def logistic_certificate(train_rows: DataFrame, model: PipelineModel) -> DataFrame:
    """One row: rows, and the largest violation of the optimality conditions of the weighted elastic-net loss.

    The penalty acts on coefficients of features divided by their weighted spread. A coefficient that is not
    zero needs a vanishing derivative; at zero the derivative of the loss may be as large as the share of the absolute penalty.
    """
    assemble, scaler, fitted = model.stages
    reg, share = fitted.getRegParam(), fitted.getElasticNetParam()
    beta, size = [float(v) for v in fitted.coefficients], fitted.numFeatures
    # Positives without negatives have no class weight: they count once.
    rows = PipelineModel(stages=[assemble, scaler]).transform(train_rows.fillna({"weight": 1.0}))
    spread = rows.select(Summarizer.metrics("std").summary(F.col("features"), F.col("weight")).alias("s")).select(
        vector_to_array("s.std").alias("std")).first().std
    x = vector_to_array("features")
    margin = reduce(lambda a, b: a + b, [F.col("_x")[j] * F.lit(beta[j]) for j in range(size)]) + F.lit(float(fitted.intercept))
    slope = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("label"))
    whole = rows.withColumn("_x", x).withColumn("_slope", slope).agg(
        F.count("*").alias("rows"), F.sum("weight").alias("_w"), F.sum("_slope").alias("_g"),
        *[F.sum(F.col("_slope") * F.col("_x")[j]).alias(f"_g{j}") for j in range(size)])

    def violation(j: int) -> Column:
        slope = F.col(f"_g{j}") / F.col("_w") / F.lit(float(spread[j]))
        scaled = beta[j] * spread[j]
        if scaled == 0:
            return F.greatest(F.abs(slope) - F.lit(reg * share), F.lit(0.0))
        sign = 1.0 if scaled > 0 else -1.0
        return F.abs(slope + F.lit(reg * ((1 - share) * scaled + share * sign)))

    worst = F.greatest(F.abs(F.col("_g") / F.col("_w")), *[violation(j) for j in range(size) if spread[j] > 0])
    return whole.select("rows", worst.alias("violation"))


def differing_scores(a: DataFrame, b: DataFrame, key: str = "timestamp", score: str = "prob_congestion") -> DataFrame:
    """One row: keys scored by both, and keys with another score or scored by one side only."""
    both = a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key, "full_outer")
    return both.agg(F.count("*").alias("scored"), F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("differing"))
