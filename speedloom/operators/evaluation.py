"""Evaluation of binary predictions: counts, curves and areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speedloom.operators.ordering import bucket_edges, running_totals


def evaluation_rows(df: DataFrame) -> DataFrame:
    """The test rows, or all rows when none is marked as test."""
    if "is_test" not in df.columns:
        return df
    has_test = df.agg(F.coalesce(F.bool_or("is_test"), F.lit(False))).scalar()
    return df.where(F.coalesce(F.col("is_test"), F.lit(False)) | ~has_test)


def confusion(df: DataFrame, label: str = "label", predicted: str = "prediction_congested") -> DataFrame:
    """One row: tp, fp, fn, tn."""
    y, p = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def confusion_cells(df: DataFrame, label: str = "label",
                    predicted: str = "prediction_congested") -> DataFrame:
    return df.groupBy(label, predicted).agg(F.count("*").alias("count")).orderBy(label, predicted)


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where the divisor is 0."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def label_metrics(df: DataFrame, label: str = "label",
                  predicted: str = "prediction_congested") -> DataFrame:
    """One row: accuracy, precision, recall, binary F1 and support-weighted F1."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    pos, neg = tp + fn, tn + fp
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_negative = _ratio(2 * tn, 2 * tn + fp + fn)
    return confusion(df, label, predicted).select(
        _ratio(tp + tn, pos + neg).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, pos).alias("recall"),
        f1.alias("f1"),
        _ratio(f1 * pos + f1_negative * neg, pos + neg).alias("f1_weighted"),
    )


def score_curve(df: DataFrame, label: str = "label", score: str = "prob_congestion") -> DataFrame:
    """One row per distinct score: its positives and negatives, running and total counts."""
    rows = df.select(F.col(score).cast("double").alias("score"), F.col(label).alias("label")).where(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())
    counts = rows.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    return running_totals(counts, "score", {"pos": "tp", "neg": "fp"}, bucket_edges(rows, "score"),
                          totals={"pos": "n_pos", "neg": "n_neg"}, descending=True)


def roc_points(curve: DataFrame) -> DataFrame:
    """ROC points by falling threshold; the origin has no threshold. Ties are one point."""
    points = curve.select(
        F.col("score").alias("threshold"), "tp", "fp",
        (F.col("tp") / F.greatest("n_pos", F.lit(1))).alias("tpr"),
        (F.col("fp") / F.greatest("n_neg", F.lit(1))).alias("fpr"))
    origin = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return points.unionByName(origin)


def chart_points(curve: DataFrame, pieces: int = 200) -> DataFrame:
    """The ROC curve thinned for a chart: at most 2 x ``pieces`` + 2 points, whatever its length.

    False positive rates are cut into ``pieces`` equal parts (and the end); of each the first and last point stay. Between two points that stay the curve
    rises within their rectangle, so each trapezoid is wrong by half of it at most, and all by 1 / (2 x ``pieces``).
    """
    points = roc_points(curve).withColumn("piece", F.floor(F.col("fpr") * pieces))
    place = F.struct("fp", "tp")
    row = F.struct("threshold", "tp", "fp", "tpr", "fpr")
    ends = points.groupBy("piece").agg(F.min_by(row, place).alias("first"), F.max_by(row, place).alias("last"))
    return ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("p")).select("p.*")


def chart_error(curve: DataFrame, pieces: int = 200) -> DataFrame:
    """One row: points of the thinned curve, its area, by how much that differs from the whole curve's, and the bound."""
    # The window runs over the points of a chart, 2 x pieces + 2 at most.
    order = Window.partitionBy(F.lit(0)).orderBy("fp", "tp")
    steps = chart_points(curve, pieces).select(
        "*", F.lag("fpr", 1, 0.0).over(order).alias("fpr_before"), F.lag("tpr", 1, 0.0).over(order).alias("tpr_before"))
    area = F.sum((F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2)
    whole = curve_areas(curve).select("auc_roc").scalar()
    return steps.agg(F.count("*").alias("points"), area.alias("area")).select(
        "points", "area", (F.col("area") - whole).alias("error"), F.lit(0.5 / pieces).alias("bound"))


def curve_areas(curve: DataFrame) -> DataFrame:
    """One row: ROC area, PR area (trapezoids) and average precision (steps).

    Every piece of an area needs only its own row, because the running counts before
    a row are its running counts less its own. Areas that one missing class leaves
    undefined are null.
    """
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    precision = tp / (tp + fp)
    before = tp - pos + fp - neg
    # The PR curve starts level with its first point.
    precision_before = F.when(before > 0, (tp - pos) / before).otherwise(precision)
    pairs = F.max("n_pos").cast("double") * F.max("n_neg")
    return curve.agg(
        F.when(both, F.sum(neg * (tp - pos / 2)) / pairs).alias("auc_roc"),
        F.when(F.max("n_pos") > 0, F.sum(pos * (precision + precision_before) / 2)
               / F.max("n_pos")).alias("auc_pr"),
        F.when(F.max("n_pos") > 0, F.sum(pos * precision) / F.max("n_pos")).alias("average_precision"),
    )


def run_summary(df: DataFrame) -> DataFrame:
    """One row: rows, rows predicted congested and their share of a prediction run."""
    positive = F.count_if(F.col("prediction_congested") == 1)
    return df.agg(
        F.count("*").alias("total_rows"), positive.alias("positive_cases"),
        F.try_divide(positive, F.count("*")).alias("positive_share"))
