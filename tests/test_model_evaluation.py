import datetime as dt
import math
import random

import pytest
from conftest import values
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.operators import certificates, evaluation, horizon, scoring, states, training
from speedloom.operators.states import assembler

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(5)
    data = []
    for i in range(400):
        t, v = T0 + dt.timedelta(minutes=30 * i), rng.uniform(10, 90)
        label = int(v + rng.gauss(0, 12) < 40)
        data.append((t, v, t.hour, t.isoweekday(), rng.uniform(1, 6), label))
    df = spark.createDataFrame(data, "timestamp timestamp, avg_speed double, hour int, weekday int, "
                                     "std_speed_hour double, label int")
    return horizon.with_class_weight(horizon.with_test_flag(df)).cache()


@pytest.fixture(scope="module")
def trained(samples):
    return training.train(samples)


def test_standardize_equals_scaler(samples):
    raw = assembler(fv.FEATURES, "raw").transform(samples)
    scaled = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(raw).transform(raw)
    want = {r.timestamp: r.z for r in scaled.select("timestamp", vector_to_array("z").alias("z")).collect()}
    for moments in (scoring.feature_moments(samples), scoring.feature_moments(samples).first()):
        for r in scoring.standardize(samples, moments).collect():
            assert [r[f"z_{c}"] for c in fv.FEATURES] == pytest.approx(want[r.timestamp], abs=1e-9)


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert values(scoring.standardize(df, scoring.feature_moments(df, ("a",)), ("a",)), "z_a") == [(0.0,)] * 2


def test_training_learns_and_survives_saving(samples, trained, tmp_path):
    assert trained.reason is None and len(trained.grid_scores) == 6
    assert trained.coefficients["avg_speed"] < 0
    out = training.score(samples, trained.model)
    training.save_model(trained.model, str(tmp_path / "m"))
    again = training.score(samples, training.load_model(str(tmp_path / "m")))
    assert sorted(values(out, "timestamp", "prob_congestion")) == sorted(values(again, "timestamp", "prob_congestion"))
    areas = evaluation.curve_areas(evaluation.score_curve(evaluation.evaluation_rows(out))).first()
    assert areas.auc_roc > 0.8
    # Weighted training centres the predicted share near one half.
    base = out.where("not is_test").agg(
        F.sum(F.col("prob_congestion") * F.col("weight")) / F.sum("weight")).first()[0]
    assert base == pytest.approx(0.5, abs=0.03)


def test_sql_score_equals_model(samples, trained):
    moments = scoring.feature_moments(horizon.train_rows(samples)).first()
    own = scoring.logistic_score(scoring.standardize(samples, moments), trained.coefficients,
                                 float(trained.model.stages[-1].intercept))
    want = {r.timestamp: (r.prob_congestion, r.prediction_congested)
            for r in training.score(samples, trained.model).collect()}
    for r in own.collect():
        assert r.prob_congestion == pytest.approx(want[r.timestamp][0], abs=1e-9)
        assert r.prediction_congested == want[r.timestamp][1]


def test_guards(spark, samples):
    assert training.train(samples.where("label = 1")).reason == "only one class"
    assert training.train(samples.limit(0)).reason == "no labelled samples"
    few = samples.orderBy("timestamp").limit(8)
    assert training.train(few).reason in ("too few train or test rows", "only one class")


def test_areas_equal_mllib(samples):
    scored = samples.select("label", (-F.floor("avg_speed")).cast("double").alias("prob_congestion"))
    areas = evaluation.curve_areas(evaluation.score_curve(scored)).first()
    for metric, own in (("areaUnderROC", areas.auc_roc), ("areaUnderPR", areas.auc_pr)):
        want = BinaryClassificationEvaluator(
            rawPredictionCol="prob_congestion", metricName=metric, numBins=0).evaluate(scored)
        assert own == pytest.approx(want, abs=1e-12)


def _brute(rows):
    pos = sum(y for y, _ in rows)
    neg = len(rows) - pos
    points, ap, before = [], 0.0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp = sum(y for y, v in rows if v >= s)
        fp = sum(1 - y for y, v in rows if v >= s)
        points.append((s, tp, fp, tp / pos, fp / neg))
        ap += (tp - before) / pos * tp / (tp + fp)
        before = tp
    return points, ap


def test_roc_points_with_a_hot_score(spark):
    rng = random.Random(2)
    # A third of all rows have the same score; the rest are mostly distinct.
    rows = [(rng.randint(0, 1), 0.5) for _ in range(100)] + [(rng.randint(0, 1), rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, prob_congestion double").repartition(4)
    curve = evaluation.score_curve(df)
    points, ap = _brute(rows)
    got = sorted((tuple(r) for r in evaluation.roc_points(curve).collect() if r.threshold is not None), reverse=True)
    assert [g[:3] for g in got] == [p[:3] for p in points]
    assert all(g[3:] == pytest.approx(p[3:]) for g, p in zip(got, points))
    assert evaluation.roc_points(curve).where("threshold is null").count() == 1
    assert evaluation.curve_areas(curve).first().average_precision == pytest.approx(ap)


def test_areas_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "label int, prob_congestion double")
    row = evaluation.curve_areas(evaluation.score_curve(df)).first()
    assert row.auc_roc is None and row.average_precision == 1.0


def test_label_metrics_equal_mllib(samples):
    df = samples.select("label", (F.col("avg_speed") < 45).cast("double").alias("prediction_congested"))
    own = evaluation.label_metrics(df).first()
    for metric, got in (("accuracy", own.accuracy), ("f1", own.f1_weighted)):
        want = MulticlassClassificationEvaluator(
            predictionCol="prediction_congested", metricName=metric).evaluate(df)
        assert got == pytest.approx(want, abs=1e-12)
    assert sum(evaluation.confusion(df).first()) == 400
    assert evaluation.confusion_cells(df).agg(F.sum("count")).first()[0] == 400


def test_zero_division_and_evaluation_rows(spark):
    df = spark.createDataFrame([(0, 0.0, False), (0, 0.0, False)], "label int, prediction_congested double, is_test boolean")
    row = evaluation.label_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.f1_weighted) == (1.0, 0.0, 0.0, 0.0, 1.0)
    assert evaluation.evaluation_rows(df).count() == 2
    mixed = df.unionByName(df.limit(1).withColumn("is_test", F.lit(True)))
    assert evaluation.evaluation_rows(mixed).count() == 1


def test_feature_importance(spark):
    rows = scoring.feature_importance(spark, fv.PUBLISHED_COEFFICIENTS).collect()
    assert [r.feature for r in rows] == ["avg_speed", "hour", "weekday", "std_speed_hour"]
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows[0].importance == pytest.approx(0.8927135917033484)
    zero = scoring.feature_importance(spark, {"a": 0.0}).first()
    assert zero.importance == 0.0 and not math.isnan(zero.importance)


def test_certificate_tells_an_optimum_from_an_early_stop(samples, trained, monkeypatch):
    rows = horizon.train_rows(samples)
    told = certificates.logistic_certificate(rows, trained.model).first()
    assert told.rows == rows.count() and told.violation < 1e-3
    monkeypatch.setattr(fv, "MODEL_ITERATIONS", 1)
    early = training.train(samples).model
    assert certificates.logistic_certificate(rows, early).first().violation > 1e-2
    same = certificates.differing_scores(training.score(samples, trained.model), training.score(samples, trained.model)).first()
    assert same == (samples.count(), 0)
    other = certificates.differing_scores(training.score(samples, trained.model), training.score(samples, early)).first()
    assert other.differing > 0


def test_certificate_of_states(samples):
    fitted = states.fit_states(samples, 3, 3)
    assigned = states.assign_states(samples, fitted)
    told = certificates.state_certificate(assigned, fitted).first()
    assert (told.rows, told.states, told.not_nearest) == (samples.count(), 3, 0) and told.centre_gap < 0.05
    turned = assigned.withColumn("prediction", ((F.col("prediction") + 1) % 3).cast("int"))
    told = certificates.state_certificate(turned, fitted).first()
    assert told.not_nearest == samples.count() and told.centre_gap > 1


@pytest.mark.parametrize("pieces", [1, 7, 200])
def test_thinned_curve_is_short_and_close(spark, pieces):
    rng = random.Random(9)
    rows = [(int(rng.random() < s), s) for s in (round(rng.random(), 4) for _ in range(5000))]
    curve = evaluation.score_curve(spark.createDataFrame(rows, "label int, prob_congestion double"))
    points = evaluation.chart_points(curve, pieces).collect()
    assert len(points) <= 2 * pieces + 2 and {(0.0, 0.0), (1.0, 1.0)} <= {(p.fpr, p.tpr) for p in points}
    told = evaluation.chart_error(curve, pieces).first()
    assert told.points == len(points) and abs(told.error) <= told.bound == 0.5 / pieces
    one_class = evaluation.score_curve(spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, prob_congestion double"))
    assert len(evaluation.chart_points(one_class, pieces).collect()) <= 2 * pieces + 2
