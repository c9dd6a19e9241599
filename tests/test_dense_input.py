"""Events so dense that all slots are in one state and every hour's maximum is above the limit."""

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from speedloom.catalog.queries import QUERIES
from speedloom.operators import certificates, horizon, training
from speedloom.plans import job


@pytest.fixture(scope="module")
def dense_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dense")
    duckdb.sql(f"""
        COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_minutes(CAST(10 * i AS BIGINT)) AS ts, i % 7 AS user_id,
                     CASE WHEN i % 2 = 0 THEN 'click' ELSE 'view' END AS event_type,
                     CASE WHEN i % 6 IN (0, 1) THEN 130.5 ELSE 35 + (i % 5) * 0.25 END AS value, '' AS props
              FROM range(2160) t(i)) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", ["logistic_certificate", "served_requests", "whole_job_tables"])
def test_equal_to_sql(spark, dense_dir, name):
    status, _, note = compare.compare(spark, compare.connect(dense_dir), name, dense_dir)
    assert status == "ok", note


def test_every_sample_is_scored(spark, dense_dir):
    rows = QUERIES["train_logistic"](spark, dense_dir).agg(F.count("*"), F.sum("label"), F.sum("prob_congestion")).first()
    assert rows[0] == rows[1] == rows[2] > 0


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_is_certain(spark, tmp_path, label):
    rows = spark.range(60).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        (F.col("id") % 9 + 30.0).alias("avg_speed"), (F.col("id") % 24).alias("hour"), F.lit(2).alias("weekday"),
        F.lit(1.5).alias("std_speed_hour"), F.lit(label).alias("label"))
    samples = horizon.with_class_weight(horizon.with_test_flag(rows))
    assert training.train(samples).model is None
    training.save_model(training.model_of(samples), str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    scores = training.score(samples, loaded).select("prob_congestion", "prediction_congested").distinct().collect()
    assert [tuple(r) for r in scores] == [(float(label), float(label))]
    assert certificates.logistic_certificate(horizon.train_rows(samples), loaded).first().violation == 0
    with pytest.raises(ValueError, match="no labelled samples"):
        training.model_of(samples.limit(0))


def test_readings_are_reported_without_a_usable_slot(spark, tmp_path):
    (tmp_path / "fast.csv").write_text("timestamp,1,2\n1/1/2024 3:00,150,160\n1/1/2024 4:00,150,160\n")
    out = job.run(spark, str(tmp_path / "fast.csv"), str(tmp_path / "out"))
    assert out.skipped == "no usable slots"
    assert sorted(tuple(r) for r in spark.read.json(out.tables["analysis/sensor_activity"]).select("sensor", "count").collect()) == [
        ("1", 0), ("2", 0)]
