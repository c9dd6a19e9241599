"""The whole job over a wide CSV made from the events table."""

import json

import pytest
from pyspark.sql import functions as F

from speedloom.plans import job


@pytest.fixture(scope="module")
def wide_csv(spark, sf_dir, tmp_path_factory):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = str(tmp_path_factory.mktemp("csv") / "wide")
    sensors = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]
    wide = events.groupBy(F.date_trunc("hour", "ts").alias("t")).pivot("event_type", sensors).agg(F.avg("value"))
    wide.select(F.date_format("t", "M/d/yyyy H:mm").alias("timestamp"), *sensors).coalesce(1).write.option(
        "header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def result(spark, wide_csv, tmp_path_factory):
    return job.run(spark, wide_csv, str(tmp_path_factory.mktemp("out")), kmin=2, kmax=3, horizon_min=120,
                   freq_min=60, cleaned_csv=True)


def test_all_tables_written(spark, result):
    assert result.skipped is None and result.k in (2, 3)
    assert {"readings", "cells", "slots", "cleaned", "cleaned_data", "evaluation/metrics", "evaluation/grid_scores", "clustered", "silhouette_scores", "cluster_summary",
            "predictions", "signal_plan", "signal_plan_json",
            "models/logistic_pipeline", "models/hourly_spread"} <= result.tables.keys()
    assert sum(t.startswith("analysis/") for t in result.tables) == 12
    for name, path in result.tables.items():
        if not name.startswith("models/logistic") and "csv" not in name:
            fmt = "json" if name.split("/")[0] in ("analysis", "charts") or name.endswith("json") else None
            if fmt:
                assert not spark.read.json(path).isEmpty(), name


def test_reports_sum_to_the_overview(spark, result):
    read = lambda n: spark.read.json(result.tables[f"analysis/{n}"])
    overview = read("overview").first()
    assert overview.generated_at
    for name in ("cluster_distribution", "hourly_summary", "histogram_avg_speed", "daily_avg_speed"):
        assert read(name).agg(F.sum("count")).first()[0] == overview.total_rows
    assert read("logistic_feature_importance").agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert result.metrics["samples"] == overview.total_rows
    assert 0 <= result.metrics["auc_roc"] <= 1
    json.dumps(result.metrics)


def test_cleaned_csv_is_wide_and_filled(spark, result):
    cleaned = spark.read.option("header", True).csv(result.tables["cleaned_data"])
    slots = spark.read.parquet(result.tables["slots"])
    assert cleaned.count() == slots.count()
    assert cleaned.columns[0] == "timestamp" and cleaned.columns[-4:] == [
        "avg_speed", "hour", "weekday", "std_speed_hour"]
    assert cleaned.dropna().count() == cleaned.count()
    sensors = cleaned.columns[1:-4]
    off = cleaned.where(F.abs(sum((F.col(s).cast("double") for s in sensors), F.lit(0.0)) / len(sensors)
                              - F.col("avg_speed").cast("double")) > 1e-9)
    assert off.count() == 0


def test_a_rerun_keeps_finished_steps(spark, wide_csv, result):
    out = result.tables["slots"].rsplit("/", 1)[0]
    asked = {"kmin": 2, "kmax": 3, "horizon_min": 120, "freq_min": 60, "cleaned_csv": True}
    again = job.run(spark, wide_csv, out, **asked)
    assert again.reused == ["readings", "slots", "states", "model", "predictions", "reports"]
    assert (again.k, again.tables, again.metrics) == (result.k, result.tables, result.metrics)
    # What depends on a changed parameter runs anew.
    other = job.run(spark, wide_csv, out, **asked | {"label": "time"})
    assert other.reused == ["readings", "slots", "states"] and other.skipped is None
    back = job.run(spark, wide_csv, out, **asked)  # the tables of the other choice stand there now
    assert back.reused == ["readings", "slots", "states"] and back.metrics["samples"] == result.metrics["samples"]


def test_long_readings_in_another_zone_with_a_time_split(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.select(F.date_format("ts", "M/d/yyyy H:mm").alias("when"), F.col("event_type").alias("station"), F.col("value").alias("kmh"))
    bad = spark.createDataFrame([("never", "click", 50.0), ("1/2/2024 3:00", None, 50.0)], rows.schema)
    rows.unionByName(bad).coalesce(3).write.option("header", True).csv(str(tmp_path / "in"))
    out = job.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), layout="long", time_col="when", sensor_col="station", speed_col="kmh",
                  kmin=2, kmax=2, horizon_min=60, freq_min=60, split="time", label="time", source_zone="Asia/Ho_Chi_Minh", flag_only=True)
    assert out.skipped is None and out.metrics["rejected_rows"] == 1 and out.metrics["valid_rows"] == events.count()
    first = spark.read.parquet(out.tables["cells"]).agg(F.min("ts")).first()[0]
    assert first == events.agg(F.date_trunc("hour", F.min("ts")) - F.expr("interval 7 hours")).first()[0]
    slots = spark.read.parquet(out.tables["slots"])
    assert {"is_test", "is_outlier"} <= set(slots.columns) and slots.where("is_test is null").count() > 0
    samples = spark.read.parquet(out.tables["samples_60m"])
    assert samples.where("is_test is null").count() == 0 and samples.where("is_test").count() > 0


def test_unreadable_input_stops_early(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("timestamp,1,2\nnot a time,50,60\n")
    out = job.run(spark, str(tmp_path / "bad.csv"), str(tmp_path / "out"))
    assert out.skipped == "no usable slots" and out.metrics["rejected_rows"] == 1


def test_requests_are_answered_with_the_stored_model(spark, result, tmp_path):
    from speedloom.streaming import jobs
    base = result.tables["slots"].rsplit("/", 1)[0]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.json").write_text("\n".join([
        json.dumps({"avg_speed": 12.5, "std_speed_hour": "auto", "hour": 17, "weekday": 2, "location": "A"}),
        json.dumps({"avg_speed": "90", "hour": "8"}), json.dumps({"hour": 8})]))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    jobs.serve_requests(spark, str(tmp_path / "in"), base, out, bad, str(tmp_path / "cp")).awaitTermination()
    rows = {r.inputs.avg_speed: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {12.5, 90.0} and spark.read.parquet(bad).count() == 1
    slow = rows[12.5]
    assert slow.inputs.location == "A" and slow.inputs.std_speed_auto and slow.inputs.std_speed_hour > 0
    assert slow.model.path.endswith("logistic_pipeline") and slow.model.last_modified[:2] == "20"
    assert sum(slow.probability_distribution) == pytest.approx(1.0)
