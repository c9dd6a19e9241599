import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.catalog import data as d
from speedloom.operators import horizon, requests, training
from speedloom.sources.staging import stage
from speedloom.streaming import jobs

NOW = "2024-02-04 09:30:00"  # a Sunday


@pytest.fixture(scope="module")
def hourly(spark):
    return spark.createDataFrame([(8, 2.0), (9, 4.0), (10, None)], "hour int, std_speed_hour double")


def one(spark, hourly, **fields):
    raw = spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} string" for k in fields))
    prepared = requests.prepare_requests(raw, hourly, F.lit(NOW).cast("timestamp"))
    assert requests.accepted(prepared).count() + requests.rejected(prepared).count() == 1
    return requests.with_errors(prepared).first()


def test_defaults_from_now_and_lookup(spark, hourly):
    r = one(spark, hourly, avg_speed="42.5", std_speed_hour="auto", location="X")
    assert (r.avg_speed, r.hour, r.weekday, r.std_speed_hour, r.std_speed_auto) == (42.5, 9, 1, 4.0, True)
    assert r.timestamp == dt.datetime(2024, 2, 4, 9, 30) and r.errors == []


def test_given_values_win(spark, hourly):
    r = one(spark, hourly, avg_speed="1", std_speed_hour="7.5", hour="17", weekday="2",
            timestamp="2024-01-06 08:00:00")
    assert (r.hour, r.weekday, r.std_speed_hour, r.std_speed_auto) == (17, 2, 7.5, False)


def test_time_of_request_before_now(spark, hourly):
    r = one(spark, hourly, avg_speed="1", hour="24", weekday="0", timestamp="2024-01-06 08:00:00")
    assert (r.hour, r.weekday, r.std_speed_hour) == (8, 7, 2.0)


@pytest.mark.parametrize("hour, want", [("3", 3.0), ("10", 3.0)])
def test_mean_for_unknown_hours(spark, hourly, hour, want):
    assert one(spark, hourly, avg_speed="1", hour=hour).std_speed_hour == want


def test_fallback_without_table(spark, hourly):
    assert one(spark, hourly.limit(0), avg_speed="1", hour="3").std_speed_hour == fv.STD_FALLBACK


def test_missing_speed_is_an_error(spark, hourly):
    assert one(spark, hourly, avg_speed="abc").errors == [fv.ERROR_AVG_SPEED]
    assert one(spark, hourly, hour="3").errors == [fv.ERROR_AVG_SPEED]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return training.train(stage(d.samples(spark, sf_dir), "samples")).model


def test_stream_scores_equal_batch(spark, sf_dir, hourly, model, tmp_path):
    events = d.table(spark, sf_dir, "events")
    want = requests.prepare_requests(d.raw_requests(events), hourly)
    good = requests.score_requests(requests.accepted(want), model, "/m", "v1")
    stream = jobs.parquet_stream(spark, sf_dir, "events.parquet", d.EVENT_SCHEMA)
    out, rejects, progress = (str(tmp_path / n) for n in ("out", "rejects", "progress"))
    for _ in range(2):  # The second start finds nothing new.
        jobs.score_stream(d.raw_requests(stream), hourly, model, out, rejects, progress, "/m", "v1").awaitTermination()
    back = spark.read.parquet(out)
    key = ("event_id", "prediction", "prob_congestion", "status", "strategy.level", "model.path")
    known = "inputs.timestamp < '2024-06-01' and event_id % 6 <> 3"  # rows whose time is not 'now'
    assert sorted(values(back.where(known), *key)) == sorted(values(good.where(known), *key))
    assert back.count() + spark.read.parquet(rejects).count() == events.count()
    row = back.first()
    assert sum(row.probability_distribution) == pytest.approx(1.0)


def _file(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


SCHEMA = "ts timestamp, sensor string, speed double"


def at(minute, sensor, speed):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute), sensor, speed


def test_slot_means_drop_late_rows(spark, tmp_path):
    """Gaps count at the stored mean of their sensor; a sensor without one (c) takes no part."""
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    profile = spark.createDataFrame([("a", 20.0), ("b", 40.0), ("dead", None)], "sensor string, mean_speed double")

    def feed(*rows):
        _file(spark.createDataFrame(list(rows), SCHEMA), folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        jobs.run_available(jobs.stream_slot_means(stream, profile, 5), out, progress)

    feed(at(1, "a", 10.0), at(2, "a", 20.0), at(3, "b", 45.0), at(6, "a", 50.0), at(7, "c", 90.0), at(12, "c", 90.0))
    feed(at(60, "a", 70.0))
    feed(at(1, "b", 99.0), at(120, "a", 70.0))  # Long after the slot closed.
    got = {r.timestamp.minute: (r.avg_speed, r.sensors) for r in spark.read.parquet(out).where(
        "timestamp < '2024-01-01 00:30:00'").collect()}
    assert got == {0: (30.0, 2), 5: (45.0, 2), 10: (30.0, 1)}


def test_repeats_across_batches(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for _ in range(2):
        _file(spark.createDataFrame([at(1, "a", 1.0), at(1, "b", 2.0), at(1, "a", 1.0)], SCHEMA), folder)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        jobs.run_available(jobs.drop_repeats(stream, ["sensor", "ts"]), out, progress)
    assert sorted(values(spark.read.parquet(out), "sensor", "speed")) == [("a", 1.0), ("b", 2.0)]


PLAN_INPUT = "timestamp timestamp, avg_speed double, prob_congestion double"


def test_running_plan_takes_newest_measures(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def feed(*rows, progress=progress, folder=folder):
        _file(spark.createDataFrame([(at(m, "", 0)[0], v, p) for m, v, p in rows], PLAN_INPUT), folder)
        jobs.stream_plan(spark.readStream.schema(PLAN_INPUT).parquet(folder), out, progress).awaitTermination()

    def plan():
        return {r.hour: (r.avg_prob, r.avg_speed, r.count_samples, r.green_extension_pct)
                for r in jobs.stored_plan(spark, out, 15).collect()}

    assert plan() == {}
    feed((5, 40.0, 0.2), (65, 40.0, 0.9))
    feed((10, 60.0, 0.8))
    assert plan() == {0: (0.5, 50.0, 2, 20), 1: (0.9, 40.0, 1, 30)}
    # A new checkpoint counts its batches from 0 again; its hours win, and those that it has not seen stay.
    feed((7, 30.0, 0.1), progress=progress + "-anew", folder=folder + "-anew")
    assert plan() == {0: (0.1, 30.0, 1, -10), 1: (0.9, 40.0, 1, 30)}


def test_plan_store_is_merged_and_survives_repeats(spark, tmp_path):
    out = str(tmp_path / "plan")
    schema = "date date, hour int, avg_prob double, avg_speed double, count_samples long"
    day = dt.date(2024, 1, 1)
    batches = 2 * jobs.MERGE_AFTER + 3
    for i in range(batches):
        rows = [(day, i % 5, i / 100, 40.0, i), (day, 23, 0.5, 40.0, i)]
        for _ in range(1 + (i == 3)):  # one batch is repeated
            jobs.upsert_measures(spark.createDataFrame(rows, schema), out, 1000, i)
    got = {r.hour: r.count_samples for r in jobs.stored_measures(spark, out).collect()}
    assert got == {**{i % 5: i for i in range(batches)}, 23: batches - 1}
    manifest = jobs.read_manifest(spark, out)
    assert len(manifest.folders) <= jobs.MERGE_AFTER
    stored = spark.read.parquet(*[f"{out}/data/{x}" for x in manifest.folders]).count()
    assert stored <= 6 + 2 * jobs.MERGE_AFTER
    jobs.upsert_measures(spark.createDataFrame([(day, 23, 0.1, 1.0, -1)], schema), out, 999, 500)  # an older run
    assert {r.hour: r.count_samples for r in jobs.stored_measures(spark, out).collect()}[23] == batches - 1
