import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from speedloom.operators import cleaning, features
from speedloom.sources import readings as rd

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(3)
    data = [(T0 + dt.timedelta(minutes=5 * i),
             *[None if rng.random() < 0.2 else round(rng.uniform(1, 119), 2) for _ in range(6)], None)
            for i in range(300)]
    return spark.createDataFrame(data, "timestamp timestamp, " + ", ".join(
        f"`10{i}` double" for i in range(6)) + ", dead double")


@pytest.fixture(scope="module")
def cells(wide):
    return cleaning.slot_cells(rd.wide_to_readings(wide), 5)


def test_long_mean_equals_wide_mean(wide, cells):
    sensors = [c for c in wide.columns if c not in ("timestamp", "dead")]
    want = dict(values(cleaning.wide_row_mean(cleaning.fill_wide(wide, sensors), sensors),
                       "timestamp", "avg_speed"))
    for means in (None, cleaning.sensor_profile(cells)):
        got = dict(values(features.slot_average(cells, means)))
        assert got.keys() == want.keys()
        assert all(got[t] == pytest.approx(want[t], abs=1e-9) for t in want)


def test_profile_counts_absent_and_rejected_cells(wide, cells):
    present = cells.where(F.col("speed").isNotNull() | (F.col("sensor") == "dead"))
    for frame in (cells, present):
        got = {r.sensor: r for r in cleaning.sensor_profile(frame).collect()}
        for c in wide.columns[1:]:
            missing = wide.where(F.col(f"`{c}`").isNull()).count()
            assert got[c].missing_count == missing
            assert got[c].missing_pct == round(missing / 300 * 100, 2)
            assert got[c].missing_after_fill == (300 if c == "dead" else 0)
    top = values(cleaning.missing_profile(cleaning.sensor_profile(cells), 3))
    assert top[0][:2] == ("dead", 300) and len(top) == 3 and top[1][1] >= top[2][1]


def test_duplicate_readings_are_averaged(spark):
    df = spark.createDataFrame([(T0, "a", 10.0), (T0, "a", 20.0), (T0, "b", 30.0)],
                               "ts timestamp, sensor string, speed double")
    assert values(features.slot_average(cleaning.slot_cells(df, 5)), "avg_speed") == [(22.5,)]


def test_all_sensors_dead(spark):
    df = spark.createDataFrame([(T0, "a", None)], "ts timestamp, sensor string, speed double")
    assert features.slot_features(cleaning.slot_cells(df, 5)).count() == 0


def test_calendar_and_single_row_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 23, 5), 50.0)], "timestamp timestamp, avg_speed double")
    row = features.with_hourly_spread(features.with_calendar(df)).first()
    assert (row.hour, row.weekday, row.std_speed_hour) == (23, 1, 0.0)


def test_hourly_spread_equals_window(wide, cells):
    from pyspark.sql import Window
    base = features.with_calendar(features.slot_average(cells))
    want = dict(values(base.withColumn("s", F.stddev_samp("avg_speed").over(Window.partitionBy("hour"))),
                       "timestamp", "s"))
    got = dict(values(features.slot_features(cells), "timestamp", "std_speed_hour"))
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t] or 0.0, abs=1e-9) for t in want)


def test_outlier_rule(spark):
    speeds = [50.0 + i * 0.1 for i in range(100)] + [5.0, 4.0, 110.0, 111.0, 20.0]
    df = spark.createDataFrame([(v,) for v in speeds], "avg_speed double")
    bounds = cleaning.iqr_bounds(df)
    b = bounds.first()
    assert b.lower_bound == pytest.approx(b.q1 - 2.5 * b.iqr)
    for given in (bounds, b, cleaning.iqr_bounds(df, exact=False)):
        assert cleaning.drop_outliers(df, given).count() == 100
    assert values(cleaning.outlier_counts(cleaning.flag_outliers(df, b))) == [(105, 100, 5, 4.76)]
    # Wide fences leave the hard limits, which are exclusive.
    loose = cleaning.iqr_bounds(df, factor=1000.0).first()
    assert cleaning.drop_outliers(df, loose).agg(F.min("avg_speed"), F.max("avg_speed")).first()[:] == (
        20.0, pytest.approx(59.9))


def test_no_fences_no_outliers(spark):
    empty = spark.createDataFrame([], "avg_speed double")
    df = spark.createDataFrame([(3.0,)], "avg_speed double")
    assert cleaning.drop_outliers(df, cleaning.iqr_bounds(empty)).count() == 1
    assert cleaning.drop_outliers(df, cleaning.iqr_bounds(empty).first()).count() == 1


def test_finite_speeds(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)],
                               "avg_speed double")
    assert values(cleaning.finite_speeds(df)) == [(1.0,)]
