import datetime as dt
import os
import statistics

import pytest
from conftest import values
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.catalog import data as d
from speedloom.functions.probability import with_probability
from speedloom.functions.signals import green_extension_pct, serving_strategy, signal_level, strategy_text
from speedloom.operators import chartdata, plan, reports
from speedloom.plans import report_cube
from speedloom.sources import tables_io as io
from speedloom.sources.staging import stage


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return stage(d.scored(spark, sf_dir), "scored")


@pytest.fixture(scope="module")
def tables(scored):
    return report_cube.report_tables(stage(report_cube.base_cube(scored), "cube"))


def test_grouped_reports_add_up(tables):
    total = tables["overview"].first().total_rows
    assert len(tables) == 9 and total > 0
    for name, table in tables.items():
        if name not in ("overview", "top_congestion"):
            assert table.agg(F.sum("count")).first()[0] == total, name


def test_measures_of_the_cube_are_those_of_the_rows(scored, tables):
    """Spread, means and bounds of the rows themselves."""
    rows = values(scored, "hour", "avg_speed", "prob_congestion", "prediction_congested", "timestamp")
    for r in tables["hourly_summary"].collect():
        mine = [x for x in rows if x[0] == r.hour]
        assert r.avg_speed == pytest.approx(statistics.fmean(x[1] for x in mine), abs=1e-9)
        assert r.avg_prob_congestion == pytest.approx(statistics.fmean(x[2] for x in mine), abs=1e-9)
        assert r.std_speed_hour == pytest.approx(statistics.stdev(x[1] for x in mine), abs=1e-9) if len(mine) > 1 else r.std_speed_hour is None
    whole = tables["overview"].first()
    assert whole.congestion_ratio == pytest.approx(statistics.fmean(x[3] for x in rows), abs=1e-9)
    assert (whole.start_time, whole.end_time) == (min(x[4] for x in rows), max(x[4] for x in rows))


def test_top_list_is_sorted_and_short(tables):
    rows = tables["top_congestion"].collect()
    assert len(rows) <= 20 and all(a.avg_prob >= b.avg_prob for a, b in zip(rows, rows[1:]))


def test_shown_totals_fall_back_to_the_newest_run(scored, tables):
    hourly, states = tables["hourly_summary"], tables["cluster_distribution"]
    calls = []
    newest = lambda: calls.append(1) or scored
    told = reports.shown_totals(hourly, states, newest).first()
    assert told.source == "report" and not calls
    untold = reports.shown_totals(hourly.withColumn("std_speed_hour", F.lit(None).cast("double")), states, newest).first()
    assert untold.source == "run" and calls and untold.hourly_std_avg == pytest.approx(told.hourly_std_avg)


def test_top_sensor_means_are_speeds_not_ids(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) ts, "
                   "cast(717498 + id % 7 as string) sensor, 60.0D speed FROM range(1000)")
    out = reports.top_sensor_hourly(df)
    assert out.select("sensor").distinct().count() == 5
    assert out.where("avg_speed <> 60").count() == 0


def test_required_columns(scored):
    reports.require_columns(scored)
    with pytest.raises(ValueError, match="avg_speed"):
        reports.require_columns(scored.drop("avg_speed"))


def test_ladder(spark):
    probs = [0.7, 0.69, 0.5, 0.3, 0.29, None, float("nan")]
    df = spark.createDataFrame([(p,) for p in probs], "p double")
    pct = green_extension_pct(F.col("p"))
    got = values(df.select(pct, signal_level(F.col("p"))))
    assert got == [(30, "critical"), (20, "high"), (20, "high"), (10, "moderate"), (-10, "low"),
                   (0, "unknown"), (0, "unknown")]
    texts = [r[0] for r in df.select(strategy_text(F.col("p"))).collect()]
    assert texts[0] == "Kéo dài pha xanh thêm 30%" and texts[4] == "Rút ngắn pha xanh 10%"
    assert texts[5] == fv.TEXT_UNKNOWN
    served = df.select(serving_strategy(F.col("p")).alias("s")).collect()[4].s
    assert served.strategy == "Rút ngắn pha xanh 10% để ưu tiên hướng khác"


PLAN_TEXT = ", ".join(f"{c} string" for c in io.PLAN_COLUMNS)


def test_plan_round_trip_and_bad_rows(spark, scored, tmp_path):
    path = str(tmp_path / "plan")
    full = plan.signal_plan(scored, 15)
    io.write_plan_csv(full, path)
    back = io.read_signal_plan(spark, path, rows=10_000)
    assert back.count() == full.count()
    bad = spark.createDataFrame(
        [("not a date", "1", "0.5", "50", "3", "10", "s", "15"), ("2024-05-01", "x", "?", "", "2.0", "10", "s", "15"),
         ("2024-05-01", "3", "0.123456", "50.129", "2", "10", "s", "15")], PLAN_TEXT)
    rows = io.head_of_plan(io.coerce_plan(bad)).collect()
    assert [(r.hour, r.avg_prob, r.avg_speed, r.count_samples, r.avg_prob_percent) for r in rows] == [
        (3, 0.123456, 50.13, 2, 12.3), (None, None, None, 2, None)]


def test_display_rounding_does_not_hang_on_the_last_bit(spark):
    """Means that end in 5 at the third decimal, from sums in different orders."""
    near = [(36.145,), (36.144999999999996,), (36.14500000000001,)]
    df = spark.createDataFrame(near, "avg_speed double").selectExpr("avg_speed", "0.5d as avg_prob", "date'2024-01-01' as date", "1 as hour", "15 as horizon_min", "1L as count_samples")
    assert {r.avg_speed for r in io.head_of_plan(df).collect()} == {36.15}
    assert {r.avg_speed for r in plan.riskiest(df).collect()} == {36.15}


def test_plan_files_by_their_own_header(spark, tmp_path):
    folder = tmp_path / "plan"
    folder.mkdir()
    (folder / "a.csv").write_text("date,hour,avg_prob,avg_speed,count_samples,green_extension_pct,strategy,horizon_min\n2024-05-01,3,0.5,50,2,20,s,15\n")
    (folder / "b.csv").write_text('"horizon_min",Hour,"date",extra,strategy\n30,4,2024-05-02,?,"a, b"\n')
    (folder / "c.csv").write_text("\ufeffdate,hour\n2024-05-03,5\n")
    (folder / "d.csv").write_text("")
    rows = [(r.date.day, r.hour, r.avg_prob, r.strategy, r.horizon_min) for r in io.read_signal_plan(spark, str(folder)).collect()]
    assert rows == [(1, 3, 0.5, "s", 15), (2, 4, None, "a, b", 30), (3, 5, None, None, None)]


def test_newest_files_only(spark, tmp_path):
    for i in range(12):
        folder = tmp_path / f"p{i:02d}"
        spark.createDataFrame([(f"2024-01-{i + 1:02d}", "1", "0.5", "50", "1", "20", "s", "15")],
                              PLAN_TEXT).coalesce(1).write.option("header", True).csv(str(folder))
        for f in folder.glob("*.csv"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    got = [r.date.day for r in io.read_signal_plan(spark, str(tmp_path)).collect()]
    assert got == [12]


def test_report_reader_keeps_first_place(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 10.0), (1, 10.0), (2, 20.0)], "hour int, v double").repartition(3).write.json(a)
    spark.createDataFrame([(2, 99.0), (3, 30.0)], "hour int, v double").write.json(b)
    out = io.read_report(spark, [a, b], "hour int, v double", ("hour",))
    assert sorted(values(out)) == [(1, 10.0), (2, 20.0), (3, 30.0)]


def test_report_reader_keeps_rows_by_place_and_not_by_value(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"hour": 1, "v": 9}\n{"hour": 1, "v": 2}\n{"hour": 2, "v": 7}\n')
    (folder / "part-1.json").write_text('{"hour": 1, "v": 1}\n{"hour": 3, "v": 5}\n{"hour": 3, "v": 4}\n')
    out = io.read_report(spark, [str(folder)], "hour int, v double", ("hour",))
    assert sorted(values(out)) == [(1, 9.0), (2, 7.0), (3, 5.0)]


def test_predictions_one_dataset_for_all_horizons(spark, scored, tmp_path):
    path = str(tmp_path / "pred")
    runs = [io.write_predictions(scored, path, h) for h in (15, 30)]
    day = scored.agg(F.max(F.to_date("timestamp"))).first()[0]
    fewer = scored.where(F.to_date("timestamp") == F.lit(day))
    io.write_predictions(fewer, path, 15)  # a rerun over fewer dates leaves none of the former
    assert [io.read_predictions(spark, x).count() for x in runs] == [fewer.count(), scored.count()]


def test_rebuilt_time(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 5)], "date date, hour int")
    assert values(io.with_rebuilt_time(df), "timestamp") == [(dt.datetime(2024, 1, 2, 5),)]
    with pytest.raises(ValueError):
        io.with_rebuilt_time(df.drop("hour"))


def test_horizon_token(spark):
    names = {"predict_15m": "15m", "predict_1H": "1h", "predict_30": "30m", "predict_007m": "7m",
             "predict_xm": "xm", "predict_abc": None, "predict_": None, "20": "20m", "": None}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert dict(values(df.select("n", io.horizon_token(F.col("n"))))) == names


def test_run_catalog_and_newest_run(spark, scored, tmp_path):
    base = str(tmp_path)
    scored.select("hour", "avg_speed").coalesce(1).write.parquet(f"{base}/predict_15m")
    spark.range(3).coalesce(1).write.parquet(f"{base}/predict_1h")
    for i, name in enumerate(("predict_15m", "predict_1h")):
        for f in (tmp_path / name).glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    got = values(io.run_catalog(spark, base), "run_name", "horizon", "files")
    assert got == [("predict_15m", "15m", 1), ("predict_1h", "1h", 1)]
    # The newest run lacks the columns, so the one before it is taken.
    newest = io.newest_run(spark, base)
    assert newest.count() == scored.count()
    assert reports.hourly_std_of_run(newest).first()[0] > 0
    with pytest.raises(ValueError):
        io.newest_run(spark, base, ("no_such",))


@pytest.mark.parametrize("make, want", [
    (lambda: array_to_vector(F.array(F.lit(0.25), F.lit(0.75))), 0.75),
    (lambda: F.array(F.lit(0.25), F.lit(0.75)), 0.75),
    (lambda: F.array(F.lit(0.25)), None),
    (lambda: F.struct(F.array(F.lit(0.25), F.lit(0.75)).alias("values")), 0.75),
    (lambda: F.lit(0.6), 0.6), (lambda: F.lit("text"), None)])
def test_probability_forms(spark, make, want):
    df = spark.range(1).select(make().alias("probability"))
    assert with_probability(df).first().prob_congestion == want


def test_no_probability(spark):
    assert with_probability(spark.range(1)).first().prob_congestion is None


def test_series_and_tables(scored):
    assert chartdata.series_head(scored, 7).count() == 7
    tail = [r.timestamp for r in chartdata.series_tail(scored, 9).collect()]
    assert len(tail) == 9 and tail == sorted(tail)
    shown = chartdata.last_rows(scored, 5)
    assert "weight" not in shown.columns and shown.count() == 5


def test_density_is_close_to_the_plain_sum(spark):
    import math
    import random
    rng = random.Random(1)
    vs = [min(119.0, max(1.0, rng.gauss(55, 9))) for _ in range(800)]
    df = spark.createDataFrame([("a", v) for v in vs] + [("b", 5.0)], "cluster_label string, avg_speed double")
    grid = chartdata.kde_grid(df).collect()
    assert {r.cluster_label for r in grid} == {"a"} and len(grid) == 61
    h = grid[0].bandwidth
    for r in grid:
        plain = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in vs) / (800 * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(plain, abs=2e-5)
    assert sum(r.density * 2 for r in grid) == pytest.approx(1.0, abs=0.01)


def test_empty_input_keeps_the_columns(scored):
    from speedloom.operators import cleaning, evaluation
    none = scored.limit(0)
    cube = report_cube.base_cube(none)
    assert report_cube.report(cube, "hourly_summary").collect() == []
    assert evaluation.run_summary(none).first().positive_share is None
    flagged = cleaning.flag_outliers(none, cleaning.iqr_bounds(none))
    assert cleaning.outlier_counts(flagged).first().removed_pct is None
    assert report_cube.report(cube, "overview").first().total_rows == 0
    assert chartdata.kde_grid(none.withColumn("cluster_label", F.lit("a"))).count() == 0
