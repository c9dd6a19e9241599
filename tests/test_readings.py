import datetime as dt

from conftest import values
from pyspark.sql import functions as F

from speedloom.functions.lenient import lenient_double, lenient_int, lenient_timestamp
from speedloom.functions.readings import bin_lower, parse_time, valid_speed
from speedloom.sources import readings as rd

CSV = """timestamp,717498,718141,769373
3/1/2012 0:00,64.4,0,61.0
3/1/2012 0:05,NaN,120,
3/1/2012 0:10,120.01,-3,59.5
2012-03-01 00:15:00,60.0,58.0,57.0
bad time,61.0,59.0,58.0
3/1/2012 0:25,abc,55.5,56.5
"""


def test_wide_csv_to_readings(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    wide = rd.typed_wide(rd.read_wide_csv(spark, str(tmp_path / "in.csv"), "no such column"))
    assert wide.columns == ["timestamp", "time_text", "717498", "718141", "769373"]
    rd.write_wide_as_readings(wide, str(tmp_path / "r"))
    assert values(rd.stored_counts(spark, str(tmp_path / "r"), 3)) == [(6, 5, 1)]
    assert values(rd.read_rejects(spark, str(tmp_path / "r"))) == [("bad time", None, None)]
    readings = rd.wide_to_readings(wide)
    assert sorted(values(readings), key=str) == sorted(values(rd.read_readings(spark, str(tmp_path / "r")), "ts", "sensor", "speed"), key=str)
    got = {(r.ts.minute, r.sensor): r.speed for r in readings.collect()}
    assert len(got) == 15
    assert [got[m, "717498"] for m in (0, 5, 10, 15, 25)] == [64.4, None, None, 60.0, None]
    assert [got[m, "718141"] for m in (0, 5, 10, 15, 25)] == [None, 120.0, None, 58.0, 55.5]
    assert got[5, "769373"] is None


def test_csv_without_header_and_other_delimiter(spark, tmp_path):
    (tmp_path / "in.csv").write_text("3/1/2012 0:00;10;20\n3/1/2012 0:05;30;x\n")
    wide = rd.typed_wide(rd.read_wide_csv(spark, str(tmp_path / "in.csv"), header=False, delimiter=";"))
    assert values(wide, "_c1", "_c2") == [(10.0, 20.0), (30.0, None)]


def test_long_readings_round_trip(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:00' + make_interval(0,0,0,0,id) timestamp, "
                   "cast(id % 3 as string) sensor, cast(id as double) speed FROM range(100)")
    df.write.parquet(str(tmp_path / "in"))
    df.select(F.date_format("timestamp", "M/d/yyyy H:mm").alias("t"), F.col("sensor").alias("s"), F.col("speed").alias("v")).write.option(
        "header", True).csv(str(tmp_path / "csv"))
    for i, raw in enumerate((rd.read_long(spark, str(tmp_path / "in")), rd.read_long(spark, str(tmp_path / "csv"), "t", "s", "v"))):
        rd.write_readings(rd.typed_long(raw), str(tmp_path / f"r{i}"))
        back = rd.read_readings(spark, str(tmp_path / f"r{i}"))
        assert back.count() == 100 and back.select("date").distinct().count() == 5
        assert values(rd.stored_counts(spark, str(tmp_path / f"r{i}"))) == [(100, 100, 0)]
    late = rd.typed_long(rd.read_long(spark, str(tmp_path / "csv"), "t", "s", "v"), zone="Asia/Ho_Chi_Minh")
    assert late.agg(F.min("timestamp")).first()[0] == dt.datetime(2024, 1, 1, 3, 0)


def test_valid_speed_edges(spark):
    df = spark.createDataFrame([("0",), ("120",), ("120.01",), ("-3",), ("NaN",), ("",), ("abc",), ("0.01",),
                                ("inf",), (None,)], "v string")
    got = [r[0] for r in df.select(valid_speed(F.col("v"))).collect()]
    assert got == [None, 120.0, None, None, None, None, None, 0.01, None, None]


def test_parse_time_formats(spark):
    df = spark.createDataFrame([("3/1/2012 0:05",), ("2012-03-01 00:05:00",), ("2012-03-01T00:05:00",),
                                ("12/31/2012 23:50",), ("bad",), ("",), ("2012",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_time(F.col("t"))).collect()]
    first = dt.datetime(2012, 3, 1, 0, 5)
    assert got == [first, first, first, dt.datetime(2012, 12, 31, 23, 50), None, None, None, None]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("",), (" auto ",), ("17.9",), ("24",), ("0",), ("nan",), ("inf",), ("-0.5",),
                                (" 8 ",), ("1e300",), ("1.5d",), ("1e999",), (None,)], "v string")
    got = values(df.select(lenient_double(F.col("v")), lenient_int(F.col("v"), 0, 23)))
    assert got == [(None, None), (None, None), (17.9, 17), (24.0, None), (0.0, 0), (None, None), (None, None),
                   (-0.5, 0), (8.0, 8), (1e300, None), (None, None), (None, None), (None, None)]


def test_lenient_timestamp(spark):
    df = spark.createDataFrame([("1704067200",), ("2024-01-01 00:00:00",), ("1/1/2024 0:00",), ("soon",),
                                ("1e300",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(lenient_timestamp(F.col("v"))).collect()]
    t = dt.datetime(2024, 1, 1)
    assert got == [t, t, t, None, None, None, None]


def test_bin_lower(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (63.2,)], "v double")
    assert [r[0] for r in df.select(bin_lower(F.col("v"))).collect()] == [0.0, 0.0, 5.0, 60.0]
