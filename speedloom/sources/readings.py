"""Readings table: one row per (time, sensor, speed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speedloom import fixed_values as fv
from speedloom.functions.readings import parse_time, valid_speed


def clean_readings(raw: DataFrame, ts: str = "ts", sensor: str = "sensor",
                   speed: str = "speed") -> DataFrame:
    """Canonical readings: rows without time or sensor dropped, invalid speeds nulled."""
    return (
        raw.select(
            F.col(ts).alias("ts"),
            F.col(sensor).alias("sensor"),
            valid_speed(F.col(speed)).alias("speed"),
        )
        # Stated once here, so every consumer shares the same scan and exchange.
        .where(F.col("ts").isNotNull() & F.col("sensor").isNotNull())
    )


def events_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table seen as readings: event type = sensor, value = speed."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return clean_readings(events, "ts", "event_type", "value")


def read_wide_csv(spark: SparkSession, path: str, time_col: str = "timestamp",
                  header: bool = True, delimiter: str = ",") -> DataFrame:
    """Wide CSV as text: ``timestamp`` plus one column per sensor.

    No type inference: it costs a pass and turns ISO times into another type than
    US-style ones. A missing ``time_col`` falls back to the first column.
    """
    raw = (
        spark.read.option("header", header)
        .option("sep", delimiter)
        .option("enforceSchema", not header)
        .csv(path)
    )
    chosen = time_col if time_col in raw.columns else raw.columns[0]
    return raw.withColumnRenamed(chosen, "timestamp")


def sensor_columns(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c not in ("timestamp", "time_text")]


def in_zone(ts: Column, zone: str | None) -> Column:
    """The instant of a time that was written down in ``zone`` (default: the session's)."""
    if zone is None:
        return ts
    return F.convert_timezone(F.lit(zone), F.current_timezone(), ts.cast("timestamp_ntz")).cast("timestamp")


def typed_wide(wide_text: DataFrame, formats: tuple[str, ...] = fv.TIME_FORMATS, zone: str | None = None) -> DataFrame:
    """Wide text frame with parsed times (``time_text`` as it was) and validated speeds."""
    return wide_text.select(
        in_zone(parse_time(F.col("timestamp"), formats), zone).alias("timestamp"),
        F.col("timestamp").cast("string").alias("time_text"),
        *[valid_speed(F.col(f"`{c}`")).alias(c) for c in sensor_columns(wide_text)],
    )


def read_long(spark: SparkSession, path: str, time_col: str = "timestamp", sensor_col: str = "sensor",
              speed_col: str = "speed", header: bool = True, delimiter: str = ",") -> DataFrame:
    """Long readings, Parquet or CSV (by the name of the first file), as time, sensor and speed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    first = files.orderBy("path").where(~F.col("path").rlike(r"/[_.][^/]*$")).first()
    if first is not None and ".parquet" in first.path.rsplit("/", 1)[-1]:
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.option("header", header).option("sep", delimiter).option("enforceSchema", not header).csv(path)
    names = [c if c in raw.columns else raw.columns[i] for i, c in enumerate((time_col, sensor_col, speed_col))]
    return raw.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(names, ("timestamp", "sensor", "speed"))])


def typed_long(raw: DataFrame, formats: tuple[str, ...] = fv.TIME_FORMATS, zone: str | None = None) -> DataFrame:
    """Long frame with parsed times (``time_text`` as it was) and validated speeds; no sensor, no reading."""
    is_text = raw.schema["timestamp"].dataType == T.StringType()
    ts = parse_time(F.col("timestamp"), formats) if is_text else F.col("timestamp").cast("timestamp")
    return raw.where(F.col("sensor").isNotNull()).select(
        in_zone(ts, zone).alias("timestamp"), F.col("timestamp").cast("string").alias("time_text"),
        F.col("sensor").cast("string").alias("sensor"), valid_speed(F.col("speed")).alias("speed"))


def wide_to_readings(wide: DataFrame) -> DataFrame:
    """Unpivot a typed wide frame to readings; names stay text, so ids stay names."""
    sensors = sensor_columns(wide)
    return (
        wide.where(F.col("timestamp").isNotNull())
        .unpivot([F.col("timestamp").alias("ts")], [F.col(f"`{c}`") for c in sensors],
                 "sensor", "speed")
    )


def _write_readings(rows: DataFrame, path: str) -> None:
    """Readings (``kind=reading``) and rows without a readable time (``kind=reject``), in one pass.

    Rows of a date are brought together; a heavy date is split over tasks. A rebalance needs no sampling pass,
    unlike a range, and adapts to the sizes it finds.
    """
    kind = F.when(F.col("timestamp").isNull(), "reject").otherwise("reading")
    dated = rows.withColumns({"kind": kind, "date": F.to_date("timestamp")}).hint("rebalance", "kind", "date")
    if "values" in dated.columns:  # wide rows are moved, and unfolded where they land
        dated = dated.select("kind", "date", "timestamp", "time_text", F.explode("values").alias("v")).select(
            "kind", "date", "timestamp", "time_text", "v.*")
    (
        dated.select("kind", "date", F.col("timestamp").alias("ts"), "sensor", "speed",
                     F.when(F.col("timestamp").isNull(), F.col("time_text")).alias("time_text"))
        .sortWithinPartitions("kind", "date", "ts", "sensor")
        .write.mode("overwrite").partitionBy("kind", "date").parquet(path)
    )


def write_readings(rows: DataFrame, path: str) -> None:
    """Stored readings of a typed long frame."""
    _write_readings(rows, path)


def write_wide_as_readings(wide: DataFrame, path: str) -> None:
    """Stored readings of a typed wide frame: one row per sensor, a reject once."""
    cells = F.array(*[F.struct(F.lit(c).alias("sensor"), F.col(f"`{c}`").alias("speed")) for c in sensor_columns(wide)])
    none = F.array(F.struct(F.lit(None).cast("string").alias("sensor"), F.lit(None).cast("double").alias("speed")))
    values = F.when(F.col("timestamp").isNull(), none).otherwise(cells)
    _write_readings(wide.select("timestamp", "time_text", values.alias("values")), path)


_STORED = "ts timestamp, sensor string, speed double, time_text string, kind string, date date"


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Stored readings; filters on ``date`` prune whole folders."""
    return spark.read.schema(_STORED).parquet(path).where("kind = 'reading'").select("ts", "sensor", "speed", "date")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows whose time could not be read, with its text."""
    return spark.read.schema(_STORED).parquet(path).where("kind = 'reject'").select("time_text", "sensor", "speed")


def stored_counts(spark: SparkSession, path: str, row_size: int = 1) -> DataFrame:
    """One row: input rows, with and without a readable time, counted from the stored files alone.

    ``row_size`` is the number of readings that one input row gives (the sensors of a wide file). Only the folder's
    column is asked for, so the files' own row counts answer.
    """
    n = lambda kind: F.count_if(F.col("kind") == kind)
    counts = spark.read.schema(_STORED).parquet(path).select("kind").agg(
        F.ceil(n("reading") / row_size).alias("valid_rows"), n("reject").alias("rejected_rows"))
    return counts.select((F.col("valid_rows") + F.col("rejected_rows")).alias("total_rows"), "valid_rows", "rejected_rows")
