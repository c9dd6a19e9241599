"""The given tables seen as sensor data, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speedloom.operators import cleaning, features, horizon, scoring, states
from speedloom.sources.readings import events_as_readings
from speedloom.sources.staging import stage

FREQ_MIN = 60
HORIZON_MIN = 180
# Fixed speed limits standing in for fitted states, so that results can be checked exactly.
STATE_CUTS = (32.0, 43.0)
# A fixed present moment for request defaults.
NOW = "2024-02-01 09:30:00"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_readings(spark, sf_dir)


def cells(spark: SparkSession, sf_dir: str, freq_min: int = FREQ_MIN) -> DataFrame:
    return cleaning.slot_cells(readings(spark, sf_dir), freq_min)


def slot_means(spark: SparkSession, sf_dir: str, freq_min: int = FREQ_MIN) -> DataFrame:
    """Slot table with calendar, written once: all further steps are small next to it."""
    return stage(features.with_calendar(features.slot_average(cells(spark, sf_dir, freq_min))), "slots")


def featured_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_hourly_spread(slot_means(spark, sf_dir))


def clean_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = slot_means(spark, sf_dir)
    return cleaning.drop_outliers(features.with_hourly_spread(base), cleaning.iqr_bounds(base))


def state_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.band_states(clean_slots(spark, sf_dir), STATE_CUTS)


def samples_and_parameters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Row]:
    """Labelled, split and weighted slots, with class weight and moments of the train rows."""
    # Written once: the congested state, the moments and the samples all read it.
    slots = stage(state_slots(spark, sf_dir), "state-slots")
    rows = horizon.with_test_flag(horizon.label_by_rows(
        slots, states.congested_state(slots).first(), horizon.lead_steps(HORIZON_MIN, FREQ_MIN)))
    fitted = horizon.train_rows(rows).agg(
        horizon.positive_weight().alias("pos_weight"), *scoring.moment_aggregates()).first()
    return horizon.with_class_weight(rows, fitted), fitted


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_and_parameters(spark, sf_dir)[0]


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.standardize(*samples_and_parameters(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.logistic_score(standardized(spark, sf_dir))


def raw_requests(events: DataFrame) -> DataFrame:
    """Loosely typed request text made from events, good and bad values mixed."""
    text, stamp = F.col("_text"), F.col("_stamp")

    def mix(every: int, default, special: dict):
        """``default``, but another choice for some remainders of the event number."""
        step = F.col("event_id") % every
        out = None
        for i, choice in special.items():
            choice = F.lit(choice).cast("string")
            out = F.when(step == i, choice) if out is None else out.when(step == i, choice)
        return out.otherwise(F.lit(default).cast("string"))

    return events.select(
        "event_id", "event_type", F.col("value").cast("string").alias("_text"), "user_id", "ts",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("_stamp"),
    ).select(
        "event_id",
        mix(11, text, {1: F.concat(F.lit(" "), text, F.lit(" ")), 3: "", 5: "abc", 7: "nan", 9: "1e2"})
        .alias("avg_speed"),
        mix(7, "inf", {0: "auto", 1: " AUTO ", 2: "4.25", 3: None, 4: "x", 5: text})
        .alias("std_speed_hour"),
        mix(6, F.col("user_id"), {1: "17.9", 2: "24", 3: None, 4: " 8 ", 5: "-0.5"}).alias("hour"),
        mix(5, "", {0: "0", 1: "7", 2: None, 3: "3.5"}).alias("weekday"),
        mix(6, stamp, {1: F.unix_seconds(F.col("ts").cast("timestamp")), 2: "not a time",
                       3: F.date_format("ts", "M/d/yyyy H:mm"), 4: None, 5: "2024-03-05"})
        .alias("timestamp"),
        mix(3, "-3", {0: "10.5", 1: "x"}).alias("latitude"),
        mix(2, None, {0: "106.25"}).alias("longitude"),
        F.col("event_type").alias("location"),
    )


def now():
    return F.lit(NOW).cast("timestamp")


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Agreed output types: rounded doubles, longs, zone-less times and dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)
