"""Scoring requests: coercion, defaults, validation, responses. Works on streams too."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.functions.lenient import finite, instant, number_in, whole
from speedloom.functions.signals import serving_strategy, status_text

REQUEST_FIELDS = ("avg_speed", "std_speed_hour", "hour", "weekday", "timestamp",
                  "latitude", "longitude", "location")


def coerce_requests(raw: DataFrame) -> DataFrame:
    """Typed request fields from text; other columns pass through."""
    have = set(raw.columns)

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in have else F.lit(None).cast("string")

    keep = [c for c in raw.columns if c not in REQUEST_FIELDS]
    numeric = [c for c in REQUEST_FIELDS if c != "location"]
    # Two steps: the numbers are read once here, however often the checks use them.
    numbers = raw.select(
        *keep, text("location").alias("location"), text("timestamp").alias("_time"),
        *[number_in(text(c)).alias(f"_{c}") for c in numeric])
    std = finite(F.col("_std_speed_hour"))
    return numbers.select(
        *keep,
        finite(F.col("_avg_speed")).alias("avg_speed"),
        std.alias("std_speed_hour"),
        # 'auto' and unreadable text alike are looked up.
        std.isNull().alias("std_speed_auto"),
        whole(F.col("_hour"), 0, 23).alias("hour"),
        whole(F.col("_weekday"), 1, 7).alias("weekday"),
        instant(F.col("_timestamp"), F.col("_time")).alias("timestamp"),
        finite(F.col("_latitude")).alias("latitude"),
        finite(F.col("_longitude")).alias("longitude"),
        "location",
    )


def with_time_defaults(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Hour and weekday: as given, else from the request time, else from now."""
    now = F.current_timestamp() if now is None else now
    return requests.withColumns({
        "hour": F.coalesce("hour", F.hour("timestamp"), F.hour(now)),
        "weekday": F.coalesce("weekday", F.dayofweek("timestamp"), F.dayofweek(now)),
        "timestamp": F.coalesce("timestamp", now.cast("timestamp")),
    })


def with_hourly_std(requests: DataFrame, hourly: DataFrame) -> DataFrame:
    """Fill ``std_speed_hour``: given, else that hour's, else the hourly mean, else 5."""
    table = hourly.where(F.col("hour").isNotNull()).groupBy("hour").agg(
        F.first("std_speed_hour").alias("_hour_std"))
    # Up to 24 hours: one small array of the table serves the mean for missing hours.
    mean = table.agg(F.avg("_hour_std").alias("_mean_std"))
    lookup = (
        table.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
        .join(table, "hour", "left")
        .withColumn("_mean_std", mean.scalar())
        .select("hour", F.coalesce("_hour_std", "_mean_std", F.lit(fv.STD_FALLBACK)).alias("_default"))
    )
    return (
        requests.join(F.broadcast(lookup), "hour", "left")
        .withColumn("std_speed_hour", F.coalesce("std_speed_hour", "_default", F.lit(fv.STD_FALLBACK)))
        .drop("_default")
    )


# Required fields and what is said when one is missing or unreadable.
_REQUIRED = {"avg_speed": fv.ERROR_AVG_SPEED}


def with_errors(requests: DataFrame) -> DataFrame:
    """Add ``errors``: one text per missing or unreadable required field."""
    texts = [F.when(F.col(c).isNull(), F.lit(text)) for c, text in _REQUIRED.items()]
    return requests.withColumn("errors", F.array_compact(F.array(*texts)))


def accepted(requests: DataFrame) -> DataFrame:
    # Asked of the fields and not of the error texts: a test that filters early.
    return requests.dropna(subset=list(_REQUIRED))


def rejected(requests: DataFrame) -> DataFrame:
    bad = F.lit(False)
    for c in _REQUIRED:
        bad = bad | F.col(c).isNull()
    return with_errors(requests.where(bad))


def prepare_requests(raw: DataFrame, hourly: DataFrame, now: Column | None = None) -> DataFrame:
    """Coerced and completed requests, good and bad."""
    return with_hourly_std(with_time_defaults(coerce_requests(raw), now), hourly)


def score_requests(requests: DataFrame, model: PipelineModel, model_path: str | None = None,
                   model_version: str | None = None) -> DataFrame:
    """Score accepted requests with a fitted model and shape the response."""
    scored = model.transform(requests)
    shares = vector_to_array(F.col("probability_lr"))
    return response(
        scored.withColumn("probability_distribution", shares)
        .withColumn("prob_congestion", F.get("probability_distribution", F.lit(1)))
        .withColumnRenamed("prediction_lr", "prediction")
        .drop("features_raw", "features", "rawPrediction", "probability_lr"),
        model_path, model_version)


def response(scored: DataFrame, model_path: str | None = None,
             model_version: str | None = None) -> DataFrame:
    """Response columns from ``prediction``, ``prob_congestion`` and the request fields."""
    inputs = ("location", "avg_speed", "hour", "weekday", "std_speed_hour", "std_speed_auto",
              "timestamp", "latitude", "longitude")
    made = (*inputs, "prediction", "prob_congestion", "probability_distribution")
    keep = [c for c in scored.columns if c not in made]
    if "probability_distribution" not in scored.columns:
        p = F.col("prob_congestion")
        scored = scored.withColumn("probability_distribution", F.array(1.0 - p, p))
    return scored.select(
        *keep,
        status_text(F.col("prediction")).alias("status"),
        F.col("prediction").cast("int").alias("prediction"),
        "prob_congestion", "probability_distribution",
        serving_strategy(F.col("prob_congestion")).alias("strategy"),
        F.struct(*[c for c in inputs if c in scored.columns]).alias("inputs"),
        F.struct(F.lit(model_path).cast("string").alias("path"),
                 F.lit(model_version).cast("string").alias("last_modified")).alias("model"),
    )
