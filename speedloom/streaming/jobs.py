"""Structured Streaming jobs: request scoring, slot means, running plan, duplicates."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from speedloom.functions.readings import valid_speed
from speedloom.operators.plan import plan_measures, with_signal_columns
from speedloom.operators.requests import (
    REQUEST_FIELDS, accepted, prepare_requests, rejected, score_requests)
from speedloom.operators.training import load_model, model_version


def parquet_stream(spark: SparkSession, folder: str, name_filter: str, schema: StructType | str,
                   files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of ``folder`` whose names match ``name_filter``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def with_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need an instant, so zone-less times are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


#: Process what is there and stop; ``{"processingTime": "1 minute"}`` keeps a stream running.
ONCE = {"availableNow": True}


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there into parquet and stop; restarts resume at ``checkpoint``."""
    query = (
        df.writeStream.format("parquet").outputMode(mode)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**ONCE).start()
    )
    query.awaitTermination()


# -- request scoring --------------------------------------------------------------------

def score_stream(raw: DataFrame, hourly: DataFrame, model: PipelineModel, path: str,
                 rejects_path: str, checkpoint: str, model_path: str | None = None,
                 model_version: str | None = None, now=None, trigger: dict | None = None) -> StreamingQuery:
    """Score requests as they arrive; rejects go to their own table.

    The batch is prepared once for both sinks. Each micro-batch owns one partition folder of either
    table, so repeating a batch after a failure replaces its rows and adds none.
    """
    prepared = prepare_requests(raw, hourly, now)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = score_requests(accepted(batch), model, model_path, model_version)
            _write_batch(good, batch_id, path)
            _write_batch(rejected(batch), batch_id, rejects_path)
        finally:
            batch.unpersist()

    return (prepared.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger or ONCE).start())


def json_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as JSON lines; every field is read as text and coerced later."""
    schema = ", ".join(f"{c} string" for c in REQUEST_FIELDS)
    return spark.readStream.schema(schema).json(folder)


def serve_requests(spark: SparkSession, folder: str, job_out: str, path: str, rejects_path: str,
                   checkpoint: str, now=None, trigger: dict | None = None) -> StreamingQuery:
    """Answer the requests in ``folder`` with the model a batch job left in ``job_out``.

    The spread look-up is the table the model's features were made with.
    """
    model_path = f"{job_out}/models/logistic_pipeline"
    hourly = spark.read.schema("hour int, std_speed_hour double").parquet(f"{job_out}/models/hourly_spread")
    return score_stream(json_requests(spark, folder), hourly, load_model(model_path), path, rejects_path,
                        checkpoint, model_path, model_version(spark, model_path), now, trigger)


def _write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


# -- slot means -------------------------------------------------------------------------

def stream_cells(readings: DataFrame, freq_min: int, lateness: str = "10 minutes") -> DataFrame:
    """Mean speed per (slot, sensor) of a readings stream; late rows are dropped."""
    slot = F.window("ts", f"{int(freq_min)} minutes").alias("slot")
    return (
        with_event_time(readings).withWatermark("ts", lateness)
        .groupBy(slot, "sensor").agg(F.avg("speed").alias("speed"))
    )


def stream_slot_means(readings: DataFrame, profile: DataFrame, freq_min: int,
                      lateness: str = "10 minutes") -> DataFrame:
    """Network mean speed per slot, emitted once the slot has closed: the feature the model was trained with.

    ``profile`` is the stored mean of every sensor (``sensor``, ``mean_speed``). As in ``slot_average``, gaps count at
    their sensor's mean: the mean of the sensor means, moved by what the present cells differ from theirs. The sum of the
    means is read once when the stream starts; a new profile needs a restart.
    """
    known = profile.where(F.col("mean_speed").isNotNull()).select("sensor", "mean_speed")
    network = known.agg(F.sum("mean_speed").alias("total"), F.count("*").alias("sensors")).first()
    cells = stream_cells(readings, freq_min, lateness).join(known, "sensor", "left")
    shift = F.coalesce(F.sum(F.col("speed") - F.col("mean_speed")), F.lit(0.0))
    return (
        cells.groupBy(F.window(F.window_time("slot"), f"{int(freq_min)} minutes").alias("slot"))
        .agg(F.try_divide(shift + F.lit(network.total), F.lit(network.sensors)).alias("avg_speed"),
             F.count("speed").alias("sensors"))
        .select(F.col("slot.start").alias("timestamp"), "avg_speed", "sensors")
    )


def events_stream_as_readings(events: DataFrame) -> DataFrame:
    return events.select("ts", F.col("event_type").alias("sensor"),
                         valid_speed(F.col("value")).alias("speed"))


# -- running signal plan ----------------------------------------------------------------

#: Batches that are written beside each other before they are merged into one folder.
MERGE_AFTER = 8
#: Folders and manifests take turns in so many places; one is used again only long after it went out of use.
PLACES = 4 * MERGE_AFTER
_MANIFEST = "seq long, run_start long, folders array<string>"
_MEASURES = "date date, hour int, avg_prob double, avg_speed double, count_samples long, run_start long, batch_id long"


def read_manifest(spark: SparkSession, path: str) -> Row | None:
    """The newest manifest of a plan store: which folders make up the plan. None before the first batch."""
    try:
        stored = spark.read.schema(_MANIFEST).json(f"{path}/manifest/*")
        return stored.orderBy(F.desc("seq")).first()  # PLACES rows at most
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_measures(spark: SparkSession, path: str) -> DataFrame:
    """The newest measures of every date and hour: later runs of the stream first, then later batches."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], _MEASURES)
    rows = spark.read.schema(_MEASURES).parquet(*[f"{path}/data/{x}" for x in manifest.folders])
    rest = F.struct("avg_prob", "avg_speed", "count_samples", "run_start", "batch_id")
    newest = F.max_by(rest, F.struct("run_start", "batch_id")).alias("m")
    return rows.groupBy("date", "hour").agg(newest).select("date", "hour", "m.*")


def upsert_measures(batch: DataFrame, path: str, run_start: int, batch_id: int) -> None:
    """Add the measures of the hours a batch touched: first their folder, then the manifest that names it.

    A reader sees the plan before or after the batch. Repeating a batch adds the same rows under a newer manifest.
    Every MERGE_AFTER batches the plan is written anew, one row per date and hour, so the store holds a few
    times the hours of the plan, however long the stream runs.
    """
    spark = batch.sparkSession
    last = read_manifest(spark, path)
    seq = last.seq + 1 if last else 0
    folders = list(last.folders) if last else []

    def add(rows: DataFrame, names: list[str]) -> list[str]:
        name = f"{seq % PLACES:04d}"
        rows.write.mode("overwrite").parquet(f"{path}/data/{name}")
        manifest = spark.createDataFrame([(seq, run_start, [*names, name])], _MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{seq % PLACES:04d}")
        return [*names, name]

    marked = batch.withColumns({"run_start": F.lit(run_start).cast("long"), "batch_id": F.lit(batch_id).cast("long")})
    folders = add(marked, folders)
    if len(folders) >= MERGE_AFTER:
        merged = stored_measures(spark, path).hint("rebalance")
        seq += 1
        add(merged, [])


def stream_plan(scored: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour",
                trigger: dict | None = None) -> StreamingQuery:
    """Keep date-hour plan measures up to date as scored slots arrive.

    Each start of the stream is newer than all before it, also with a new checkpoint, whose batch numbers
    start again: its measures replace those of earlier runs hour by hour. ``stored_plan`` reads the plan.
    """
    spark = scored.sparkSession
    last = read_manifest(spark, path)
    run_start = max(time.time_ns() // 1_000_000, last.run_start + 1 if last else 0)
    hourly = (
        with_event_time(scored, "timestamp").withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 hour").alias("slot"))
        .agg(*plan_measures())
        .select(F.to_date("slot.start").alias("date"), F.hour("slot.start").alias("hour"),
                "avg_prob", "avg_speed", "count_samples")
    )
    return (
        hourly.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: upsert_measures(batch, path, run_start, batch_id))
        .option("checkpointLocation", checkpoint).trigger(**trigger or ONCE).start()
    )


def stored_plan(spark: SparkSession, path: str, horizon_min: int) -> DataFrame:
    """Signal plan from the newest measures of every date and hour."""
    return with_signal_columns(stored_measures(spark, path).drop("run_start", "batch_id"), horizon_min)


# -- duplicates -------------------------------------------------------------------------

def drop_repeats(df: DataFrame, keys: list[str], lateness: str = "10 minutes",
                 ts: str = "ts") -> DataFrame:
    """First record per key; state is kept only as long as repeats may still come."""
    return with_event_time(df, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)
