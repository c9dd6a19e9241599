"""The whole batch job: clean, cluster, predict, plan, report.

Each step writes its tables and the next one reads them back, so no step runs another
step's work again, a lost executor costs one step's tasks, and a rerun goes on behind the last finished step.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.operators import chartdata, cleaning, evaluation, features, horizon, plan, reports
from speedloom.operators import scoring, states, training
from speedloom.plans import report_cube
from speedloom.sources import readings as rd
from speedloom.sources import tables_io as io


@dataclass
class JobResult:
    """What a run did; ``skipped`` says why no model was trained, ``reused`` names the steps of an earlier run that were kept."""

    k: int | None = None
    skipped: str | None = None
    reused: list[str] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)


class _Output:
    def __init__(self, spark: SparkSession, out: str, result: JobResult):
        self.spark, self.out, self.result = spark, out.rstrip("/"), result

    def path(self, name: str) -> str:
        self.result.tables[name] = f"{self.out}/{name}"
        return self.result.tables[name]

    def parquet(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def json(self, df: DataFrame, name: str) -> None:
        io.write_json(df, self.path(name))

    def csv(self, df: DataFrame, name: str) -> None:
        io.write_csv(df, self.path(name))

    def together(self, *writes: Callable[[], None], at_once: int = 8) -> None:
        """Run writes that do not depend on each other; their jobs share the executors."""
        with ThreadPool(min(at_once, len(writes))) as pool:
            pool.map(inheritable_thread_target(self.spark)(lambda write: write()), writes, chunksize=1)


class Steps:
    """The steps of a job and which of them an earlier run under the same ``out`` has finished.

    A step's record is written after its last table. Its key is a digest of the input files (path, size, time of change), the
    parameters and the steps before it, so a rerun starts behind the last good step, and changed input or another
    parameter runs what depends on it.
    """

    def __init__(self, sink: _Output, key: str):
        self.sink, self.key, self.kept = sink, key, True

    def run(self, name: str, work: Callable[[], dict | None], **parameters) -> None:
        result, path = self.sink.result, f"{self.sink.out}/steps/{name}"
        self.key = hashlib.sha256(json.dumps([self.key, name, parameters], sort_keys=True).encode()).hexdigest()
        record = self._record(path) if self.kept else None
        if record is not None and record["key"] == self.key:
            result.tables.update(record["tables"])
            result.metrics.update(record["metrics"])
            result.reused.append(name)
            return
        self.kept = False
        self._write(path, {"key": None})  # the old tables are overwritten from here on
        before = set(result.tables)
        metrics = work() or {}
        result.metrics.update(metrics)
        self._write(path, {"key": self.key, "metrics": metrics, "tables": {k: v for k, v in result.tables.items() if k not in before}})

    def _write(self, path: str, record: dict) -> None:
        self.sink.spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def _record(self, path: str) -> dict | None:
        try:
            row = self.sink.spark.read.text(path, wholetext=True).first()
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return json.loads(row.value) if row else None


def input_key(spark: SparkSession, source: str) -> str:
    """Digest of the input files' names, sizes and times of change; the files are listed and not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    told = files.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0))).first()
    return f"{told[0]}-{told[1]}"


def filled_cells(cells: DataFrame, profile: DataFrame) -> DataFrame:
    """Long cells of known sensors, gaps filled with the sensor's mean (``filled`` says where)."""
    known = profile.where(F.col("mean_speed").isNotNull()).select("sensor", "mean_speed")
    return cells.join(known, "sensor").select(
        F.col("ts").alias("timestamp"), "sensor", F.coalesce("speed", "mean_speed").alias("speed"),
        F.col("speed").isNull().alias("filled"))


def filled_wide(cells: DataFrame, profile: DataFrame, slots: DataFrame, sensors: list[str]) -> DataFrame:
    """Wide, mean-filled cells beside the slot features (columns known from the header)."""
    wide = cells.groupBy(F.col("ts").alias("timestamp")).pivot("sensor", sensors).agg(F.first("speed"))
    # One row: the sensors' means, pivoted like the cells.
    means = profile.groupBy(F.lit(1).alias("_one")).pivot("sensor", sensors).agg(F.first("mean_speed"))
    means = means.select("_one", *[F.col(f"`{s}`").alias(f"_mean_{s}") for s in sensors])
    rows = slots.join(wide, "timestamp").withColumn("_one", F.lit(1)).join(F.broadcast(means), "_one", "left")
    return rows.select(
        "timestamp", *[F.coalesce(f"`{s}`", f"`_mean_{s}`").alias(s) for s in sensors],
        *[c for c in slots.columns if c != "timestamp"])


def run(spark: SparkSession, source: str, out: str, time_col: str = "timestamp",
        has_header: bool = True, delimiter: str = ",", kmin: int = 2, kmax: int = 6,
        horizon_min: int = 15, freq_min: int = 5, standardize: bool = False,
        approximate_quartiles: bool = False, cleaned_csv: bool = False, layout: str = "wide",
        sensor_col: str = "sensor", speed_col: str = "speed", label: str = "rows", split: str = "hash",
        source_zone: str | None = None, flag_only: bool = False) -> JobResult:
    """Run all steps over sensor data and write every table under ``out``; finished steps of an earlier run are kept.

    ``layout``: "wide" (a CSV with a column per sensor) or "long" (CSV or Parquet of time, sensor, speed).
    ``label``: the state some rows later on the day ("rows") or at the exact time ("time"). ``split``: by a hash of the time
    stamp ("hash") or by blocks of time with an embargo ("time"); then the hourly spread comes from train slots alone.
    ``source_zone``: zone in which the times were written. ``flag_only``: outliers stay, marked ``is_outlier``.
    ``cleaned_csv``: also write the cleaned data wide, as one CSV column per sensor (wide layout only).
    """
    if layout not in ("wide", "long") or label not in ("rows", "time") or split not in ("hash", "time"):
        raise ValueError(f"unknown choice: layout {layout!r}, label {label!r}, split {split!r}")
    result = JobResult()
    sink = _Output(spark, out, result)
    steps = Steps(sink, input_key(spark, source))
    stored = lambda name: spark.read.parquet(result.tables[name])

    # 1. Readings and rejects: one pass over the input.
    def read_input() -> dict:
        path, size = sink.path("readings"), 1
        if layout == "wide":
            wide = rd.typed_wide(rd.read_wide_csv(spark, source, time_col, has_header, delimiter), zone=source_zone)
            size = max(1, len(rd.sensor_columns(wide)))
            rd.write_wide_as_readings(wide, path)
        else:
            raw = rd.read_long(spark, source, time_col, sensor_col, speed_col, has_header, delimiter)
            rd.write_readings(rd.typed_long(raw, zone=source_zone), path)
        return rd.stored_counts(spark, path, size).first().asDict()

    steps.run("readings", read_input, layout=layout, columns=[time_col, sensor_col, speed_col], header=has_header,
              delimiter=delimiter, zone=source_zone)
    readings = rd.read_readings(spark, result.tables["readings"])

    # 2. Cells, stored once: the profile, the slot means and the cleaned data are made of them.
    def clean() -> dict:
        cells = sink.parquet(cleaning.slot_cells(readings, freq_min), "cells")
        # Stored, the sensor table has a known size: its join is a broadcast if it is small.
        profile = sink.parquet(cleaning.sensor_profile(cells), "sensor_profile")
        base = features.with_calendar(features.slot_average(cells, profile))
        if split == "time":
            base = horizon.with_purged_split(base, horizon_min)
        base = sink.parquet(base, "slot_means")
        spread = sink.parquet(features.hourly_spread(horizon.train_rows(base) if split == "time" else base), "hourly_spread")
        featured = features.with_hourly_spread(base, spread)
        bounds = sink.parquet(cleaning.iqr_bounds(base, exact=not approximate_quartiles), "outlier_bounds").first()
        flagged = cleaning.flag_outliers(featured, bounds)
        kept = flagged if flag_only else flagged.where(~F.col("is_outlier"))
        columns = ["timestamp", *fv.FEATURES, *["is_test"] * (split == "time"), *["is_outlier"] * flag_only]
        slots = sink.parquet(kept.select(*columns), "slots")
        sink.json(cleaning.missing_profile(profile), "missing_profile")
        sink.parquet(filled_cells(cells, profile), "cleaned")
        # These need no model: they are told also where no slot is usable or no model can be trained.
        sink.json(reports.sensor_activity(readings), "analysis/sensor_activity")
        sink.json(reports.top_sensor_hourly(readings), "analysis/top_sensor_hourly")
        if cleaned_csv and layout == "wide":
            sensors = rd.sensor_columns(rd.read_wide_csv(spark, source, time_col, has_header, delimiter))
            io.write_cleaned_csv(filled_wide(cells, profile, slots.select("timestamp", *fv.FEATURES), sensors), sink.path("cleaned_data"))
        return cleaning.outlier_counts(flagged).first().asDict()

    steps.run("slots", clean, freq_min=freq_min, split=split, horizon=horizon_min * (split == "time"),
              approximate=approximate_quartiles, flag_only=flag_only, cleaned_csv=cleaned_csv, sensor_reports=True)
    slots = stored("slots")

    # 3. States.
    def find_states() -> dict:
        fitted = states.fit_states(slots, kmin, kmax, standardize=standardize)
        if fitted is None:
            return {"k": None}
        sink.csv(fitted.scores, "silhouette_scores")
        sink.csv(states.state_summary(sink.parquet(states.assign_states(slots, fitted), "clustered")), "cluster_summary")
        return {"k": fitted.k}

    steps.run("states", find_states, kmin=kmin, kmax=kmax, standardize=standardize)
    result.k = result.metrics.pop("k")
    if result.k is None:
        result.skipped = "no usable slots"
        return result
    clustered = stored("clustered")
    labelled = states.label_states(clustered)

    # 4. Congestion model.
    def model() -> dict:
        congested = states.congested_state(clustered).first()
        if label == "time":
            rows = horizon.label_by_time(labelled, congested, horizon_min)
        else:
            rows = horizon.label_by_rows(labelled, congested, horizon.lead_steps(horizon_min, freq_min))
        rows = rows.where(F.col("is_test").isNotNull()) if split == "time" else horizon.with_test_flag(rows)
        samples = sink.parquet(horizon.with_class_weight(rows), f"samples_{horizon_min}m")
        trained = training.train(samples)
        if trained.model is None:
            return trained.balance | {"reason": trained.reason}
        grid = [(float(p["regParam"]), float(p["elasticNetParam"]), score) for p, score in trained.grid_scores]
        sink.json(spark.createDataFrame(grid, "reg_param double, elastic_net_param double, auc_pr double"), "evaluation/grid_scores")
        training.save_model(trained.model, sink.path("models/logistic_pipeline"))
        # Serving looks the spread up in the very table the features were trained with.
        sink.parquet(stored("hourly_spread"), "models/hourly_spread")
        sink.json(scoring.feature_importance(spark, trained.coefficients), "analysis/logistic_feature_importance")
        return trained.balance | {"reason": None}

    steps.run("model", model, horizon=horizon_min, label=label)
    result.skipped = result.metrics.pop("reason")
    if result.skipped:
        return result

    # 5. Predictions and how good they are.
    def predict() -> dict:
        model = training.load_model(result.tables["models/logistic_pipeline"])
        scored = training.score(stored(f"samples_{horizon_min}m"), model)
        result.tables["predictions"] = io.write_predictions(scored, sink.path("predictions"), horizon_min)
        return evaluate(sink, io.read_predictions(spark, result.tables["predictions"]))

    steps.run("predictions", predict)
    scored = io.read_predictions(spark, result.tables["predictions"])

    # 6. Plan and reports, all from one small cube; these tables and the charts' only read what is stored.
    def report() -> None:
        cube = sink.parquet(report_cube.base_cube(scored), "report_cube")
        signal = plan.with_signal_columns(
            report_cube.roll_up(cube, ("date", "hour")).select(
                "date", "hour", "avg_prob", "avg_speed", F.col("count").alias("count_samples")), horizon_min).orderBy("date", "hour")
        tables = report_cube.report_tables(cube)
        tables["overview"] = tables["overview"].withColumn("generated_at", F.current_timestamp())

        def json_table(name: str, table: DataFrame) -> Callable[[], None]:
            return lambda: sink.json(table, name)

        sink.together(
            lambda: io.write_plan_csv(signal, sink.path("signal_plan")),
            json_table("signal_plan_json", signal),
            json_table("charts/state_boxes", chartdata.box_stats(labelled)),
            json_table("charts/state_density", chartdata.kde_grid(labelled)),
            json_table("charts/state_scatter", chartdata.scatter_counts(labelled)),
            json_table("charts/probability_series", chartdata.series_hourly(scored)),
            *[json_table(f"analysis/{name}", table) for name, table in tables.items()],
        )

    steps.run("reports", report)
    return result


def evaluate(sink: _Output, scored: DataFrame) -> dict:
    """Metrics (also as a table) and curve of the held-out rows."""
    held_out = evaluation.evaluation_rows(scored)
    curve = sink.parquet(evaluation.score_curve(held_out), "evaluation/score_curve")
    metrics = evaluation.curve_areas(curve).first().asDict() | evaluation.label_metrics(held_out).first().asDict()
    told = sink.spark.createDataFrame([(k, None if v is None else float(v)) for k, v in metrics.items()], "metric string, value double")
    sink.together(
        lambda: sink.json(told, "evaluation/metrics"),
        lambda: sink.json(evaluation.confusion_cells(held_out), "evaluation/confusion"),
        lambda: sink.json(evaluation.chart_points(curve), "evaluation/roc_points"),
    )
    return metrics
