"""Sinks for result tables and readers that take them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speedloom.functions.lenient import lenient_double, lenient_int
from speedloom.functions.probability import with_probability
from speedloom.functions.readings import shown

# Fixed values -- columns of a stored plan; files may lack some and hold them in any order.
PLAN_COLUMNS = ("date", "hour", "avg_prob", "avg_speed", "count_samples", "green_extension_pct", "strategy",
                "horizon_min")


# -- sinks ------------------------------------------------------------------------------

def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_cleaned_csv(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Time-ordered CSV: file after file in time order, written by many tasks."""
    df.repartitionByRange(ts).sortWithinPartitions(ts).write.mode("overwrite").option(
        "header", True).csv(path)


def write_plan_csv(plan: DataFrame, path: str) -> None:
    """Plan as CSV, file after file in order of date and hour."""
    write_csv(plan.repartitionByRange("date", "hour").sortWithinPartitions("date", "hour"), path)


def write_predictions(scored: DataFrame, base: str, horizon_min: int) -> str:
    """Write the run of a horizon, a folder of its own under ``base``; a rerun replaces all of it."""
    path = f"{base}/predict_{int(horizon_min)}m"
    (
        scored.withColumn("horizon_min", F.lit(int(horizon_min)))
        .withColumn("date", F.to_date("timestamp"))
        .hint("rebalance", "date")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("date").parquet(path)
    )
    return path


# -- readers ----------------------------------------------------------------------------

def keep_first(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the first in ``order``.

    Written as an aggregate, so repeats of a hot key are merged before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(
        *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])


def read_report(spark: SparkSession, paths: list[str], schema: str,
                keys: tuple[str, ...]) -> DataFrame:
    """A JSON report that may lie in several places; per key, the row that comes first.

    Earlier places come first, then files by name, then rows as they stand in their file. All part files are read.
    """
    # Numbers rise along a partition, which holds whole blocks in their order: within a block they tell the row's place.
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
          F.monotonically_increasing_id().alias("_row")]
    union = None
    for i, path in enumerate(paths):
        part = spark.read.schema(schema).json(path).select("*", F.lit(i).alias("_place"), *at)
        union = part if union is None else union.unionByName(part)
    return keep_first(union, keys, ("_place", "_file", "_block", "_row")).drop("_place", "_file", "_block", "_row")


def newest_folder(spark: SparkSession, path: str, pattern: str) -> str | None:
    """The folder of the newest file below ``path``; files are listed and not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(path).select("path", "modificationTime"))
    newest = files.orderBy(F.desc("modificationTime"), F.desc("path")).first()
    return newest.path.rsplit("/", 1)[0] if newest else None


def coerce_plan(raw: DataFrame) -> DataFrame:
    """Typed plan rows from text; rows without a readable date are dropped."""
    day = F.to_date(F.trim("date").try_cast("timestamp"))
    return raw.select(
        day.alias("date"),
        lenient_int(F.col("hour")).alias("hour"),
        lenient_double(F.col("avg_prob")).alias("avg_prob"),
        lenient_double(F.col("avg_speed")).alias("avg_speed"),
        lenient_int(F.col("count_samples")).cast("long").alias("count_samples"),
        lenient_int(F.col("green_extension_pct")).alias("green_extension_pct"),
        "strategy",
        lenient_int(F.col("horizon_min")).alias("horizon_min"),
    ).where(F.col("date").isNotNull())


def head_of_plan(plan: DataFrame, rows: int | None = None) -> DataFrame:
    """Plan by date and hour (unknown hours last), rounded for display; its first ``rows`` if asked."""
    ordered = plan.orderBy("date", F.asc_nulls_last("hour"), "horizon_min", "avg_prob")
    return (
        (ordered if rows is None else ordered.limit(rows))
        .withColumn("avg_prob_percent", shown(F.col("avg_prob") * 100, 1))
        .withColumn("avg_speed", shown(F.col("avg_speed"), 2))
    )


def read_by_header(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> DataFrame:
    """CSV files of one folder as text columns, each file by its own header; what a file lacks is null.

    Files are grouped by header, so the plan has as many scans as there are different headers.
    """
    lines = spark.read.text(folder, pathGlobFilter="*.csv").select("value", F.col("_metadata.file_path").alias("path"))
    names = F.transform(F.split("value", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '["\ufeff]', ""))))
    # A header names the first of the columns; no value of it does.
    headers = lines.select("path", names.alias("names")).where(F.array_contains("names", columns[0])).distinct()
    union = None
    # One row per header and the files of one run: a listing, not data.
    for row in headers.groupBy("names").agg(F.sort_array(F.collect_set("path")).alias("paths")).orderBy("names").collect():
        schema = ", ".join(f"`{name or f'_{i}'}` string" for i, name in enumerate(row.names))
        part = spark.read.schema(schema).option("header", True).csv(row.paths)
        part = part.select(*[c for c in columns if c in row.names], F.col("_metadata.file_modification_time").alias("_written"))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    if union is None:
        union = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", _written timestamp")
    return union.select(*[F.col(c) if c in union.columns else F.lit(None).cast("string").alias(c) for c in columns], "_written")


def read_signal_plan(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """All files of the newest plan below ``path``, with the time it was written."""
    raw = read_by_header(spark, newest_folder(spark, path, "*.csv") or path, PLAN_COLUMNS)
    return head_of_plan(coerce_plan(raw), rows).withColumn("last_updated", raw.select(F.max("_written")).scalar())


def with_rebuilt_time(df: DataFrame) -> DataFrame:
    """``timestamp`` from date and hour where it is missing; error when neither exists."""
    has_parts = {"date", "hour"} <= set(df.columns)
    if "timestamp" not in df.columns and not has_parts:
        raise ValueError("prediction data has neither 'timestamp' nor 'date' and 'hour'")
    if not has_parts:
        return df
    start = F.to_date("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.col("hour").cast("int"))
    if "timestamp" not in df.columns:
        return df.withColumn("timestamp", start)
    kind = df.schema["timestamp"].dataType
    return df.withColumn("timestamp", F.coalesce("timestamp", start.cast(kind)))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Scored rows of a run with ``timestamp`` and ``prob_congestion`` made sure."""
    return with_probability(with_rebuilt_time(spark.read.parquet(path)))


def horizon_token(run_name: Column) -> Column:
    """Horizon from a run name: '15m', '1h'; bare digits are minutes, else the suffix."""
    suffix = F.lower(F.trim(F.element_at(F.split(run_name, "_"), -1)))
    digits = F.regexp_extract(suffix, r"^(\d+)[mh]?$", 1)
    number = F.when(digits != "", digits.cast("long").cast("string"))
    unit = F.substring(suffix, -1, 1)
    return (
        F.when(suffix == "", F.lit(None))
        .when(suffix.rlike(r"^\d+[mh]$"), F.concat(number, unit))
        .when(suffix.rlike("[mh]$"), suffix)
        .when(suffix.rlike(r"^\d+$"), F.concat(number, F.lit("m")))
    )


def run_catalog(spark: SparkSession, base: str) -> DataFrame:
    """Runs under ``base`` (``predict_*`` folders): name, horizon token, newest file, files.

    Lists files only: file contents are not read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(f"{base}/predict_*")
             .select("path", "modificationTime"))
    name = F.regexp_extract("path", r"/(predict_[^/]*)/", 1)
    return (
        files.groupBy(name.alias("run_name"))
        .agg(F.max("modificationTime").alias("last_modified"), F.count("*").alias("files"))
        .withColumn("horizon", horizon_token(F.col("run_name")))
        .orderBy("run_name")
    )


def newest_run(spark: SparkSession, base: str, columns: tuple[str, ...] = ("hour", "avg_speed")) -> DataFrame:
    """All rows of the newest run under ``base`` that has ``columns``."""
    runs = run_catalog(spark, base).orderBy(F.desc("last_modified"), "run_name")
    # A run is a folder a job wrote: the listing holds as many rows as there were jobs.
    for row in runs.toLocalIterator():
        df = spark.read.parquet(f"{base}/{row.run_name}")
        if set(columns) <= set(df.columns):
            return df.select(*columns)
    raise ValueError(f"no prediction run under {base} has columns {', '.join(columns)}")
