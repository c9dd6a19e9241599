"""Registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.catalog import data as d
from speedloom.operators import certificates, chartdata, cleaning, evaluation, features, horizon, plan
from speedloom.operators import reports, requests, scoring, silhouettes, states, training
from speedloom.plans import job, report_cube
from speedloom.sources import readings as rd
from speedloom.sources import tables_io as io
from speedloom.sources.staging import new_path, stage
from speedloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name, with its output in the agreed types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return d.present(fn(spark, sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# -- cleaning ---------------------------------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    """Wide CSV written from the events, then scanned, parsed, validated and unpivoted."""
    events = d.table(spark, sf_dir, "events")
    # The sensors are the columns of the wide file.
    sensors = sorted(r.event_type for r in events.select("event_type").distinct().collect())
    slot = F.date_trunc("hour", "ts")
    wide = events.groupBy(slot.alias("slot")).pivot("event_type", sensors).agg(F.max("value"))
    path = new_path(spark, "wide-csv")
    io.write_csv(wide.select(F.date_format("slot", "M/d/yyyy H:mm").alias("when"), *sensors), path)
    return rd.wide_to_readings(rd.typed_wide(rd.read_wide_csv(spark, path)))


def _wide_csv(spark, sf_dir, unreadable=None):
    """Events as a wide CSV, one row per hour; ``unreadable`` marks slots whose time is spoilt."""
    events = d.table(spark, sf_dir, "events")
    # The sensors are the columns of the wide file.
    sensors = sorted(r.event_type for r in events.select("event_type").distinct().collect())
    wide = events.groupBy(F.date_trunc("hour", "ts").alias("slot")).pivot("event_type", sensors).agg(F.max("value"))
    when = F.date_format("slot", "M/d/yyyy H:mm")
    when = when if unreadable is None else F.when(unreadable, F.concat(F.lit("? "), when)).otherwise(when)
    path = new_path(spark, "wide-csv")
    io.write_csv(wide.select(when.alias("timestamp"), *sensors), path)
    return path


@query
def parse_counts(spark, sf_dir):
    """One pass over a CSV with unreadable times: what was stored, counted from the files, and the rejects themselves."""
    source = _wide_csv(spark, sf_dir, F.dayofmonth("slot") % 7 == 3)
    path = new_path(spark, "readings")
    wide = rd.typed_wide(rd.read_wide_csv(spark, source))
    rd.write_wide_as_readings(wide, path)
    stored = rd.read_readings(spark, path)
    return rd.stored_counts(spark, path, len(rd.sensor_columns(wide))).withColumns({
        "readings": stored.select(F.count("*")).scalar(), "known": stored.select(F.count("speed")).scalar(),
        "reject_texts": rd.read_rejects(spark, path).select(F.count_distinct("time_text")).scalar()})


@query
def validity_rule(spark, sf_dir):
    return d.readings(spark, sf_dir).groupBy("sensor").agg(
        F.count("*").alias("readings"), F.count("speed").alias("valid"),
        F.count_if(F.col("speed").isNull()).alias("rejected"),
        F.min("speed").alias("min_speed"), F.max("speed").alias("max_speed"))


@query
def missing_profile(spark, sf_dir):
    return cleaning.missing_profile(cleaning.sensor_profile(d.cells(spark, sf_dir)))


@query
def missing_after_fill(spark, sf_dir):
    return cleaning.sensor_profile(d.cells(spark, sf_dir)).select(
        "sensor", "slots", "missing_count", "missing_after_fill")


@query
def sensor_means(spark, sf_dir):
    return cleaning.sensor_means(d.cells(spark, sf_dir))


@query
def iqr_bounds(spark, sf_dir):
    return cleaning.iqr_bounds(d.slot_means(spark, sf_dir))


@query
def reading_quartiles(spark, sf_dir):
    """Exact quartiles of all valid readings per sensor (large input, many ties)."""
    return cleaning.exact_quantiles(
        d.readings(spark, sf_dir), "speed", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ("sensor",))


@query
def outlier_filter(spark, sf_dir):
    return d.clean_slots(spark, sf_dir)


@query
def outlier_bounds_fine(spark, sf_dir):
    """Fences and counts of the rule over one-minute slots, with tight fences."""
    slots = d.slot_means(spark, sf_dir, freq_min=1)
    bounds = cleaning.iqr_bounds(slots, factor=0.5)
    counts = cleaning.outlier_counts(cleaning.flag_outliers(slots, bounds))
    return counts.withColumns({c: bounds.select(c).scalar() for c in bounds.columns})


def _flagged(spark, sf_dir):
    slots = d.slot_means(spark, sf_dir)
    return cleaning.flag_outliers(slots, cleaning.iqr_bounds(slots, factor=0.5))


@query
def outlier_counts(spark, sf_dir):
    """Counts of the rule with tight fences, so that it removes rows from this data."""
    return cleaning.outlier_counts(_flagged(spark, sf_dir))


@query
def post_filter_stats(spark, sf_dir):
    return cleaning.speed_stats(_flagged(spark, sf_dir).where(~F.col("is_outlier")))


# -- features ---------------------------------------------------------------------------

@query
def slot_avg_speed(spark, sf_dir):
    return features.slot_average(d.cells(spark, sf_dir))


@query
def slot_calendar(spark, sf_dir):
    return features.with_calendar(d.table(spark, sf_dir, "events").select("event_id", "ts"), "ts").select(
        "event_id", "hour", "weekday", F.to_date("ts").alias("date"))


@query
def hourly_std_feature(spark, sf_dir):
    return d.featured_slots(spark, sf_dir)


@query
def finite_slots(spark, sf_dir):
    """Slots whose speed can be clustered, where every fifth hour's is unknown, not a number or infinite."""
    slots = d.slot_means(spark, sf_dir)
    odd = F.element_at(F.array(F.lit(None), F.lit(float("nan")), F.lit(float("inf"))), F.dayofmonth("timestamp") % 3 + 1)
    spoilt = slots.withColumn("avg_speed", F.when(F.col("hour") % 5 == 0, odd).otherwise(F.col("avg_speed")))
    return cleaning.finite_speeds(spoilt).select("timestamp", "avg_speed")


# -- states -----------------------------------------------------------------------------

@query
def state_summary_ranked(spark, sf_dir):
    return states.state_summary(d.state_slots(spark, sf_dir))


@query
def state_labelled_slots(spark, sf_dir):
    return states.label_states(d.state_slots(spark, sf_dir)).select(
        "timestamp", "prediction", "avg_speed", "cluster_label")


@query
def congested_state(spark, sf_dir):
    return states.congested_state(d.state_slots(spark, sf_dir))


@query
def silhouette_by_label(spark, sf_dir):
    return silhouettes.silhouette(d.table(spark, sf_dir, "embeddings"), "embedding", "label")


@query
def silhouette_many_groups(spark, sf_dir):
    """The silhouette of every vector where about every third vector is a group, in blocks of 16 groups."""
    points = d.table(spark, sf_dir, "embeddings").withColumn("group", F.expr("vec_id div 3"))
    return silhouettes.silhouette_values(points, "embedding", "group", block_groups=16).select("vec_id", "group", "silhouette")


@query
def kmeans_states(spark, sf_dir):
    slots = stage(d.clean_slots(spark, sf_dir), "slots")
    fitted = states.fit_states(slots, 3, 3)
    return states.label_states(states.assign_states(slots, fitted))


@query
def k_sweep(spark, sf_dir):
    return states.fit_states(stage(d.clean_slots(spark, sf_dir), "slots"), 2, 6).scores


@query
def kmeans_certificate(spark, sf_dir):
    """Fitted states checked as an optimum over the slots they were fitted on."""
    slots = stage(d.clean_slots(spark, sf_dir), "slots")
    fitted = states.fit_states(slots, 3, 3)
    check = certificates.state_certificate(states.assign_states(slots, fitted), fitted)
    return check.select("rows", "states", "not_nearest", (F.col("centre_gap") < 0.05).cast("int").alias("centres_are_means"))


@query
def k_sweep_certificate(spark, sf_dir):
    """The sweep's choice: the best of the tried scores, and what the silhouette of its states is by their moments."""
    slots = stage(d.clean_slots(spark, sf_dir), "slots")
    fitted = states.fit_states(slots, 2, 6)
    vectors = fitted.model.transform(slots)
    own = silhouettes.silhouette(vectors, "features", "prediction").select("silhouette").scalar()
    chosen = F.max(F.when(F.col("k") == fitted.k, F.col("silhouette")))
    return fitted.scores.agg(
        F.count("*").alias("tried"), F.min("k").alias("kmin"), F.max("k").alias("kmax"),
        (chosen == F.max("silhouette")).cast("int").alias("best_chosen"),
        (F.abs(chosen - own) < 1e-6).cast("int").alias("score_confirmed"),
    ).withColumn("rows", slots.select(F.count("*")).scalar())


# -- horizon ----------------------------------------------------------------------------

_LABEL_COLUMNS = ("timestamp", "prediction", "prediction_next", "label")


@query
def horizon_label_rows(spark, sf_dir):
    slots = stage(d.state_slots(spark, sf_dir), "state-slots")
    return horizon.label_by_rows(slots, states.congested_state(slots), horizon.lead_steps(
        d.HORIZON_MIN, d.FREQ_MIN)).select(*_LABEL_COLUMNS)


@query
def horizon_label_time(spark, sf_dir):
    slots = stage(d.state_slots(spark, sf_dir), "state-slots")
    return horizon.label_by_time(slots, states.congested_state(slots), d.HORIZON_MIN).select(
        *_LABEL_COLUMNS)


@query
def class_weights(spark, sf_dir):
    return d.samples(spark, sf_dir).groupBy("label", "is_test", "weight").agg(
        F.count("*").alias("count"))


@query
def class_balance(spark, sf_dir):
    return horizon.class_balance(d.samples(spark, sf_dir))


@query
def split_flag(spark, sf_dir):
    """The split of every event by time key, put together again from its two parts."""
    events = d.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timestamp"))
    flagged = horizon.with_test_flag(events)
    return horizon.train_rows(flagged).unionByName(horizon.test_rows(flagged))


@query
def purged_split(spark, sf_dir):
    """Blocks of time for the test, and how many train rows lie within a horizon of a test row (none)."""
    rows = horizon.with_purged_split(d.state_slots(spark, sf_dir).select("timestamp"), d.HORIZON_MIN, blocks=20)
    near = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(d.HORIZON_MIN))
    train, test = horizon.train_rows(rows), horizon.test_rows(rows).select(F.col("timestamp").alias("t"))
    # Hours of the two sides that may be near each other meet in an equi-join.
    hours = F.explode(F.sequence(F.date_trunc("hour", F.col("t") - near), F.date_trunc("hour", F.col("t") + near), F.expr("interval 1 hour")))
    close = train.withColumn("h", F.date_trunc("hour", "timestamp")).join(test.select("t", hours.alias("h")), "h").where(
        (F.col("t") - F.col("timestamp") <= near) & (F.col("timestamp") - F.col("t") <= near))
    return rows.agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows"),
        F.count_if(F.col("is_test").isNull()).alias("embargoed"),
    ).withColumn("too_close", close.select(F.count("*")).scalar())


# -- model ------------------------------------------------------------------------------

@query
def standardized_features(spark, sf_dir):
    return d.standardized(spark, sf_dir).select("timestamp", *[f"z_{c}" for c in fv.FEATURES])


@query
def score_fixed_logistic(spark, sf_dir):
    return d.scored(spark, sf_dir).select(
        "timestamp", "prob_congestion", "prediction_congested", "label", "is_test", "weight")


@query
def feature_importance(spark, sf_dir):
    """Importance of the fixed coefficients, with the spread of each feature in the data."""
    m = scoring.feature_moments(horizon.train_rows(d.samples(spark, sf_dir)))
    spread = m.unpivot([], [f"{c}_std" for c in fv.FEATURES], "name", "feature_std").select(
        F.regexp_replace("name", "_std$", "").alias("feature"), "feature_std")
    return scoring.feature_importance(spark, fv.PUBLISHED_COEFFICIENTS).join(spread, "feature")


@query
def train_logistic(spark, sf_dir):
    """Train, save, load again and score every sample."""
    rows = stage(d.samples(spark, sf_dir), "samples")
    path = new_path(spark, "model")
    training.save_model(training.model_of(rows), path)
    return training.score(rows, training.load_model(path)).drop("probability")


@query
def logistic_certificate(spark, sf_dir):
    """The trained model checked as an optimum over its train rows, and scores before and after it was stored."""
    rows = stage(d.samples(spark, sf_dir), "samples")
    model = training.model_of(rows)
    path = new_path(spark, "model")
    training.save_model(model, path)
    loaded = training.load_model(path)
    check = certificates.logistic_certificate(horizon.train_rows(rows), loaded)
    same = certificates.differing_scores(training.score(rows, model), training.score(rows, loaded))
    return check.select(F.col("rows").alias("train_rows"), (F.col("violation") < 1e-3).cast("int").alias("optimal")).withColumns({
        "scored": same.select("scored").scalar(), "differing": same.select("differing").scalar()})


# -- evaluation -------------------------------------------------------------------------

@query
def confusion(spark, sf_dir):
    return evaluation.confusion(d.scored(spark, sf_dir))


def _curve(spark, sf_dir):
    rows = d.scored(spark, sf_dir).select("label", "prob_congestion")
    return evaluation.score_curve(stage(rows, "scores"))


@query
def roc_points(spark, sf_dir):
    return evaluation.roc_points(_curve(spark, sf_dir))


@query
def roc_chart(spark, sf_dir):
    """The curve thinned to 20 pieces."""
    return evaluation.chart_points(_curve(spark, sf_dir), 20)


@query
def roc_chart_error(spark, sf_dir):
    check = evaluation.chart_error(_curve(spark, sf_dir), 20)
    return check.withColumn("within", (F.abs("error") <= F.col("bound")).cast("int")).drop("error")


@query
def auc_roc(spark, sf_dir):
    return evaluation.curve_areas(_curve(spark, sf_dir)).select("auc_roc")


@query
def auc_pr(spark, sf_dir):
    return evaluation.curve_areas(_curve(spark, sf_dir)).select("auc_pr")


@query
def average_precision(spark, sf_dir):
    return evaluation.curve_areas(_curve(spark, sf_dir)).select("average_precision")


@query
def auc_documents(spark, sf_dir):
    """All areas with document length as the score of its quality label (many ties)."""
    rows = d.table(spark, sf_dir, "labels").join(d.table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("quality").alias("label"), F.col("n_chars").alias("prob_congestion"))
    return evaluation.curve_areas(evaluation.score_curve(rows))


@query
def accuracy_f1_weighted(spark, sf_dir):
    return evaluation.label_metrics(d.scored(spark, sf_dir)).select("accuracy", "f1_weighted")


@query
def precision_recall_f1(spark, sf_dir):
    return evaluation.label_metrics(evaluation.evaluation_rows(d.scored(spark, sf_dir))).select(
        "precision", "recall", "f1")


@query
def run_summary(spark, sf_dir):
    return evaluation.run_summary(d.scored(spark, sf_dir))


# -- reports ----------------------------------------------------------------------------

#: Query -> report.
_SLOT_REPORTS = {
    "overview": "overview", "state_distribution": "cluster_distribution", "congestion_summary": "congestion_summary",
    "hourly_summary": "hourly_summary", "weekday_summary": "weekday_summary", "top_congestion": "top_congestion",
    "speed_histogram": "histogram_avg_speed", "daily_summary": "daily_avg_speed",
    "weekday_hour_heatmap": "weekday_hour_heatmap",
}


def _report(spark, sf_dir, name):
    return report_cube.report(report_cube.base_cube(d.scored(spark, sf_dir)), name)


for _query, _name in _SLOT_REPORTS.items():

    def _slot_report(spark, sf_dir, _name=_name):
        return _report(spark, sf_dir, _name)

    _slot_report.__name__ = _query
    query(_slot_report)


@query
def slot_hourly_speed(spark, sf_dir):
    """Mean speed and spread per hour straight from the readings."""
    slots = features.with_calendar(features.slot_average(d.cells(spark, sf_dir)))
    return slots.groupBy("hour").agg(
        F.avg("avg_speed").alias("avg_speed"), F.stddev_samp("avg_speed").alias("std_speed_hour"),
        F.count("*").alias("count")).orderBy("hour")


@query
def sensor_activity(spark, sf_dir):
    return reports.sensor_activity(d.readings(spark, sf_dir))


@query
def top_sensor_hourly(spark, sf_dir):
    """Hourly means of the most active of many sensors (users seen as sensors)."""
    by_user = rd.clean_readings(
        d.table(spark, sf_dir, "events").withColumn("sensor", F.col("user_id").cast("string")),
        "ts", "sensor", "value")
    return reports.top_sensor_hourly(by_user)


@query
def hourly_std_mean(spark, sf_dir):
    """The figure read from the stored report, and where it tells none from the newest run."""
    rows = stage(d.scored(spark, sf_dir), "scored")
    cube = stage(report_cube.base_cube(rows), "cube")
    base = new_path(spark, "runs")
    io.write_predictions(rows.select("timestamp", "hour", "avg_speed", "prob_congestion"), base, d.HORIZON_MIN)
    hourly, states_ = (report_cube.report(cube, x) for x in ("hourly_summary", "cluster_distribution"))
    untold = hourly.withColumn("std_speed_hour", F.lit(None).cast("double"))
    newest = lambda: io.newest_run(spark, base)
    return reports.shown_totals(hourly, states_, newest).unionByName(reports.shown_totals(untold, states_, newest))


@query
def report_cube_rollups(spark, sf_dir):
    return report_cube.all_reports(d.scored(spark, sf_dir))


def _partly_unknown(spark, sf_dir):
    """Scored slots in which every hour of some days lacks its probability."""
    known = F.when(F.dayofmonth("timestamp") % 3 != 0, F.col("prob_congestion"))
    return d.scored(spark, sf_dir).withColumn("prob_congestion", known)


@query
def report_cube_unknown(spark, sf_dir):
    """The roll-ups where some probabilities are null."""
    return report_cube.all_reports(_partly_unknown(spark, sf_dir)).select(
        "report", *report_cube.KEYS, "count", "avg_prob_congestion")


@query
def stored_runs(spark, sf_dir):
    """Two horizons, one written again over fewer days: what the catalogue and the readers see."""
    rows = stage(d.scored(spark, sf_dir), "scored").select("timestamp", "hour", "avg_speed", "prob_congestion")
    base = new_path(spark, "runs")
    io.write_predictions(rows, base, d.HORIZON_MIN)
    io.write_predictions(rows, base, 2 * d.HORIZON_MIN)
    again = io.write_predictions(rows.where(F.dayofmonth("timestamp") > 9), base, d.HORIZON_MIN)
    newest, kept = io.newest_run(spark, base), io.read_predictions(spark, again)
    return io.run_catalog(spark, base).select("run_name", "horizon").withColumns({
        "newest_rows": newest.select(F.count("*")).scalar(), "newest_hours": newest.select(F.sum("hour")).scalar(),
        "rows_again": kept.select(F.count("*")).scalar()})


# -- report input and output ------------------------------------------------------------

@query
def report_union_dedup(spark, sf_dir):
    """A report found in two places, the first incomplete and with repeats, the greater ones first."""
    hourly = stage(_report(spark, sf_dir, "hourly_summary"), "hourly")
    first, second = new_path(spark, "place"), new_path(spark, "place")
    early = hourly.where(F.col("hour") < 12)
    twice = early.unionByName(early.withColumn("count", F.col("count") + 7))
    io.write_json(twice.coalesce(1).sortWithinPartitions("hour", F.desc("count")), first)
    io.write_json(hourly.withColumn("count", F.col("count") + 1000), second)
    return io.read_report(
        spark, [first, second], "hour int, avg_speed double, count long", ("hour",))


@query
def plan_reload(spark, sf_dir):
    path = new_path(spark, "plan")
    io.write_plan_csv(plan.signal_plan(d.scored(spark, sf_dir), d.HORIZON_MIN), path)
    return io.read_signal_plan(spark, path).drop("last_updated")


@query
def plan_by_header(spark, sf_dir):
    """A plan whose files have their columns in another order, and some lack the strategy."""
    path = new_path(spark, "plan")
    rows = stage(plan.signal_plan(d.scored(spark, sf_dir), d.HORIZON_MIN), "plan")
    even = F.col("hour") % 2 == 0
    io.write_csv(rows.where(even).select(*reversed(rows.columns)), path)
    rows.where(~even).drop("strategy").write.mode("append").option("header", True).csv(path)
    return io.read_signal_plan(spark, path).drop("last_updated")


@query
def prediction_reload(spark, sf_dir):
    """Stored predictions without a time column get it back from date and hour."""
    path = new_path(spark, "predict")
    d.scored(spark, sf_dir).select(
        F.to_date("timestamp").alias("date"), "hour", "prob_congestion", "label").write.parquet(path)
    return io.read_predictions(spark, path).select("timestamp", "prob_congestion", "label")


@query
def run_catalog(spark, sf_dir):
    """Horizon token of run names of every spelling."""
    n = F.col("event_id") % 6
    suffix = (F.when(n == 0, "M").when(n == 1, "h").when(n == 2, "").when(n == 3, "m")
              .when(n == 4, "_latest").otherwise("_warm"))
    names = d.table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("predict_0"), F.col("user_id").cast("string"), suffix).alias("run_name"))
    return names.withColumn("horizon", io.horizon_token(F.col("run_name")))


@query
def sink_roundtrip(spark, sf_dir):
    """Scored slots through every sink and back."""
    rows = stage(d.scored(spark, sf_dir), "scored").select("timestamp", "hour", "avg_speed", "prob_congestion")
    schema = "timestamp timestamp_ntz, hour int, avg_speed double, prob_congestion double"
    csv, cleaned, json, parquet = (new_path(spark, n) for n in ("csv", "cleaned", "json", "parquet"))
    io.write_csv(rows, csv)
    io.write_cleaned_csv(rows, cleaned)
    io.write_json(rows, json)
    run = io.write_predictions(rows, parquet, d.HORIZON_MIN)
    read_csv = spark.read.schema(schema).option("header", True)
    back = {"csv": read_csv.csv(csv), "cleaned_csv": read_csv.csv(cleaned),
            "json": spark.read.schema(schema).json(json),
            "parquet": io.read_predictions(spark, run)}
    out = None
    for name, df in back.items():
        part = df.select(F.lit(name).alias("sink"), *rows.columns)
        out = part if out is None else out.unionByName(part)
    return out


# -- plan -------------------------------------------------------------------------------

@query
def signal_plan(spark, sf_dir):
    return plan.signal_plan(d.scored(spark, sf_dir), d.HORIZON_MIN)


@query
def plan_top5(spark, sf_dir):
    return plan.riskiest(plan.signal_plan(d.scored(spark, sf_dir), d.HORIZON_MIN)).select(
        "date", "hour", "avg_prob_percent", "avg_speed", "count_samples", "green_extension_pct", "strategy")


# -- requests ---------------------------------------------------------------------------

@query
def request_coercion(spark, sf_dir):
    raw = d.raw_requests(d.table(spark, sf_dir, "events"))
    return requests.coerce_requests(raw).drop("std_speed_auto", "location")


def _prepared(spark, sf_dir, source=None):
    """Requests completed from the spread of the hours that the scored slots know."""
    samples, fitted = d.samples_and_parameters(spark, sf_dir)
    hourly = stage(samples.groupBy("hour").agg(
        F.stddev_samp("avg_speed").alias("std_speed_hour")), "hourly")
    source = d.table(spark, sf_dir, "events") if source is None else source
    return fitted, requests.prepare_requests(d.raw_requests(source), hourly, d.now())


@query
def request_defaults(spark, sf_dir):
    return _prepared(spark, sf_dir)[1].select(
        "event_id", "hour", "weekday", "timestamp", "std_speed_hour", "std_speed_auto")


@query
def request_errors(spark, sf_dir):
    return requests.rejected(_prepared(spark, sf_dir)[1]).select(
        "event_id", F.array_join("errors", "|").alias("errors"))


def _response(fitted, prepared):
    z = scoring.standardize(requests.accepted(prepared), fitted)
    scored = scoring.logistic_score(z).withColumnRenamed("prediction_congested", "prediction")
    return requests.response(scored.drop(*[f"z_{c}" for c in fv.FEATURES]))


def _flat_response(df):
    return df.select(
        "event_id", "status", "prediction", "prob_congestion",
        F.col("probability_distribution")[0].alias("prob_clear"), "strategy.level",
        "strategy.green_extension_pct", "strategy.strategy", "inputs.location", "inputs.latitude")


@query
def request_scores(spark, sf_dir):
    return _flat_response(_response(*_prepared(spark, sf_dir)))


# -- chart data -------------------------------------------------------------------------

@query
def series_tail(spark, sf_dir):
    return chartdata.series_tail(d.scored(spark, sf_dir))


@query
def last_rows(spark, sf_dir):
    """The latest rows of a run without the model's internals."""
    return chartdata.last_rows(d.scored(spark, sf_dir), 500).select("timestamp", "avg_speed", "hour", "prob_congestion", "label")


def _labelled(spark, sf_dir):
    return states.label_states(d.state_slots(spark, sf_dir))


@query
def series_head(spark, sf_dir):
    return chartdata.series_head(d.scored(spark, sf_dir), 400)


@query
def scatter_head(spark, sf_dir):
    return chartdata.scatter_head(_labelled(spark, sf_dir), 5000)


@query
def series_hourly(spark, sf_dir):
    return chartdata.series_hourly(d.scored(spark, sf_dir))


@query
def scatter_counts(spark, sf_dir):
    return chartdata.scatter_counts(_labelled(spark, sf_dir))


@query
def scatter_sample(spark, sf_dir):
    return chartdata.scatter_spread(_labelled(spark, sf_dir), per_mille=400)


@query
def box_stats(spark, sf_dir):
    return chartdata.box_stats(_labelled(spark, sf_dir))


@query
def kde_grid(spark, sf_dir):
    return chartdata.kde_grid(_labelled(spark, sf_dir))


# -- streams ----------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    return jobs.parquet_stream(spark, sf_dir, "events.parquet", d.EVENT_SCHEMA)


def _drained(df, name, mode="append"):
    spark = df.sparkSession
    path = new_path(spark, name)
    jobs.run_available(df, path, new_path(spark, f"{name}-progress"), mode)
    return spark.read.schema(df.schema).parquet(path)


@query
def stream_scores(spark, sf_dir):
    fitted, prepared = _prepared(spark, sf_dir, _event_stream(spark, sf_dir))
    return _drained(_flat_response(_response(fitted, prepared)), "stream-scores")


@query
def served_requests(spark, sf_dir):
    """Requests as JSON files answered by the stream with a stored model, against the same requests scored in batch."""
    rows = stage(d.samples(spark, sf_dir), "samples")
    out, folder, answers, rejects = (new_path(spark, n) for n in ("served-job", "requests", "answers", "rejects"))
    model = training.model_of(rows)
    training.save_model(model, f"{out}/models/logistic_pipeline")
    spread = rows.groupBy("hour").agg(F.coalesce(F.stddev_samp("avg_speed"), F.lit(0.0)).alias("std_speed_hour"))
    spread.write.parquet(f"{out}/models/hourly_spread")
    raw = d.raw_requests(d.table(spark, sf_dir, "events"))
    raw.select(*[F.col(c).cast("string").alias(c) for c in requests.REQUEST_FIELDS]).write.json(folder)
    jobs.serve_requests(spark, folder, out, answers, rejects, new_path(spark, "progress"), d.now()).awaitTermination()
    asked = requests.prepare_requests(raw, spark.read.parquet(f"{out}/models/hourly_spread"), d.now())
    told = lambda df: df.select(F.to_json(F.struct("status", "prediction", "strategy", F.col("inputs").dropFields("timestamp"), F.round("prob_congestion", 9))).alias("x"))
    batch = told(requests.score_requests(requests.accepted(asked), model)).groupBy("x").agg(F.count("*").alias("n"))
    served = told(spark.read.parquet(answers)).groupBy("x").agg(F.count("*").alias("m"))
    return batch.join(served, "x", "full_outer").agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("answered"), F.count_if(~F.col("n").eqNullSafe(F.col("m"))).alias("differing"),
    ).withColumn("rejected", spark.read.parquet(rejects).select(F.count("*")).scalar())


@query
def stream_slot_avg(spark, sf_dir):
    """Closed slots of the stream: the filled network mean that the model is trained with."""
    profile = stage(cleaning.sensor_means(d.cells(spark, sf_dir)), "profile")
    readings = jobs.events_stream_as_readings(_event_stream(spark, sf_dir))
    return _drained(jobs.stream_slot_means(readings, profile, d.FREQ_MIN), "stream-slots")


@query
def stream_plan(spark, sf_dir):
    """The plan after two restarts: the first run's source told other probabilities, the last one begins anew."""
    scored = stage(d.scored(spark, sf_dir).select("timestamp", "avg_speed", "prob_congestion"), "scored")
    stale = stage(scored.withColumn("prob_congestion", F.col("prob_congestion") / 2), "scored")
    path, progress = new_path(spark, "stream-plan"), new_path(spark, "stream-plan-progress")
    for source, checkpoint in ((stale, progress), (stale, progress), (scored, f"{progress}-anew")):
        folder = source.inputFiles()[0].rsplit("/", 1)[0]
        stream = jobs.parquet_stream(spark, folder, "*.parquet", scored.schema, files_per_trigger=1)
        jobs.stream_plan(stream, path, checkpoint).awaitTermination()
    return jobs.stored_plan(spark, path, d.HORIZON_MIN)


@query
def stream_dedup(spark, sf_dir):
    events = _event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    repeated = events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    return _drained(jobs.drop_repeats(repeated, ["event_id"]), "stream-dedup")


# -- the whole job ----------------------------------------------------------------------

# Tables of the job: format, the column whose sum is told, and whether the number of rows is told. Where it is not, it depends on the fit.
_JOB_TABLES = {
    "readings": ("parquet", None, True), "cells": ("parquet", None, True), "sensor_profile": ("parquet", "observed", True),
    "slot_means": ("parquet", None, True), "hourly_spread": ("parquet", None, True), "outlier_bounds": ("parquet", None, True),
    "slots": ("parquet", None, True), "missing_profile": ("json", "missing_count", True), "cleaned": ("parquet", None, True),
    "analysis/sensor_activity": ("json", "count", True), "analysis/top_sensor_hourly": ("json", None, True),
    "silhouette_scores": ("csv", None, True), "clustered": ("parquet", None, True), "cluster_summary": ("csv", "row_count", True),
    f"samples_{d.HORIZON_MIN}m": ("parquet", None, True), "evaluation/grid_scores": ("json", None, True),
    "models/hourly_spread": ("parquet", None, True), "analysis/logistic_feature_importance": ("json", None, True),
    "predictions": ("parquet", None, True), "evaluation/confusion": ("json", "count", False), "report_cube": ("parquet", "n", False),
    "signal_plan": ("csv", "count_samples", True), "signal_plan_json": ("json", "count_samples", True),
    "charts/state_boxes": ("json", "n", True), "charts/state_scatter": ("json", "count", False), "charts/probability_series": ("json", "count", True),
    "analysis/overview": ("json", "total_rows", True), "analysis/cluster_distribution": ("json", "count", True),
    "analysis/congestion_summary": ("json", "count", False), "analysis/hourly_summary": ("json", "count", True),
    "analysis/weekday_summary": ("json", "count", True), "analysis/histogram_avg_speed": ("json", "count", False),
    "analysis/daily_avg_speed": ("json", "count", True), "analysis/weekday_hour_heatmap": ("json", "count", True),
}


def _job_input(spark, sf_dir):
    """Every event in both layouts: a wide CSV with a row per event (its value under its own type), and long readings."""
    events = d.table(spark, sf_dir, "events").where("event_type IS NOT NULL")
    # The sensors are the columns of the wide file.
    sensors = sorted(r.event_type for r in events.select("event_type").distinct().collect())
    wide, long = new_path(spark, "wide-csv"), new_path(spark, "long")
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    io.write_csv(events.select(when, *[F.when(F.col("event_type") == s, F.col("value")).alias(s) for s in sensors]), wide)
    events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("sensor"), F.col("value").alias("speed")).write.parquet(long)
    return ("wide", wide), ("long", long)


@query
def whole_job_tables(spark, sf_dir):
    """Tables of the batch job over all events, as a wide CSV and as long readings: rows, and what their counts add up to."""
    out = None
    for layout, source in _job_input(spark, sf_dir):
        done = job.run(spark, source, new_path(spark, f"job-{layout}"), kmin=3, kmax=3, horizon_min=d.HORIZON_MIN,
                       freq_min=d.FREQ_MIN, layout=layout)
        for name, (kind, column, sized) in _JOB_TABLES.items():
            path = done.tables.get(name)
            if path is None and not done.skipped:
                raise ValueError(f"the job did not write {name}")
            if path is None:  # the job ends early where no slot is usable or no model can be trained: no rows
                table = spark.createDataFrame([], f"{column or 'x'} long")
            elif name == "readings":
                table = rd.read_readings(spark, path)
            elif kind == "parquet":
                table = spark.read.parquet(path)
            elif kind == "csv":
                table = spark.read.option("header", True).csv(path)
            else:
                table = spark.read.schema(f"{column or 'x'} long").json(path)
            rows = F.count("*") if sized else F.lit(None).cast("long")
            counted = F.coalesce(F.sum(F.col(column).cast("long")), F.lit(0)) if column else F.lit(None).cast("long")
            row = table.agg(F.lit(layout).alias("layout"), F.lit(name.removeprefix("analysis/")).alias("name"), rows.alias("rows"), counted.alias("counted"))
            out = row if out is None else out.unionByName(row)
    return out
