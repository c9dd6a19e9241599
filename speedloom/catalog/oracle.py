"""The registered queries as SQL for an independent engine.

Each statement is written from the definition of its query and not from the Spark plan:
gaps are filled on the full grid, quantiles and curves use whole-table windows, and so on.
"""

from __future__ import annotations

from speedloom import fixed_values as fv

ORACLES: dict[str, str] = {}

_C = fv.PUBLISHED_COEFFICIENTS

# Named steps in order; a statement gets the steps up to the one it names.
_STEPS: list[tuple[str, str]] = [
    ("readings", """
        SELECT ts, event_type AS sensor, event_id, user_id,
               CASE WHEN value > 0 AND value <= 120 THEN value END AS speed
        FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL"""),
    ("cells", """
        SELECT date_trunc('hour', ts) AS ts, sensor, avg(speed) AS speed
        FROM readings GROUP BY 1, 2"""),
    ("means", """
        SELECT sensor, count(speed) AS observed, avg(speed) AS mean_speed FROM cells GROUP BY sensor"""),
    ("grid", """
        SELECT t.ts, m.sensor, c.speed AS raw_speed, coalesce(c.speed, m.mean_speed) AS speed
        FROM (SELECT DISTINCT ts FROM cells) t CROSS JOIN means m
        LEFT JOIN cells c ON c.ts = t.ts AND c.sensor = m.sensor"""),
    ("base", """
        SELECT ts AS "timestamp", avg(speed) AS avg_speed, CAST(hour(ts) AS BIGINT) AS "hour",
               CAST(dayofweek(ts) + 1 AS BIGINT) AS weekday
        FROM grid GROUP BY ts HAVING avg(speed) IS NOT NULL"""),
    ("featured", """
        SELECT b.*, s.std_speed_hour FROM base b JOIN (
            SELECT "hour" AS h, coalesce(stddev_samp(avg_speed), 0) AS std_speed_hour
            FROM base GROUP BY 1) s ON b."hour" = s.h"""),
    ("bounds", """
        SELECT q1, q3, q3 - q1 AS iqr, q1 - 2.5 * (q3 - q1) AS lower_bound,
               q3 + 2.5 * (q3 - q1) AS upper_bound
        FROM (SELECT quantile_disc(avg_speed, 0.25) AS q1, quantile_disc(avg_speed, 0.75) AS q3
              FROM base)"""),
    ("slots", """
        SELECT f.* FROM featured f, bounds
        WHERE avg_speed BETWEEN lower_bound AND upper_bound AND avg_speed > 5 AND avg_speed < 110"""),
    ("states", """
        SELECT *, CAST(CASE WHEN avg_speed < 32 THEN 0 WHEN avg_speed < 43 THEN 1 ELSE 2 END AS BIGINT)
               AS prediction FROM slots"""),
    ("summary", f"""
        SELECT prediction, avg_speed_mean, row_count, rank_by_speed,
               CASE WHEN rank_by_speed = 1 THEN '{fv.STATE_CONGESTED}'
                    WHEN rank_by_speed = count(*) OVER () THEN '{fv.STATE_FREE}'
                    ELSE '{fv.STATE_NORMAL}' END AS cluster_label
        FROM (SELECT prediction, avg(avg_speed) AS avg_speed_mean, count(*) AS row_count,
                     row_number() OVER (ORDER BY avg(avg_speed), prediction) AS rank_by_speed
              FROM states GROUP BY prediction)"""),
    ("congested", """
        SELECT prediction AS congested FROM (
            SELECT prediction, avg(avg_speed) AS m FROM states GROUP BY 1) ORDER BY m, prediction LIMIT 1"""),
    ("labelled", """
        SELECT s.*, CAST(s.prediction_next = (SELECT congested FROM congested) AS BIGINT) AS label,
               CAST('0x' || substr(md5(strftime("timestamp", '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) % 10 >= 8
               AS is_test
        FROM (SELECT *, lead(prediction, 3) OVER (
                  PARTITION BY CAST("timestamp" AS DATE) ORDER BY "timestamp") AS prediction_next
              FROM states) s
        WHERE prediction_next IS NOT NULL"""),
    ("samples", """
        SELECT l.*, CASE WHEN label = 1 THEN (
            SELECT count(*) FILTER (WHERE label = 0) * 1.0 / count(*) FILTER (WHERE label = 1)
            FROM labelled WHERE NOT is_test) ELSE 1.0 END::DOUBLE AS weight
        FROM labelled l"""),
    ("moments", "SELECT " + ", ".join(
        f'avg("{c}") AS {c}_mean, stddev_samp("{c}") AS {c}_std' for c in fv.FEATURES)
        + " FROM samples WHERE NOT is_test"),
    ("z", "SELECT s.*, " + ", ".join(
        f'(s."{c}" - {c}_mean) / {c}_std AS z_{c}' for c in fv.FEATURES)
        + " FROM samples s, moments"),
    ("scored", f"""
        SELECT *, CAST(prob_congestion > {fv.DECISION_THRESHOLD} AS DOUBLE) AS prediction_congested,
               CAST("timestamp" AS DATE) AS d, strftime("timestamp", '%Y-%m-%d') AS "date"
        FROM (SELECT *, 1.0 / (1.0 + exp(-({fv.DEFAULT_INTERCEPT} + {" + ".join(
            f"({_C[c]!r}) * z_{c}" for c in fv.FEATURES)}))) AS prob_congestion FROM z)"""),
    ("hourly", """
        SELECT "hour", avg(avg_speed) AS avg_speed, avg(prob_congestion) AS avg_prob_congestion,
               stddev_samp(avg_speed) AS std_speed_hour, count(*) AS "count"
        FROM scored GROUP BY 1"""),
    ("plan", f"""
        SELECT *, CASE WHEN green_extension_pct > 0
                       THEN '{fv.TEXT_EXTEND.split("{}")[0]}' || green_extension_pct || '%'
                       ELSE '{fv.TEXT_SHORTEN.split("{}")[0]}' || abs(green_extension_pct) || '%' END
               AS strategy
        FROM (SELECT *, CAST(CASE WHEN avg_prob >= 0.7 THEN 30 WHEN avg_prob >= 0.5 THEN 20
                             WHEN avg_prob >= 0.3 THEN 10 ELSE -10 END AS BIGINT) AS green_extension_pct
              FROM (SELECT "date", "hour", avg(prob_congestion) AS avg_prob, avg(avg_speed) AS avg_speed,
                           count(*) AS count_samples FROM scored GROUP BY 1, 2))"""),
    ("curve", """
        SELECT s, sum(p) AS p, sum(n) AS n, sum(sum(p)) OVER w AS tp, sum(sum(n)) OVER w AS fp,
               sum(sum(p)) OVER () AS np, sum(sum(n)) OVER () AS nn
        FROM (SELECT prob_congestion AS s, label AS p, 1 - label AS n FROM scored) GROUP BY s
        WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)"""),
    ("named", """
        SELECT t."timestamp", t.prediction, t.avg_speed, m.cluster_label, CAST(t."hour" AS BIGINT) AS "hour"
        FROM states t JOIN summary m ON t.prediction = m.prediction"""),
    ("raw", """
        SELECT event_id, event_type AS location,
          CASE event_id % 11 WHEN 0 THEN v WHEN 1 THEN ' ' || v || ' ' WHEN 2 THEN v WHEN 3 THEN ''
            WHEN 4 THEN v WHEN 5 THEN 'abc' WHEN 6 THEN v WHEN 7 THEN 'nan' WHEN 8 THEN v
            WHEN 9 THEN '1e2' ELSE v END AS avg_speed,
          CASE event_id % 7 WHEN 0 THEN 'auto' WHEN 1 THEN ' AUTO ' WHEN 2 THEN '4.25' WHEN 3 THEN NULL
            WHEN 4 THEN 'x' WHEN 5 THEN v ELSE 'inf' END AS std_speed_hour,
          CASE event_id % 6 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '17.9' WHEN 2 THEN '24'
            WHEN 3 THEN NULL WHEN 4 THEN ' 8 ' ELSE '-0.5' END AS "hour",
          CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN '7' WHEN 2 THEN NULL WHEN 3 THEN '3.5'
            ELSE '' END AS weekday,
          CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
            WHEN 3 THEN date_trunc('minute', ts) WHEN 5 THEN TIMESTAMP '2024-03-05' END AS "timestamp",
          CASE event_id % 3 WHEN 0 THEN '10.5' WHEN 1 THEN 'x' ELSE '-3' END AS latitude,
          CASE event_id % 2 WHEN 0 THEN '106.25' END AS longitude
        FROM (SELECT *, CAST(value AS VARCHAR) AS v FROM events)"""),
    ("coerced", """
        SELECT event_id, location, "timestamp",
          CASE WHEN isfinite(TRY_CAST(trim(avg_speed) AS DOUBLE)) THEN TRY_CAST(trim(avg_speed) AS DOUBLE) END
            AS avg_speed,
          CASE WHEN isfinite(TRY_CAST(trim(std_speed_hour) AS DOUBLE))
            THEN TRY_CAST(trim(std_speed_hour) AS DOUBLE) END AS std_speed_hour,
          CASE WHEN trunc(TRY_CAST(trim("hour") AS DOUBLE)) BETWEEN 0 AND 23
            THEN CAST(trunc(TRY_CAST(trim("hour") AS DOUBLE)) AS BIGINT) END AS "hour",
          CASE WHEN trunc(TRY_CAST(trim(weekday) AS DOUBLE)) BETWEEN 1 AND 7
            THEN CAST(trunc(TRY_CAST(trim(weekday) AS DOUBLE)) AS BIGINT) END AS weekday,
          TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude
        FROM raw"""),
    ("completed", """
        SELECT c.event_id, c.location, c.avg_speed, c.latitude, c."hour", c.weekday, c."timestamp",
               c.std_speed_hour IS NULL AS std_speed_auto,
               coalesce(c.std_speed_hour, h.std_speed_hour,
                        (SELECT avg(std_speed_hour) FROM hourly), 5.0) AS std_speed_hour
        FROM (SELECT event_id, location, avg_speed, latitude, std_speed_hour,
                     coalesce("hour", hour("timestamp"), 9) AS "hour",
                     coalesce(weekday, dayofweek("timestamp") + 1, 5) AS weekday,
                     coalesce("timestamp", TIMESTAMP '2024-02-01 09:30:00') AS "timestamp" FROM coerced) c
        LEFT JOIN hourly h ON c."hour" = h."hour" """),
    ("answered", f"""
        SELECT *, 1.0 / (1.0 + exp(-({fv.DEFAULT_INTERCEPT} + {" + ".join(
            f'({_C[c]!r}) * (c."{c}" - m.{c}_mean) / m.{c}_std' for c in fv.FEATURES)}))) AS prob_congestion
        FROM completed c, moments m WHERE avg_speed IS NOT NULL"""),
]


def _r(expr: str, name: str | None = None) -> str:
    return f'round({expr}, 6) AS "{name or expr}"'


def _add(name: str, step: str | None, body: str) -> None:
    """Register ``body`` over the named steps up to ``step``."""
    if step is None:
        ORACLES[name] = body.strip()
        return
    names = [n for n, _ in _STEPS]
    used = _STEPS[: names.index(step) + 1]
    steps = ",\n".join(f"{n} AS ({sql})" for n, sql in used)
    ORACLES[name] = f"WITH {steps}\n{body.strip()}"


# -- cleaning ---------------------------------------------------------------------------

_add("csv_roundtrip", None, """
    WITH c AS (SELECT date_trunc('hour', ts) AS ts, event_type AS sensor, max(value) AS v FROM events GROUP BY 1, 2)
    SELECT t.ts, s.sensor, round(CASE WHEN v > 0 AND v <= 120 THEN v END, 6) AS speed
    FROM (SELECT DISTINCT ts FROM c) t CROSS JOIN (SELECT DISTINCT sensor FROM c) s
    LEFT JOIN c ON c.ts = t.ts AND c.sensor = s.sensor""")
_add("finite_slots", "base", f"""
    SELECT "timestamp", {_r("avg_speed")} FROM base WHERE "hour" % 5 <> 0""")
_add("last_rows", "scored", f"""
    SELECT "timestamp", {_r("avg_speed")}, "hour", {_r("prob_congestion")}, label FROM scored ORDER BY "timestamp" DESC LIMIT 500""")
_add("parse_counts", None, """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE good) AS valid_rows, count(*) FILTER (WHERE NOT good) AS rejected_rows,
           5 * count(*) FILTER (WHERE good) AS readings, CAST(sum(known) FILTER (WHERE good) AS BIGINT) AS known, count(*) FILTER (WHERE NOT good) AS reject_texts
    FROM (SELECT slot, day(slot) % 7 <> 3 AS good, count(*) FILTER (WHERE v > 0 AND v <= 120) AS known
          FROM (SELECT date_trunc('hour', ts) AS slot, event_type, max(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1)""")
_add("validity_rule", "readings", f"""
    SELECT sensor, count(*) AS readings, count(speed) AS valid, count(*) - count(speed) AS rejected,
           {_r("min(speed)", "min_speed")}, {_r("max(speed)", "max_speed")} FROM readings GROUP BY 1""")
_add("missing_profile", "grid", """
    SELECT sensor, count(*) - count(raw_speed) AS missing_count,
           round((count(*) - count(raw_speed)) * 100.0 / count(*), 2)::DOUBLE AS missing_pct
    FROM grid GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
_add("missing_after_fill", "grid", """
    SELECT sensor, count(*) AS slots, count(*) - count(raw_speed) AS missing_count,
           count(*) - count(speed) AS missing_after_fill FROM grid GROUP BY 1""")
_add("sensor_means", "means", f"SELECT sensor, observed, {_r('mean_speed')} FROM means")
_add("iqr_bounds", "bounds", f"""
    SELECT {_r("q1")}, {_r("q3")}, {_r("iqr")}, {_r("lower_bound")}, {_r("upper_bound")} FROM bounds""")
_add("reading_quartiles", "readings", f"""
    SELECT sensor, count(speed) AS n, {_r("quantile_disc(speed, 0.25)", "q1")},
           {_r("quantile_disc(speed, 0.5)", "median")}, {_r("quantile_disc(speed, 0.75)", "q3")}
    FROM readings GROUP BY 1""")
_FEATURE_COLUMNS = f""" "timestamp", {_r("avg_speed")}, "hour", weekday, {_r("std_speed_hour")} """
_add("outlier_filter", "slots", f"SELECT {_FEATURE_COLUMNS} FROM slots")
_TIGHT = """
    SELECT *, NOT (avg_speed BETWEEN q1 - 0.5 * iqr AND q3 + 0.5 * iqr AND avg_speed > 5 AND avg_speed < 110)
    AS out FROM base, bounds"""
_add("outlier_counts", "bounds", f"""
    SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT out) AS rows_after,
           count(*) FILTER (WHERE out) AS rows_removed,
           round(count(*) FILTER (WHERE out) * 100.0 / count(*), 2)::DOUBLE AS removed_pct FROM ({_TIGHT})""")
_add("post_filter_stats", "bounds", f"""
    SELECT {_r("avg(avg_speed)", "mean_speed")}, {_r("min(avg_speed)", "min_speed")},
           {_r("max(avg_speed)", "max_speed")} FROM ({_TIGHT}) WHERE NOT out""")

# -- features ---------------------------------------------------------------------------

_add("slot_avg_speed", "base", f'SELECT "timestamp", {_r("avg_speed")} FROM base')
_add("slot_calendar", None, """
    SELECT event_id, CAST(hour(ts) AS BIGINT) AS "hour", CAST(dayofweek(ts) + 1 AS BIGINT) AS weekday,
           strftime(ts, '%Y-%m-%d') AS "date" FROM events""")
_add("hourly_std_feature", "featured", f"SELECT {_FEATURE_COLUMNS} FROM featured")

# -- states -----------------------------------------------------------------------------

_add("state_summary_ranked", "summary", f"""
    SELECT prediction, {_r("avg_speed_mean")}, row_count, rank_by_speed, cluster_label FROM summary""")
_add("state_labelled_slots", "named", f"""
    SELECT "timestamp", prediction, {_r("avg_speed")}, cluster_label FROM named""")
_add("congested_state", "congested", "SELECT congested FROM congested")
_SILHOUETTE = """
    WITH pts AS (SELECT vec_id, {label} AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    dims AS (SELECT vec_id, label, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM pts),
    centre AS (SELECT label AS c, i, sum(v) AS s FROM dims GROUP BY 1, 2),
    sizes AS (SELECT label AS c, count(DISTINCT vec_id) AS n, sum(v * v) AS sq FROM dims GROUP BY 1),
    norms AS (SELECT vec_id, label, sum(v * v) AS nx FROM dims GROUP BY 1, 2),
    dots AS (SELECT vec_id, c, sum(v * s) AS dot FROM dims JOIN centre USING (i) GROUP BY 1, 2),
    dist AS (SELECT n.vec_id, n.label, z.c, z.n, (z.n * n.nx + z.sq - 2 * dot) AS total
             FROM norms n JOIN dots t ON n.vec_id = t.vec_id JOIN sizes z ON z.c = t.c),
    ab AS (SELECT vec_id, max(CASE WHEN c = label THEN n END) AS own,
                  max(CASE WHEN c = label AND n > 1 THEN total / (n - 1) END) AS a,
                  min(CASE WHEN c <> label THEN total / n END) AS b, any_value(label) AS label FROM dist GROUP BY 1),
    vals AS (SELECT vec_id, label, CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""
_add("silhouette_by_label", None, _SILHOUETTE.format(label="label") + " SELECT round(avg(s), 6) AS silhouette FROM vals")
_add("silhouette_many_groups", None, _SILHOUETTE.format(label="vec_id // 3") + """
    SELECT vec_id, label AS "group", round(s, 6) AS silhouette FROM vals""")
_add("kmeans_certificate", "slots", """
    SELECT count(*) AS "rows", 3 AS states, 0 AS not_nearest, 1 AS centres_are_means FROM slots""")
_add("k_sweep_certificate", "slots", """
    SELECT 5 AS tried, 2 AS kmin, 6 AS kmax, 1 AS best_chosen, 1 AS score_confirmed, count(*) AS "rows" FROM slots""")

# -- horizon ----------------------------------------------------------------------------

_add("horizon_label_rows", "labelled", """
    SELECT "timestamp", prediction, prediction_next, label FROM labelled""")
_add("horizon_label_time", "congested", """
    SELECT a."timestamp", a.prediction, b.prediction AS prediction_next,
           CAST(b.prediction = (SELECT congested FROM congested) AS BIGINT) AS label
    FROM states a JOIN states b ON b."timestamp" = a."timestamp" + INTERVAL 180 MINUTE""")
_add("class_weights", "samples", f"""
    SELECT label, is_test, {_r("weight")}, count(*) AS "count" FROM samples GROUP BY label, is_test, weight""")
_add("class_balance", "samples", """
    SELECT count(*) AS samples, count(*) FILTER (WHERE label = 1) AS n_pos,
           count(*) FILTER (WHERE label = 0) AS n_neg,
           round(count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1), 6) AS pos_weight,
           count(*) FILTER (WHERE NOT is_test) AS train_rows, count(*) FILTER (WHERE is_test) AS test_rows
    FROM samples""")
_add("split_flag", None, """
    SELECT event_id, ts AS "timestamp",
           CAST('0x' || substr(md5(strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) % 10 >= 8 AS is_test
    FROM events""")

# -- model ------------------------------------------------------------------------------

_add("standardized_features", "z", 'SELECT "timestamp", ' + ", ".join(
    _r(f"z_{c}") for c in fv.FEATURES) + " FROM z")
_add("score_fixed_logistic", "scored", f"""
    SELECT "timestamp", {_r("prob_congestion")}, prediction_congested, label, is_test, {_r("weight")} FROM scored""")
_add("feature_importance", "moments", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({v!r}::DOUBLE, 6) AS coefficient, "
    f"round(abs({v!r}::DOUBLE) / ({' + '.join(f'abs({w!r}::DOUBLE)' for w in _C.values())}), 6) AS importance, "
    f"round({c}_std, 6) AS feature_std FROM moments" for c, v in _C.items()) + ")")

_add("purged_split", "states", """
    SELECT count(*) FILTER (WHERE b % 5 <> 4 AND NOT near) AS train_rows, count(*) FILTER (WHERE b % 5 = 4) AS test_rows,
           count(*) FILTER (WHERE b % 5 <> 4 AND near) AS embargoed, 0 AS too_close
    FROM (SELECT *, EXISTS (
              FROM range(4, 20, 5) t(i) WHERE s + 10800000000 >= i * w AND s < (i + 1) * w + 10800000000) AS near
          FROM (SELECT epoch_us("timestamp") - min(epoch_us("timestamp")) OVER () AS s, w, s // w AS b
                FROM states, (SELECT CAST(ceil((max(epoch_us("timestamp")) - min(epoch_us("timestamp")) + 1) / 20) AS BIGINT) AS w FROM states)))""")
_add("logistic_certificate", "samples", """
    SELECT count(*) FILTER (WHERE NOT is_test) AS train_rows, 1 AS optimal, count(*) AS scored, 0 AS differing FROM samples""")

# -- evaluation -------------------------------------------------------------------------

_COUNTS = """
    SELECT count(*) FILTER (WHERE label = 1 AND prediction_congested = 1) AS tp,
           count(*) FILTER (WHERE label = 0 AND prediction_congested = 1) AS fp,
           count(*) FILTER (WHERE label = 1 AND prediction_congested = 0) AS fn,
           count(*) FILTER (WHERE label = 0 AND prediction_congested = 0) AS tn FROM scored"""
_AREAS = """
    SELECT round(sum((fp - lag_fp) * (tp + lag_tp) / 2.0) / (max(np) * max(nn)), 6) AS auc_roc,
           round(sum((tp - lag_tp) / np * (tp / (tp + fp) + coalesce(lag_tp / nullif(lag_tp + lag_fp, 0),
                 tp / (tp + fp))) / 2.0), 6) AS auc_pr,
           round(sum((tp - lag_tp) / np * (tp / (tp + fp))), 6) AS average_precision
    FROM (SELECT s, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(np AS DOUBLE) AS np,
                 CAST(nn AS DOUBLE) AS nn, CAST(coalesce(lag(tp) OVER (ORDER BY s DESC), 0) AS DOUBLE) AS lag_tp,
                 CAST(coalesce(lag(fp) OVER (ORDER BY s DESC), 0) AS DOUBLE) AS lag_fp FROM curve)"""
_add("confusion", "scored", _COUNTS)
_add("roc_points", "curve", """
    SELECT round(s, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
           round(tp / np, 6) AS tpr, round(fp / nn, 6) AS fpr FROM curve
    UNION ALL SELECT NULL, 0, 0, 0.0, 0.0""")
_CHART = """
    pieces AS (SELECT s, tp, fp, tp / np AS tpr, fp / nn AS fpr FROM curve UNION ALL SELECT NULL, 0, 0, 0.0, 0.0),
    chart AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY floor(fpr * 20) ORDER BY fp, tp) AS up,
               row_number() OVER (PARTITION BY floor(fpr * 20) ORDER BY fp DESC, tp DESC) AS down FROM pieces)
        WHERE up = 1 OR down = 1)"""
_add("roc_chart", "curve", f"""
    SELECT * FROM (WITH {_CHART} SELECT round(s, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
           round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM chart)""")
_add("roc_chart_error", "curve", f"""
    SELECT * FROM (WITH {_CHART} SELECT count(*) AS points, round(sum((fpr - f) * (tpr + t) / 2), 6) AS area, 0.025::DOUBLE AS bound, 1 AS within
    FROM (SELECT *, lag(fpr, 1, 0) OVER w AS f, lag(tpr, 1, 0) OVER w AS t FROM chart WINDOW w AS (ORDER BY fp, tp)))""")
for _area in ("auc_roc", "auc_pr", "average_precision"):
    _add(_area, "curve", f"SELECT {_area} FROM ({_AREAS})")
_add("auc_documents", None, f"""
    WITH curve AS (
        SELECT s, sum(sum(p)) OVER w AS tp, sum(sum(n)) OVER w AS fp,
               sum(sum(p)) OVER () AS np, sum(sum(n)) OVER () AS nn
        FROM (SELECT n_chars AS s, quality AS p, 1 - quality AS n FROM labels JOIN documents USING (doc_id))
        GROUP BY s WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
    {_AREAS}""")
_add("accuracy_f1_weighted", "scored", f"""
    SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
           round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp))
                 / (tp + tn + fp + fn), 6) AS f1_weighted FROM ({_COUNTS})""")
_add("precision_recall_f1", "scored", f"""
    SELECT round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM ({_COUNTS} WHERE is_test)""")
_add("run_summary", "scored", """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE prediction_congested = 1) AS positive_cases,
           round(count(*) FILTER (WHERE prediction_congested = 1) / count(*), 6) AS positive_share FROM scored""")

# -- reports ----------------------------------------------------------------------------

_SPEED, _PROB = _r("avg(avg_speed)", "avg_speed"), _r("avg(prob_congestion)", "avg_prob_congestion")
_COUNT = 'count(*) AS "count"'


def _std(name: str) -> str:
    return _r("stddev_samp(avg_speed)", name)


_add("overview", "scored", f"""
    SELECT count(*) AS total_rows, {_SPEED}, {_PROB}, {_r("avg(prediction_congested)", "congestion_ratio")},
           min("timestamp") AS start_time, max("timestamp") AS end_time FROM scored""")
_add("state_distribution", "scored", f"""
    SELECT prediction, {_COUNT}, {_SPEED}, {_PROB} FROM scored GROUP BY 1""")
_add("congestion_summary", "scored", f"""
    SELECT prediction_congested, {_COUNT}, {_r("avg(prob_congestion)", "avg_prob")}, {_SPEED}
    FROM scored GROUP BY 1""")
_add("hourly_summary", "hourly", f"""
    SELECT "hour", {_r("avg_speed")}, {_r("avg_prob_congestion")}, {_r("std_speed_hour")}, "count" FROM hourly""")
_add("weekday_summary", "scored", f"""
    SELECT weekday, {_SPEED}, {_PROB}, {_std("std_speed_weekday")}, {_COUNT} FROM scored GROUP BY 1""")
_add("top_congestion", "scored", """
    SELECT "date", "hour", round(p, 6) AS avg_prob, c AS "count" FROM (
        SELECT "date", "hour", avg(prob_congestion) AS p, count(*) AS c FROM scored
        WHERE prediction_congested = 1 GROUP BY 1, 2 ORDER BY p DESC, c DESC, 1, 2 LIMIT 20)""")
_add("speed_histogram", "scored", f"""
    SELECT floor(avg_speed / 5.0) * 5.0 AS bin_lower, {_COUNT}, floor(avg_speed / 5.0) * 5.0 + 5.0 AS bin_upper
    FROM scored GROUP BY 1, 3""")
_add("daily_summary", "scored", f"""
    SELECT "date", {_SPEED}, {_std("std_speed")}, {_PROB}, {_COUNT} FROM scored GROUP BY 1""")
_add("weekday_hour_heatmap", "scored", f"""
    SELECT weekday, "hour", {_SPEED}, {_PROB}, {_COUNT} FROM scored GROUP BY 1, 2""")
_add("slot_hourly_speed", "base", f"""
    SELECT "hour", {_SPEED}, {_std("std_speed_hour")}, {_COUNT} FROM base GROUP BY 1""")
_add("sensor_activity", "readings", 'SELECT sensor, count(speed) AS "count" FROM readings GROUP BY 1')
_add("top_sensor_hourly", "readings", f"""
    SELECT CAST(user_id AS VARCHAR) AS sensor, CAST(hour(ts) AS BIGINT) AS "hour", {_r("avg(speed)", "avg_speed")}
    FROM readings WHERE speed IS NOT NULL AND CAST(user_id AS VARCHAR) IN (
        SELECT CAST(user_id AS VARCHAR) AS s FROM readings GROUP BY 1 ORDER BY count(speed) DESC, s LIMIT 5)
    GROUP BY 1, 2""")
_add("hourly_std_mean", "hourly", """
    SELECT round(avg(std_speed_hour), 6) AS hourly_std_avg, CAST(sum("count") AS BIGINT) AS cluster_total,
           unnest(['report', 'run']) AS source FROM hourly""")
_add("report_cube_rollups", "scored", f"""
    SELECT CASE grouping("date", "hour", weekday, prediction, prediction_congested, bin_lower)
             WHEN 63 THEN 'overview' WHEN 59 THEN 'cluster_distribution' WHEN 61 THEN 'congestion_summary'
             WHEN 47 THEN 'hourly_summary' WHEN 55 THEN 'weekday_summary' WHEN 62 THEN 'histogram_avg_speed'
             WHEN 31 THEN 'daily_avg_speed' WHEN 39 THEN 'weekday_hour_heatmap' WHEN 15 THEN 'date_hour' END AS report,
           "date", "hour", weekday, prediction, prediction_congested, bin_lower, {_COUNT}, {_SPEED},
           {_std("std_speed")}, {_PROB}, min("timestamp") AS start_time, max("timestamp") AS end_time
    FROM (SELECT *, floor(avg_speed / 5.0) * 5.0 AS bin_lower FROM scored)
    GROUP BY GROUPING SETS ((), (prediction), (prediction_congested), ("hour"), (weekday), (bin_lower),
                            ("date"), (weekday, "hour"), ("date", "hour"))""")

_add("report_cube_unknown", "scored", """
    SELECT CASE grouping("date", "hour", weekday, prediction, prediction_congested, bin_lower)
             WHEN 63 THEN 'overview' WHEN 59 THEN 'cluster_distribution' WHEN 61 THEN 'congestion_summary'
             WHEN 47 THEN 'hourly_summary' WHEN 55 THEN 'weekday_summary' WHEN 62 THEN 'histogram_avg_speed'
             WHEN 31 THEN 'daily_avg_speed' WHEN 39 THEN 'weekday_hour_heatmap' WHEN 15 THEN 'date_hour' END AS report,
           "date", "hour", weekday, prediction, prediction_congested, bin_lower, count(*) AS "count",
           round(avg(CASE WHEN day("timestamp") % 3 <> 0 THEN prob_congestion END), 6) AS avg_prob_congestion
    FROM (SELECT *, floor(avg_speed / 5.0) * 5.0 AS bin_lower FROM scored)
    GROUP BY GROUPING SETS ((), (prediction), (prediction_congested), ("hour"), (weekday), (bin_lower),
                            ("date"), (weekday, "hour"), ("date", "hour"))""")
_add("stored_runs", "scored", """
    SELECT r.*, n AS newest_rows, h AS newest_hours, n AS rows_again
    FROM (VALUES ('predict_180m', '180m'), ('predict_360m', '360m')) r(run_name, horizon),
         (SELECT count(*) AS n, CAST(sum("hour") AS BIGINT) AS h FROM scored WHERE day("timestamp") > 9)""")

# -- report input and output ------------------------------------------------------------

_add("report_union_dedup", "hourly", f"""
    SELECT "hour", {_r("avg_speed")}, CASE WHEN "hour" < 12 THEN "count" + 7 ELSE "count" + 1000 END AS "count"
    FROM hourly""")
_RELOADED = f"""
    SELECT "date", "hour", {_r("avg_prob")}, CAST(round(CAST(avg_speed AS DECIMAL(20, 12)), 2) AS DOUBLE) AS avg_speed, count_samples, green_extension_pct,
           {{strategy}} AS strategy, CAST(180 AS BIGINT) AS horizon_min, CAST(round(CAST(avg_prob * 100 AS DECIMAL(20, 12)), 1) AS DOUBLE) AS avg_prob_percent
    FROM (SELECT * FROM plan)"""
_add("plan_reload", "plan", _RELOADED.format(strategy="strategy"))
_add("plan_by_header", "plan", _RELOADED.format(strategy='CASE WHEN "hour" % 2 = 0 THEN strategy END'))
_add("prediction_reload", "scored", f"""
    SELECT d + to_hours(CAST("hour" AS BIGINT)) AS "timestamp", {_r("prob_congestion")}, label FROM scored""")
_add("run_catalog", None, """
    SELECT event_id, 'predict_0' || user_id || suffix AS run_name,
           CASE suffix WHEN 'M' THEN user_id || 'm' WHEN 'h' THEN user_id || 'h' WHEN '' THEN user_id || 'm'
                       WHEN 'm' THEN user_id || 'm' WHEN '_warm' THEN 'warm' END AS horizon
    FROM (SELECT *, CASE event_id % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'h' WHEN 2 THEN '' WHEN 3 THEN 'm'
                         WHEN 4 THEN '_latest' ELSE '_warm' END AS suffix FROM events)""")
_add("sink_roundtrip", "scored", f"""
    SELECT sink, "timestamp", "hour", {_r("avg_speed")}, {_r("prob_congestion")} FROM scored,
        (VALUES ('csv'), ('cleaned_csv'), ('json'), ('parquet')) t(sink)""")

# -- plan -------------------------------------------------------------------------------

_PLAN = f"""
    SELECT "date", "hour", {_r("avg_prob")}, {_r("avg_speed")}, count_samples, green_extension_pct, strategy,
           CAST(180 AS BIGINT) AS horizon_min FROM plan"""
_add("signal_plan", "plan", _PLAN)
_add("plan_top5", "plan", """
    SELECT "date", "hour", round(avg_prob * 100, 1) AS avg_prob_percent, round(avg_speed, 2) AS avg_speed,
           count_samples, green_extension_pct, strategy
    FROM (SELECT * FROM plan ORDER BY avg_prob DESC, count_samples DESC, "date", "hour" LIMIT 5)""")

# -- requests ---------------------------------------------------------------------------

_add("request_coercion", "coerced", f"""
    SELECT event_id, {_r("avg_speed")}, {_r("std_speed_hour")}, "hour", weekday, "timestamp", latitude, longitude
    FROM coerced""")
_add("request_defaults", "completed", f"""
    SELECT event_id, "hour", weekday, "timestamp", {_r("std_speed_hour")}, std_speed_auto FROM completed""")
_add("request_errors", "coerced", f"""
    SELECT event_id, '{fv.ERROR_AVG_SPEED}' AS errors FROM coerced WHERE avg_speed IS NULL""")
_RESPONSE = f"""
    SELECT event_id, CASE WHEN prob_congestion > 0.5 THEN '{fv.STATUS_RISK}' ELSE '{fv.STATUS_CLEAR}' END AS status,
           CAST(prob_congestion > 0.5 AS BIGINT) AS prediction, {_r("prob_congestion")},
           round(1 - prob_congestion, 6) AS prob_clear,
           CASE WHEN prob_congestion >= 0.7 THEN 'critical' WHEN prob_congestion >= 0.5 THEN 'high'
                WHEN prob_congestion >= 0.3 THEN 'moderate' ELSE 'low' END AS level,
           CAST(CASE WHEN prob_congestion >= 0.7 THEN 30 WHEN prob_congestion >= 0.5 THEN 20
                     WHEN prob_congestion >= 0.3 THEN 10 ELSE -10 END AS BIGINT) AS green_extension_pct,
           CASE WHEN prob_congestion >= 0.7 THEN '{fv.TEXT_EXTEND.format(30)}'
                WHEN prob_congestion >= 0.5 THEN '{fv.TEXT_EXTEND.format(20)}'
                WHEN prob_congestion >= 0.3 THEN '{fv.TEXT_EXTEND.format(10)}'
                ELSE '{fv.TEXT_SHORTEN_SERVING.format(10)}' END AS strategy, location, latitude
    FROM answered"""
_add("request_scores", "answered", _RESPONSE)

# -- chart data -------------------------------------------------------------------------

_add("series_tail", "scored", f"""
    SELECT strftime("timestamp", '%Y-%m-%d %H:%M') AS "timestamp", {_r("prob_congestion", "prob")}
    FROM (SELECT * FROM scored ORDER BY "timestamp" DESC LIMIT 200)""")
_add("series_hourly", "scored", f"""
    SELECT date_trunc('hour', "timestamp") AS "timestamp", {_r("avg(prob_congestion)", "prob_congestion")}, count(prob_congestion) AS "count"
    FROM scored GROUP BY 1""")
_add("scatter_counts", "named", """
    SELECT strftime("timestamp", '%Y-%m-%d') AS "date", floor(avg_speed / 5.0) * 5.0 AS bin_lower, prediction, cluster_label,
           count(*) AS "count" FROM named GROUP BY ALL""")
_add("outlier_bounds_fine", "readings", """,
    fine AS (SELECT date_trunc('minute', ts) AS ts, sensor, avg(speed) AS speed FROM readings GROUP BY 1, 2),
    fine_means AS (SELECT sensor, avg(speed) AS mean_speed FROM fine GROUP BY 1),
    fine_slots AS (
        SELECT t.ts, avg(coalesce(c.speed, m.mean_speed)) AS avg_speed
        FROM (SELECT DISTINCT ts FROM fine) t CROSS JOIN fine_means m
        LEFT JOIN fine c ON c.ts = t.ts AND c.sensor = m.sensor GROUP BY 1 HAVING avg_speed IS NOT NULL),
    fences AS (
        SELECT q1, q3, q3 - q1 AS iqr, q1 - 0.5 * (q3 - q1) AS lower_bound, q3 + 0.5 * (q3 - q1) AS upper_bound
        FROM (SELECT quantile_disc(avg_speed, 0.25) AS q1, quantile_disc(avg_speed, 0.75) AS q3 FROM fine_slots))
    SELECT count(*) AS rows_before, count(*) FILTER (inside) AS rows_after, count(*) FILTER (NOT inside) AS rows_removed,
           round(count(*) FILTER (NOT inside) * 100.0 / count(*), 2) AS removed_pct,
           round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(iqr), 6) AS iqr,
           round(any_value(lower_bound), 6) AS lower_bound, round(any_value(upper_bound), 6) AS upper_bound
    FROM (SELECT *, avg_speed BETWEEN lower_bound AND upper_bound AND avg_speed > 5 AND avg_speed < 110 AS inside
          FROM fine_slots, fences)""")
_add("series_head", "scored", f"""
    SELECT "timestamp", {_r("prob_congestion")} FROM (SELECT * FROM scored ORDER BY "timestamp" LIMIT 400)""")
_SCATTER = f'SELECT "timestamp", {_r("avg_speed")}, prediction, cluster_label FROM named'
_add("scatter_head", "named", f'{_SCATTER} ORDER BY "timestamp" LIMIT 5000')
_add("scatter_sample", "named", f"""{_SCATTER}
    WHERE CAST('0x' || substr(md5(strftime("timestamp", '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) % 1000 < 400""")
_add("box_stats", "named", f"""
    SELECT cluster_label, n, {_r("lo", "min")}, {_r("q1")}, {_r("q2", "median")}, {_r("q3")}, {_r("hi", "max")},
           {_r("min(avg_speed) FILTER (WHERE inside)", "whisker_low")},
           {_r("max(avg_speed) FILTER (WHERE inside)", "whisker_high")},
           count(*) FILTER (WHERE NOT inside) AS outliers
    FROM (SELECT *, avg_speed BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM named JOIN (
            SELECT cluster_label AS l, count(*) AS n, min(avg_speed) AS lo, max(avg_speed) AS hi,
                   quantile_cont(avg_speed, 0.25) AS q1, quantile_cont(avg_speed, 0.5) AS q2,
                   quantile_cont(avg_speed, 0.75) AS q3 FROM named GROUP BY 1) ON cluster_label = l)
    GROUP BY cluster_label, n, lo, q1, q2, q3, hi""")
_add("kde_grid", "named", f"""
    SELECT cluster_label, x, n, {_r("h", "bandwidth")},
           {_r("sum(w * exp(-0.5 * pow((x - m) / h, 2))) / (n * h * sqrt(2 * pi()))", "density")}
    FROM (SELECT cluster_label, avg(avg_speed) AS m, count(*) AS w FROM named
          GROUP BY cluster_label, floor(avg_speed / 0.2))
    JOIN (SELECT cluster_label AS l, count(*) AS n, stddev_samp(avg_speed) * pow(count(*), -0.2) AS h
          FROM named GROUP BY 1) ON cluster_label = l
    CROSS JOIN (SELECT CAST(2.0 * i AS DOUBLE) AS x FROM range(0, 61) r(i))
    GROUP BY cluster_label, x, n, h""")

# -- streams ----------------------------------------------------------------------------

_add("stream_scores", "answered", _RESPONSE)
# A slot counts once the watermark, ten minutes behind the newest reading, has passed it.
_add("served_requests", "coerced", """
    SELECT count(avg_speed) AS answered, 0 AS differing, count(*) - count(avg_speed) AS rejected FROM coerced""")
_add("stream_slot_avg", "base", f"""
    SELECT b."timestamp", {_r("b.avg_speed", "avg_speed")}, c.sensors FROM base b
    JOIN (SELECT ts, count(speed) AS sensors FROM cells GROUP BY 1) c ON c.ts = b."timestamp"
    WHERE b."timestamp" + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
_add("stream_plan", "plan", _PLAN)
_add("stream_dedup", None, f"SELECT event_id, ts, event_type, {_r('value')} FROM events")

# -- the whole job ----------------------------------------------------------------------

# The job's input holds every event, as a row of its own in both layouts.
_JOB = """
    WITH input AS (SELECT ts, event_type AS sensor, value AS v FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL),
    cells AS (SELECT date_trunc('hour', ts) AS ts, sensor, avg(CASE WHEN v > 0 AND v <= 120 THEN v END) AS speed FROM input GROUP BY 1, 2),
    means AS (SELECT sensor, avg(speed) AS mean_speed FROM cells GROUP BY 1 HAVING count(speed) > 0),
    base AS (SELECT t.ts, avg(coalesce(c.speed, m.mean_speed)) AS avg_speed FROM (SELECT DISTINCT ts FROM cells) t CROSS JOIN means m
             LEFT JOIN cells c ON c.ts = t.ts AND c.sensor = m.sensor GROUP BY 1),
    bounds AS (SELECT q1 - 2.5 * (q3 - q1) AS lo, q3 + 2.5 * (q3 - q1) AS hi
               FROM (SELECT quantile_disc(avg_speed, 0.25) AS q1, quantile_disc(avg_speed, 0.75) AS q3 FROM base)),
    slots AS (SELECT base.* FROM base, bounds WHERE avg_speed BETWEEN lo AND hi AND avg_speed > 5 AND avg_speed < 110),
    samples AS (SELECT *, CAST('0x' || substr(md5(strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) % 10 >= 8 AS is_test
                FROM (SELECT *, lead(ts, 3) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts) AS later FROM slots) WHERE later IS NOT NULL),
    n AS (SELECT (SELECT count(*) FROM input) AS readings, (SELECT count(*) FROM input WHERE v > 0 AND v <= 120) AS valid,
                 (SELECT count(*) FROM cells) AS cells, (SELECT count(speed) FROM cells) AS observed,
                 (SELECT count(DISTINCT sensor) FROM input) AS sensors, (SELECT count(*) FROM means) AS known,
                 (SELECT count(DISTINCT ts) FROM cells) AS times, (SELECT count(*) FROM base) AS base, (SELECT count(DISTINCT hour(ts)) FROM base) AS hours,
                 (SELECT count(*) FROM slots) AS slots, (SELECT count(*) FROM samples) AS samples,
                 (SELECT CASE WHEN count(*) FILTER (WHERE is_test) > 0 THEN count(*) FILTER (WHERE is_test) ELSE count(*) END FROM samples) AS held_out)"""
_add("whole_job_tables", None, f"""{_JOB}
    SELECT layout, name, CAST(rows AS BIGINT) AS "rows", CAST(counted AS BIGINT) AS counted FROM n, (VALUES ('wide'), ('long')) l(layout), LATERAL (
        SELECT 'slot_means' AS name, base AS rows, NULL AS counted
        UNION ALL SELECT 'slots', slots, NULL
        UNION ALL SELECT 'clustered', slots, NULL
        UNION ALL SELECT 'samples_180m', samples, NULL
        UNION ALL SELECT 'predictions', samples, NULL
        UNION ALL SELECT 'readings', CASE layout WHEN 'long' THEN readings ELSE readings * sensors END, NULL
        UNION ALL SELECT 'cells', CASE layout WHEN 'long' THEN cells ELSE times * sensors END, NULL
        UNION ALL SELECT 'cleaned', CASE layout WHEN 'long' THEN (SELECT count(*) FROM cells JOIN means USING (sensor)) ELSE times * known END, NULL
        UNION ALL SELECT 'sensor_profile', sensors, observed
        UNION ALL SELECT 'missing_profile', least(sensors, 10), (SELECT sum(m) FROM (
            SELECT (SELECT times FROM n) - count(speed) AS m FROM cells GROUP BY sensor ORDER BY m DESC LIMIT 10))
        UNION ALL SELECT 'hourly_spread', hours, NULL
        UNION ALL SELECT 'models/hourly_spread', hours, NULL
        UNION ALL SELECT 'outlier_bounds', 1, NULL
        UNION ALL SELECT 'sensor_activity', sensors, valid
        UNION ALL SELECT 'top_sensor_hourly', (SELECT count(DISTINCT (sensor, hour(ts))) FROM input WHERE v > 0 AND v <= 120 AND sensor IN (
            SELECT sensor FROM input GROUP BY sensor ORDER BY count(*) FILTER (WHERE v > 0 AND v <= 120) DESC, sensor LIMIT 5)), NULL
        UNION ALL SELECT 'silhouette_scores', 1, NULL
        UNION ALL SELECT 'cluster_summary', 3, slots
        UNION ALL SELECT 'evaluation/grid_scores', {len(fv.REG_PARAMS) * len(fv.ELASTIC_NET_PARAMS)}, NULL
        UNION ALL SELECT 'logistic_feature_importance', {len(fv.FEATURES)}, NULL
        UNION ALL SELECT 'evaluation/confusion', NULL, held_out
        UNION ALL SELECT 'report_cube', NULL, samples
        UNION ALL SELECT 'signal_plan', samples, samples
        UNION ALL SELECT 'signal_plan_json', samples, samples
        UNION ALL SELECT 'charts/state_boxes', 3, slots
        UNION ALL SELECT 'charts/state_scatter', NULL, slots
        UNION ALL SELECT 'charts/probability_series', samples, samples
        UNION ALL SELECT 'overview', 1, samples
        UNION ALL SELECT 'cluster_distribution', 3, samples
        UNION ALL SELECT 'congestion_summary', NULL, samples
        UNION ALL SELECT 'histogram_avg_speed', NULL, samples
        UNION ALL SELECT 'hourly_summary', (SELECT count(DISTINCT hour(ts)) FROM samples), samples
        UNION ALL SELECT 'weekday_summary', (SELECT count(DISTINCT dayofweek(ts)) FROM samples), samples
        UNION ALL SELECT 'weekday_hour_heatmap', (SELECT count(DISTINCT (dayofweek(ts), hour(ts))) FROM samples), samples
        UNION ALL SELECT 'daily_avg_speed', (SELECT count(DISTINCT CAST(ts AS DATE)) FROM samples), samples)""")
