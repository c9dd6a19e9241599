"""The whole job takes every event, not one of an hour, and tells what all its tables hold."""

import compare
import duckdb

from speedloom.catalog.queries import QUERIES


def test_every_event_takes_part(spark, tmp_path):
    # Several events of a type in each hour, two of them at one time; invalid speeds are the greatest of their hours.
    duckdb.sql(f"""
        COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:00.25' + to_minutes(CAST(5 * (i // 2) AS BIGINT)) AS ts, i % 7 AS user_id,
                     CASE WHEN i = 9 THEN NULL WHEN i % 4 < 2 THEN 'click' ELSE 'view' END AS event_type,
                     CASE WHEN i % 13 = 0 THEN 130.5 ELSE 20 + (i * 37) % 61 + ((i // 24) % 24) * 0.5 END AS value, '' AS props
              FROM range(4800) t(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    told = {(r.layout, r.name): (r["rows"], r.counted) for r in QUERIES["whole_job_tables"](spark, str(tmp_path)).collect()}
    valid = duckdb.sql(f"SELECT count(*) FROM '{tmp_path}/events.parquet' WHERE event_type IS NOT NULL AND value <= 120").fetchall()[0][0]
    assert told["long", "readings"] == (4799, None) and told["wide", "readings"] == (2 * 4799, None)
    for layout in ("wide", "long"):
        assert told[layout, "sensor_activity"] == (2, valid)
        assert told[layout, "cells"] == (400, None) and told[layout, "cluster_summary"][0] == 3
    want = compare.connect(str(tmp_path)).execute(compare.entry.oracle_sql()["whole_job_tables"]).fetchall()
    assert told == {row[:2]: row[2:] for row in want}
