"""Every query of the library against its SQL, or for shape where there is none."""

import __spark_entry__ as entry
import compare
import pytest

from speedloom.catalog.oracle import ORACLES
from speedloom.catalog.queries import QUERIES

CON = {}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    con = CON.setdefault("con", compare.connect(sf_dir))
    status, _, note = compare.compare(spark, con, name, sf_dir)
    assert status in ("ok", "rows"), note


def test_entry_and_registration(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "avg_speed", "avg_prob_congestion", "std_speed_hour", "count"]
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"kmeans_states", "k_sweep", "train_logistic"}
