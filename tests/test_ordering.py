import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from speedloom.operators.ordering import bucket_edges, exact_quantiles, running_totals

PROBS = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "q10": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    # A third of all rows share one value and one group.
    data = [("a", 50.0)] * 1000 + [(rng.choice("abc"), round(rng.gauss(40, 20), 1)) for _ in range(2000)]
    data += [("d", 1.5), (None, 2.0), (None, 4.0), ("a", None), ("b", float("nan")), ("b", float("inf"))]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, v double").repartition(6)


def grouped(rows):
    out = {}
    for g, v in ((r.g, r.v) for r in rows.collect()):
        if v is not None and np.isfinite(v):
            out.setdefault(g, []).append(v)
    return out


@pytest.mark.parametrize("interpolate, method", [(False, "inverted_cdf"), (True, "linear")])
def test_quantiles_match_numpy(rows, interpolate, method):
    got = {r.g: r for r in exact_quantiles(rows, "v", PROBS, ("g",), interpolate).collect()}
    want = grouped(rows)
    assert got.keys() == want.keys()
    for g, vs in want.items():
        assert got[g].n == len(vs)
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p, method=method), abs=1e-9), (g, name)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    row = exact_quantiles(empty, "v", {"q": 0.5}).first()
    assert row.n is None and row.q is None


@pytest.mark.parametrize("buckets", [1, 2, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_any_bucket_count(rows, buckets, descending):
    counts = rows.where("v is not null and not isnan(v) and v < 1e9").groupBy("g", "v").agg(
        F.count("*").alias("n"))
    edges = bucket_edges(counts, "v", buckets)
    got = running_totals(counts, "v", {"n": "upto"}, edges, ("g",), {"n": "all"}, descending)
    want = {}
    for g, vs in grouped(rows).items():
        for v in set(vs):
            want[g, v] = (sum(w >= v for w in vs) if descending else sum(w <= v for w in vs), len(vs))
    assert {(r.g, r.v): (r.upto, r["all"]) for r in got.collect()} == want
