import datetime as dt
import math
import random

import pytest
from conftest import values
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.operators import horizon, silhouettes, states

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def slots(spark):
    rng = random.Random(11)
    data = []
    for i in range(600):
        t = T0 + dt.timedelta(minutes=15 * i)
        busy = t.hour in (7, 8, 16, 17)
        data.append((t, rng.gauss(25 if busy else 60, 4), t.hour, t.isoweekday() % 7 + 1, 3.0 if busy else 5.0))
    return spark.createDataFrame(
        data, "timestamp timestamp, avg_speed double, hour int, weekday int, std_speed_hour double")


def test_silhouette_equals_mllib(spark, sf_dir):
    points = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    own = silhouettes.silhouette(points, "embedding", "label").first()[0]
    vectors = points.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                            F.col("label").cast("double").alias("prediction"))
    assert own == pytest.approx(ClusteringEvaluator().evaluate(vectors), abs=1e-12)


def test_silhouette_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], 0), ([0.0, 1.0], 0), ([5.0, 5.0], 1), ([9.0, 9.0], None)],
                               "x array<double>, c int")
    rows = {tuple(r.x): r.silhouette for r in silhouettes.silhouette_values(df, "x", "c").collect()}
    assert len(rows) == 3 and rows[5.0, 5.0] == 0.0 and rows[0.0, 0.0] == pytest.approx((50 - 1) / 50)
    same = df.where("c = 0")
    assert silhouettes.silhouette(same, "x", "c").first()[0] is None


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_silhouette_of_many_groups(spark, spread):
    """Against every group, with groups of one point, equal points and (spread 0) centres of the same norm."""
    rng = random.Random(8)
    points = []
    for g in range(60):
        angle, far = rng.random() * 6.28, 10 + spread * g
        for _ in range(rng.choice([1, 2, 5])):
            points.append(([far * math.cos(angle) + rng.gauss(0, 0.5), far * math.sin(angle) + rng.gauss(0, 0.5)], g))
    points += [(points[0][0], 7), (points[0][0], points[0][1])]
    df = spark.createDataFrame([(i, x, g) for i, (x, g) in enumerate(points)], "i int, x array<double>, g int")
    groups = {}
    for x, g in points:
        groups.setdefault(g, []).append(x)
    d = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    want = {}
    for i, (x, g) in enumerate(points):
        mean = {h: sum(d(x, y) for y in ys) / len(ys) for h, ys in groups.items()}
        n = len(groups[g])
        a, b = mean[g] * n / max(n - 1, 1), min(v for h, v in mean.items() if h != g)
        want[i] = 0.0 if n == 1 else (b - a) / max(a, b)
    got = {r.i: r.silhouette for r in silhouettes.silhouette_values(df, "x", "g", block_groups=4).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_kmeans_invariants(slots):
    fitted = states.fit_states(slots, 2, 4)
    assert [r.k for r in fitted.scores.orderBy("k").collect()] == [2, 3, 4]
    best = fitted.scores.orderBy(F.desc("silhouette"), "k").first()
    assert best.k == fitted.k
    out = states.assign_states(slots, fitted)
    assert out.count() == 600 and out.select("prediction").distinct().count() == fitted.k
    centres = fitted.model.stages[-1].clusterCenters()
    for r in out.limit(200).collect():
        d = [sum((a - b) ** 2 for a, b in zip((r.avg_speed, r.hour, r.weekday, r.std_speed_hour), c))
             for c in centres]
        assert d[r.prediction] == pytest.approx(min(d))


def test_standardized_states_and_no_rows(slots):
    fitted = states.fit_states(slots, 2, 2, standardize=True)
    labelled = states.label_states(states.assign_states(slots, fitted))
    slow = labelled.groupBy("cluster_label").agg(F.avg("avg_speed")).collect()
    assert dict(map(tuple, slow))[fv.STATE_CONGESTED] < 40
    assert states.fit_states(slots.where("avg_speed < 0"), 2, 3) is None


def test_summary_ranks_and_ties(spark):
    df = spark.createDataFrame([(2, 30.0), (2, 32.0), (0, 31.0), (1, 60.0), (1, 60.0)],
                               "prediction int, avg_speed double")
    got = values(states.state_summary(df))
    assert got == [(0, 31.0, 1, 1, fv.STATE_CONGESTED), (1, 60.0, 2, 3, fv.STATE_FREE),
                   (2, 31.0, 2, 2, fv.STATE_NORMAL)]
    assert states.congested_state(df).first().congested == 0


def _day(spark, minutes, state=lambda i: i % 2):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(minutes=m), state(i), 50.0, 1, 1, 1.0) for i, m in enumerate(minutes)],
        "timestamp timestamp, prediction int, avg_speed double, hour int, weekday int, std_speed_hour double")


def test_row_labels_stop_at_midnight(spark):
    slots = _day(spark, range(0, 2 * 1440, 60))
    congested = spark.createDataFrame([(1,)], "congested int")
    rows = horizon.label_by_rows(slots, congested, 3)
    assert rows.count() == 48 - 2 * 3
    assert rows.where("label != (prediction + 1) % 2").count() == 0
    assert horizon.label_by_time(slots, congested.first(), 180).count() == 48 - 3


def test_labels_over_a_gap(spark):
    slots = _day(spark, [0, 60, 180, 240], state=lambda i: i)
    congested = spark.createDataFrame([(3,)], "congested int").first()
    by_rows = values(horizon.label_by_rows(slots, congested, 1), "prediction", "prediction_next", "label")
    by_time = values(horizon.label_by_time(slots, congested, 60), "prediction", "prediction_next", "label")
    assert sorted(by_rows) == [(0, 1, 0), (1, 2, 0), (2, 3, 1)]
    assert sorted(by_time) == [(0, 1, 0), (2, 3, 1)]


def test_lead_steps():
    assert [horizon.lead_steps(*a) for a in ((15, 5), (5, 15), (60, 0), (0, 5))] == [3, 1, 60, 1]


def test_split_is_stable_and_close_to_its_share(spark):
    slots = _day(spark, range(0, 1440 * 30, 5))
    flagged = horizon.with_test_flag(slots)
    again = horizon.with_test_flag(slots.repartition(5))
    assert sorted(values(flagged, "timestamp", "is_test")) == sorted(values(again, "timestamp", "is_test"))
    assert flagged.where("is_test").count() / flagged.count() == pytest.approx(0.2, abs=0.02)


@pytest.mark.parametrize("horizon_min, blocks", [(15, 10), (600, 30), (0, 7)])
def test_purged_split_keeps_the_sides_apart(spark, horizon_min, blocks):
    slots = _day(spark, range(0, 1440 * 10, 30))
    rows = horizon.with_purged_split(slots, horizon_min, blocks).select("timestamp", "is_test").collect()
    sides = {k: sorted(r.timestamp for r in rows if r.is_test is k) for k in (True, False, None)}
    near = dt.timedelta(minutes=horizon_min)
    assert all(sides[k] for k in (True, False))
    closest = lambda t: min(abs(t - u) for u in sides[True])
    assert all(closest(t) > near for t in sides[False]) and all(closest(t) <= near + dt.timedelta(minutes=30) for t in sides[None])
    assert len(sides[True]) / len(rows) == pytest.approx(sum(b % 5 == 4 for b in range(blocks)) / blocks, abs=0.02)


def test_class_weights_use_train_counts(spark):
    df = spark.createDataFrame([(1, False)] + [(0, False)] * 3 + [(1, True)] * 5, "label int, is_test boolean")
    weights = set(values(horizon.with_class_weight(df), "label", "weight"))
    assert weights == {(1, 3.0), (0, 1.0)}
    whole = horizon.class_balance(df).first()
    assert whole.asDict() == {"samples": 9, "n_pos": 6, "n_neg": 3, "pos_weight": 0.5,
                              "train_rows": 4, "test_rows": 5}
    assert set(values(horizon.with_class_weight(df, whole), "weight")) == {(0.5,), (1.0,)}
