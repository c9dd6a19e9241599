"""Road states: clustering of slots, naming by speed."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from speedloom import fixed_values as fv
from speedloom.operators.cleaning import finite_speeds


@dataclass
class StateModel:
    """Fitted states with the score of every k that was tried."""

    model: PipelineModel
    k: int
    scores: DataFrame


def assembler(columns: tuple[str, ...] = fv.FEATURES, out: str = "features",
              invalid: str = "skip") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid)


def kmeans(k: int, features: str = "features") -> KMeans:
    return KMeans(k=k, seed=fv.SEED, featuresCol=features, predictionCol="prediction",
                  maxIter=fv.KMEANS_ITERATIONS, tol=fv.KMEANS_TOLERANCE, initMode="k-means||",
                  initSteps=fv.KMEANS_INIT_STEPS)


def fit_states(slots: DataFrame, kmin: int = 2, kmax: int = 6,
               columns: tuple[str, ...] = fv.FEATURES, standardize: bool = False,
               parallelism: int = 4) -> StateModel | None:
    """Fit k-means for each k and keep the best silhouette; None without usable rows."""
    usable = finite_speeds(slots)
    stages = [assembler(columns, "features_raw" if standardize else "features")]
    if standardize:
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features",
                                     withMean=True, withStd=True).fit(stages[0].transform(usable)))
    prepare = PipelineModel(stages=stages)
    # Every k iterates over the same vectors. The blocks may spill, and can be rebuilt
    # from the input when an executor is lost.
    data = prepare.transform(usable).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.isEmpty():
            return None
        evaluator = ClusteringEvaluator(featuresCol="features", metricName="silhouette",
                                        distanceMeasure="squaredEuclidean")

        def try_k(k: int) -> tuple[int, float, KMeansModel]:
            fitted = kmeans(k).fit(data)
            # The silhouette needs at least two groups that hold rows.
            several = sum(size > 0 for size in fitted.summary.clusterSizes) > 1
            return k, float(evaluator.evaluate(fitted.transform(data))) if several else -1.0, fitted

        # The fits do not depend on each other: their jobs share the executors.
        with ThreadPool(min(parallelism, kmax - kmin + 1)) as pool:
            tried = pool.map(inheritable_thread_target(slots.sparkSession)(try_k),
                             range(kmin, kmax + 1))
    finally:
        data.unpersist()
    k, _, best = max(tried, key=lambda t: (t[1], -t[0]))
    scores = slots.sparkSession.createDataFrame(
        [(k, score) for k, score, _ in tried], "k long, silhouette double")
    return StateModel(PipelineModel(stages=[*stages, best]), k, scores)


def assign_states(slots: DataFrame, states: StateModel) -> DataFrame:
    return states.model.transform(finite_speeds(slots)).drop("features", "features_raw")


def band_states(slots: DataFrame, cuts: tuple[float, ...]) -> DataFrame:
    """States from fixed speed limits: 0 below the first cut, then 1, 2, ..."""
    state = F.lit(0)
    for cut in cuts:
        state = state + F.when(F.col("avg_speed") >= cut, 1).otherwise(0)
    return slots.withColumn("prediction", state)


def state_summary(slots: DataFrame) -> DataFrame:
    """Mean speed, rows, rank by speed and name of every state."""
    per_state = slots.groupBy("prediction").agg(
        F.avg("avg_speed").alias("avg_speed_mean"), F.count("*").alias("row_count"))
    # One row per state; k is a model parameter, so these windows stay tiny.
    everything = Window.partitionBy(F.lit(0))
    ranked = per_state.select(
        "*",
        F.row_number().over(everything.orderBy("avg_speed_mean", "prediction")).alias("rank_by_speed"),
        F.count("*").over(everything).alias("_states"),
    )
    name = (
        F.when(F.col("rank_by_speed") == 1, fv.STATE_CONGESTED)
        .when(F.col("rank_by_speed") == F.col("_states"), fv.STATE_FREE)
        .otherwise(fv.STATE_NORMAL)
    )
    return ranked.withColumn("cluster_label", name).drop("_states").orderBy("prediction")


def label_states(slots: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Add ``cluster_label`` to every slot."""
    names = (summary if summary is not None else state_summary(slots)).select("prediction", "cluster_label")
    # k rows: bounded by the model's parameter.
    return slots.join(F.broadcast(names), "prediction", "left")


def congested_state(slots: DataFrame) -> DataFrame:
    """One row: the state with the lowest mean speed, lowest id on equal means."""
    per_state = slots.groupBy("prediction").agg(F.avg("avg_speed").alias("mean_v"))
    return per_state.agg(
        F.min_by("prediction", F.struct("mean_v", "prediction")).alias("congested"))
