"""Training of the congestion model with MLlib."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from speedloom import fixed_values as fv
from speedloom.functions.probability import positive_probability
from speedloom.operators.horizon import class_balance, split_bucket, time_key, train_rows
from speedloom.operators.states import assembler


@dataclass
class Training:
    """Outcome of a training run; ``model`` is None when ``reason`` says why not."""

    model: PipelineModel | None
    reason: str | None
    balance: dict
    grid_scores: list[tuple[dict, float]]

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(fv.FEATURES, map(float, self.model.stages[-1].coefficients)))


def guard_reason(balance: dict) -> str | None:
    """Why these samples cannot train a model, or None."""
    if not balance["samples"]:
        return "no labelled samples"
    if not balance["n_pos"] or not balance["n_neg"]:
        return "only one class"
    if balance["train_rows"] < fv.MIN_TRAIN or balance["test_rows"] < fv.MIN_TEST:
        return "too few train or test rows"
    return None


def train(samples: DataFrame, parallelism: int = 8) -> Training:
    """Grid search by cross-validation on the train rows of ``samples``.

    ``samples`` has the features, ``label``, ``weight`` and ``is_test``. Vectors are
    assembled and scaled once; the grid only refits the regression, several at a time.
    """
    balance = class_balance(samples).first().asDict()
    reason = guard_reason(balance)
    if reason is None:
        train_balance = class_balance(train_rows(samples).drop("is_test")).first()
        if not train_balance["n_pos"] or not train_balance["n_neg"]:
            reason = "only one class in the train rows"
    if reason:
        return Training(None, reason, balance, [])

    # Another digest than the test split uses, so folds and split do not line up.
    fold = split_bucket(F.concat(F.lit("fold|"), time_key(F.col("timestamp"))), fv.FOLDS).cast("int")
    rows = train_rows(samples).withColumn("fold", fold)
    assemble = assembler(fv.FEATURES, "features_raw", invalid="error")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features",
                            withMean=True, withStd=True).fit(assemble.transform(rows))
    data = (
        PipelineModel(stages=[assemble, scaler]).transform(rows)
        .select("features", "label", "weight", "fold")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    lr = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=fv.MODEL_ITERATIONS,
        family="binomial", predictionCol="prediction_lr", probabilityCol="probability_lr")
    grid = (ParamGridBuilder()
            .addGrid(lr.regParam, list(fv.REG_PARAMS))
            .addGrid(lr.elasticNetParam, list(fv.ELASTIC_NET_PARAMS)).build())
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderPR")
    try:
        fitted = CrossValidator(
            estimator=lr, estimatorParamMaps=grid, evaluator=evaluator, numFolds=fv.FOLDS,
            seed=fv.SEED, parallelism=parallelism, foldCol="fold").fit(data)
    finally:
        data.unpersist()
    scores = [({p.name: v for p, v in point.items()}, float(m))
              for point, m in zip(grid, fitted.avgMetrics)]
    return Training(PipelineModel(stages=[assemble, scaler, fitted.bestModel]), None, balance, scores)


def one_class_model(samples: DataFrame) -> PipelineModel:
    """The model of train rows that are all of one class, where ``train`` has nothing to search.

    Their likelihood grows with the intercept without end. The fit is that limit: no coefficients, and a
    probability of the class that is 1 for every row. The one class needs no weight.
    """
    rows = train_rows(samples)
    prepare = PipelineModel(stages=[assembler(fv.FEATURES, "features_raw", invalid="error")])
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True).fit(
        prepare.transform(rows))
    prepare = PipelineModel(stages=[*prepare.stages, scaler])
    lr = LogisticRegression(featuresCol="features", labelCol="label", family="binomial",
                            predictionCol="prediction_lr", probabilityCol="probability_lr")
    fitted = lr.fit(prepare.transform(rows))
    if any(map(float, fitted.coefficients)) or abs(float(fitted.intercept)) != float("inf"):
        raise ValueError("the train rows are of two classes")
    return PipelineModel(stages=[*prepare.stages, fitted])


def model_of(samples: DataFrame) -> PipelineModel:
    """The model that ``train`` finds, or that of the one class; samples that give neither are an error."""
    trained = train(samples)
    if trained.model is None:
        if not trained.reason.startswith("only one class"):
            raise ValueError(f"no model: {trained.reason}")
        return one_class_model(samples)
    return trained.model


def score(samples: DataFrame, model: PipelineModel) -> DataFrame:
    """Model output with ``prob_congestion`` as a plain double beside the vector."""
    out = model.transform(samples)
    return (
        out.withColumn("prob_congestion", positive_probability(out, "probability_lr"))
        .withColumnsRenamed({"prediction_lr": "prediction_congested", "probability_lr": "probability"})
        .drop("features_raw", "features", "rawPrediction")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_version(spark: SparkSession, path: str) -> str:
    """When the model was saved, from its own metadata (ISO text)."""
    saved = F.timestamp_millis(F.col("timestamp"))
    return spark.read.schema("timestamp long").json(f"{path}/metadata").select(
        F.date_format(saved, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
