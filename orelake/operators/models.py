"""Training, storing and applying Spark ML models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.session import ensure_checkpoint_dir


def _pipeline(inputs: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="features"), estimator])


def ready(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Model inputs as doubles; missing scaled values stand at the centre."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs})


def train_ticket_classifier(
    train: DataFrame, inputs: Sequence[str], kind: str = "rf", label: str = "PRIORITY_ENCODED", seed: int = 42, **settings
) -> PipelineModel:
    """Random forest (``rf``) or multinomial logistic regression (``lr``)."""
    if kind == "rf":
        # Nodes of fewer than five rows are not split; the closest setting here
        # is a lower bound on the rows of a leaf.
        defaults = dict(numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=seed)
        est = RandomForestClassifier(labelCol=label, predictionCol="PREDICTED", **{**defaults, **settings})
    else:
        defaults = dict(maxIter=1000, family="multinomial", regParam=1.0 / max(train.count(), 1))
        est = LogisticRegression(labelCol=label, predictionCol="PREDICTED", **{**defaults, **settings})
    return _pipeline(inputs, est).fit(ready(train, inputs))


def train_revenue_model(
    train: DataFrame, inputs: Sequence[str], kind: str = "gbt", label: str = "MONTHLY_REVENUE", seed: int = 42, **settings
) -> PipelineModel:
    """Gradient-boosted trees (``gbt``) or ordinary least squares (``linear``)."""
    rows = ready(train, inputs).withColumn(label, F.col(label).cast("double"))
    if kind == "gbt":
        # Boosting is one long lineage; checkpoints in the shared folder cut it.
        ensure_checkpoint_dir(train.sparkSession)
        defaults = dict(
            maxIter=200, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed, checkpointInterval=10
        )
        est = GBTRegressor(labelCol=label, predictionCol="PREDICTED", **{**defaults, **settings})
    else:
        est = LinearRegression(labelCol=label, predictionCol="PREDICTED", **{"solver": "normal", **settings})
    return _pipeline(inputs, est).fit(rows)


def predict(model: PipelineModel, df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    return model.transform(ready(df, inputs)).drop("features", "rawPrediction", "probability")


def feature_importance(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """FEATURE and IMPORTANCE, largest first (tree models)."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return spark.createDataFrame(rows, "FEATURE string, IMPORTANCE double").orderBy(F.col("IMPORTANCE").desc(), "FEATURE")


def save_model(
    spark: SparkSession,
    model: PipelineModel,
    root: str,
    name: str,
    version: str,
    metrics: Mapping[str, object] | None = None,
    default: bool = True,
) -> None:
    """Store a version with its metrics; ``default`` makes it the one loaded by name."""
    model.write().overwrite().save(f"{root}/{name}/model/{version}")
    rows = [(name, version, k, str(v)) for k, v in (metrics or {}).items()]
    spark.createDataFrame(rows, "MODEL_NAME string, MODEL_VERSION string, METRIC string, VALUE string").write.mode(
        "overwrite"
    ).parquet(f"{root}/{name}/metrics/{version}")
    if default:
        spark.createDataFrame([(version,)], "version string").write.mode("overwrite").parquet(f"{root}/{name}/default")


def default_version(spark: SparkSession, root: str, name: str) -> str:
    return spark.read.parquet(f"{root}/{name}/default").first()[0]


def load_model(spark: SparkSession, root: str, name: str, version: str | None = None) -> PipelineModel:
    return PipelineModel.load(f"{root}/{name}/model/{version or default_version(spark, root, name)}")


def model_metrics(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}/metrics/{version or default_version(spark, root, name)}")


def score_view(model: PipelineModel, df: DataFrame, inputs: Sequence[str], view: str) -> DataFrame:
    """Predictions registered as a view, for use from SQL."""
    scored = predict(model, df, inputs)
    scored.createOrReplaceTempView(view)
    return scored
