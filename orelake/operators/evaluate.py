"""Model quality as aggregates over a prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pred: DataFrame, y: str, yhat: str, classes=None) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return pred.groupBy(F.col(y).alias("TRUE_CLASS")).pivot(yhat, classes).count().na.fill(0)


def _class_counts(pred: DataFrame, y: str, yhat: str) -> DataFrame:
    """Support, predicted count and hits per class, from the (y, yhat) counts."""
    cells = pred.groupBy(F.col(y).alias("y"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("q")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("q")),
    )
    return (
        cells.select(F.inline(sides), (F.col("y") == F.col("p")).alias("hit"))
        .groupBy("c")
        .agg(F.sum("s").alias("support"), F.sum("q").alias("predicted"), F.sum(F.when(F.col("hit"), F.col("s")).otherwise(0)).alias("hits"))
    )


def classification_metrics(pred: DataFrame, y: str, yhat: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row."""
    c = _class_counts(pred, y, yhat).select(
        "support",
        "hits",
        F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)).alias("prec"),
        F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)).alias("rec"),
    )
    both = F.col("prec") + F.col("rec")
    f1 = F.when(both > 0, 2 * F.col("prec") * F.col("rec") / both).otherwise(0.0)
    total = F.sum("support")

    def weighted(v):
        return F.sum(v * F.col("support")) / total

    return c.agg(
        (F.sum("hits") / total).alias("ACCURACY"),
        weighted(F.col("prec")).alias("PRECISION_WEIGHTED"),
        weighted(F.col("rec")).alias("RECALL_WEIGHTED"),
        weighted(f1).alias("F1_WEIGHTED"),
        total.alias("TEST_ROWS"),
    )


def regression_metrics(pred: DataFrame, y: str, yhat: str) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE (percent; zero targets do not enter MAPE), one row."""
    t, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    err = t - p
    mse = F.avg(err * err)
    return pred.agg(
        F.avg(F.abs(err)).alias("MAE"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
        (1 - F.try_divide(F.sum(err * err), F.var_pop(t) * F.count(t))).alias("R2"),
        F.avg(F.when(t != 0, F.abs(err) / t * 100)).alias("MAPE"),
        F.count(F.lit(1)).alias("TEST_ROWS"),
    )


def prediction_table(pred: DataFrame, model: str, version: str, keep, predicted: str, out: str, target: str | None = None) -> DataFrame:
    """Predictions with model name and version; with a numeric ``target`` also
    the residual and the percentage error."""
    extra = []
    if target is not None:
        t, p = F.col(target).cast("double"), F.col(predicted)
        extra = [
            (t - p).alias("RESIDUAL"),
            F.round(F.when(t != 0, F.abs(t - p) / t * 100), 2).alias("PCT_ERROR"),
        ]
    return pred.select(
        *keep, F.col(predicted).alias(out), *extra, F.lit(model).alias("MODEL_NAME"), F.lit(version).alias("MODEL_VERSION")
    )


def residual_summary(pred: DataFrame, by: str | None = None) -> DataFrame:
    if by is not None:
        return (
            pred.groupBy(by)
            .agg(F.avg("PCT_ERROR").alias("AVG_PCT_ERROR"), F.avg("RESIDUAL").alias("AVG_RESIDUAL"), F.count(F.lit(1)).alias("COUNT"))
            .orderBy(by)
        )
    return pred.agg(
        F.avg("RESIDUAL").alias("MEAN_RESIDUAL"),
        F.stddev_samp("RESIDUAL").alias("STD_RESIDUAL"),
        F.min("RESIDUAL").alias("MIN_RESIDUAL"),
        F.max("RESIDUAL").alias("MAX_RESIDUAL"),
        F.avg("PCT_ERROR").alias("AVG_PCT_ERROR"),
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("COUNT")).orderBy(label)


def compare_models(metrics: dict[str, DataFrame], by: str) -> DataFrame:
    """All metric rows with the model name and whether it is the best by ``by``
    (the first one named wins a tie)."""
    rows = None
    for i, (name, m) in enumerate(metrics.items()):
        row = m.select(F.lit(name).alias("MODEL"), F.lit(i).alias("_order"), "*")
        rows = row if rows is None else rows.unionByName(row)
    best = rows.agg(F.max_by("MODEL", F.struct(F.col(by), -F.col("_order")))).scalar()
    return rows.withColumn("IS_BEST", F.col("MODEL") == best).drop("_order")


def describe(df: DataFrame, columns) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column, in one pass."""
    stats = {"COUNT": F.count, "MEAN": F.avg, "STDDEV": F.stddev_samp, "MIN": F.min, "MAX": F.max}
    rows = [
        F.struct(F.lit(c).alias("COLUMN"), *[fn(F.col(c).cast("double")).alias(n) for n, fn in stats.items()])
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
