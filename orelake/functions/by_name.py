"""Functions that SQL calls by name: sentiment and the scoring of linear models.

Both are SQL functions with an expression for a body, so Spark inlines and compiles
them like any other expression; no Python runs for a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from orelake.vocab import (
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    SENTIMENT_FULL_CONFIDENCE_HITS,
    SENTIMENT_LABEL_CUT,
    SENTIMENT_NO_HIT_CONFIDENCE,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(words: Sequence[str]) -> str:
    return " + ".join(f"CAST(contains(lower(body), {_quoted(w)}) AS INT)" for w in words)


def create_sentiment(
    spark: SparkSession,
    name: str = "sentiment_of",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> None:
    """Make ``name(text)`` callable: a struct of score, label and confidence."""
    up, down = _found(positive), _found(negative)
    hits = f"({up} + {down})"
    score = f"CASE WHEN body IS NULL OR body = '' OR {hits} = 0 THEN 0.0D ELSE bround(({up} - ({down})) / {hits}, 2) END"
    confidence = (
        f"CASE WHEN body IS NULL OR body = '' THEN 0.0D WHEN {hits} = 0 THEN {SENTIMENT_NO_HIT_CONFIDENCE}D "
        f"ELSE least(round({hits} / {SENTIMENT_FULL_CONFIDENCE_HITS}, 2), 1.0D) END"
    )
    label = (
        f"CASE WHEN {score} > {SENTIMENT_LABEL_CUT}D THEN 'positive' WHEN {score} < -{SENTIMENT_LABEL_CUT}D THEN 'negative' "
        "ELSE 'neutral' END"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING) "
        f"RETURNS STRUCT<score: DOUBLE, label: STRING, confidence: DOUBLE> "
        f"RETURN named_struct('score', {score}, 'label', {label}, 'confidence', {confidence})"
    )


def linear_coefficients(spark: SparkSession, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """(PLACE, FEATURE, COEFFICIENT) of a linear model, the intercept at place 0 without a feature."""
    fit = model.stages[-1]
    rows = [(0, None, float(fit.intercept))]
    rows += [(i, n, float(c)) for i, (n, c) in enumerate(zip(inputs, fit.coefficients.toArray()), 1)]
    return spark.createDataFrame(rows, "PLACE int, FEATURE string, COEFFICIENT double")


def create_linear(spark: SparkSession, coefficients: DataFrame, name: str) -> list[str]:
    """Make ``name(inputs…)`` callable, the prediction of the linear model whose stored
    coefficients are given; the names of its inputs, in order. Missing inputs count
    as 0, as in training."""
    rows = coefficients.orderBy("PLACE").collect()  # one row per input
    inputs = [r["FEATURE"] for r in rows if r["FEATURE"] is not None]
    terms = [f"{r['COEFFICIENT']!r}D" + (f" * coalesce(x{r['PLACE']}, 0.0D)" if r["FEATURE"] is not None else "") for r in rows]
    arguments = ", ".join(f"x{i} DOUBLE" for i in range(1, len(inputs) + 1))
    body = " + ".join(f"({t})" for t in terms)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS DOUBLE RETURN {body}")
    return inputs
