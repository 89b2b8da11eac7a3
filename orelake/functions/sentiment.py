"""Keyword sentiment of a review text.

Words count once each and match anywhere in the lower-cased text, inside
longer words too ("unreliable" also counts "reliable"). The default form is a
native expression; the Arrow form exists for callers that want a named UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.vocab import (
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    SENTIMENT_FULL_CONFIDENCE_HITS,
    SENTIMENT_LABEL_CUT,
    SENTIMENT_NO_HIT_CONFIDENCE,
)

RESULT_TYPE = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("label", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])


def words_found(lowered: Column, words: Sequence[str]) -> Column:
    return reduce(add, [F.contains(lowered, F.lit(w)).cast("int") for w in words])


def label_of(score: Column) -> Column:
    return (
        F.when(score > SENTIMENT_LABEL_CUT, "positive")
        .when(score < -SENTIMENT_LABEL_CUT, "negative")
        .otherwise("neutral")
    )


def sentiment_from_hits(text: Column, positive: Column, negative: Column) -> Column:
    """Score, label and confidence from the two hit counts of a text."""
    hits = positive + negative
    blank = text.isNull() | (text == "")
    score = F.when(blank | (hits == 0), F.lit(0.0)).otherwise(F.bround((positive - negative) / F.nullif(hits, F.lit(0)), 2))
    confidence = (
        F.when(blank, F.lit(0.0))
        .when(hits == 0, F.lit(SENTIMENT_NO_HIT_CONFIDENCE))
        .otherwise(F.least(F.round(hits / SENTIMENT_FULL_CONFIDENCE_HITS, 2), F.lit(1.0)))
    )
    return F.struct(score.alias("score"), label_of(score).alias("label"), confidence.alias("confidence"))


def sentiment(
    text: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    lowered = F.lower(text)
    return sentiment_from_hits(text, words_found(lowered, positive), words_found(lowered, negative))


def score_batch(texts: pd.Series) -> pd.DataFrame:
    """The same rules on a pandas batch."""
    lowered = texts.fillna("").str.lower()

    def found(words):
        return sum(lowered.str.contains(w, regex=False).astype("int64") for w in words)

    up, down = found(POSITIVE_WORDS), found(NEGATIVE_WORDS)
    hits = up + down
    score = ((up - down) / hits.where(hits > 0, 1)).map(lambda v: round(v, 2))
    confidence = (hits / SENTIMENT_FULL_CONFIDENCE_HITS).clip(upper=1.0).round(2)
    confidence = confidence.where(hits > 0, SENTIMENT_NO_HIT_CONFIDENCE).where(lowered != "", 0.0)
    label = pd.Series("neutral", index=texts.index)
    label = label.mask(score > SENTIMENT_LABEL_CUT, "positive").mask(score < -SENTIMENT_LABEL_CUT, "negative")
    return pd.DataFrame({"score": score, "label": label, "confidence": confidence})


def register_sentiment(spark: SparkSession, name: str = "sentiment_score") -> None:
    """Make the scorer callable by name from SQL."""

    def scorer(texts):
        return score_batch(texts)

    scorer.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    spark.udf.register(name, F.pandas_udf(scorer, RESULT_TYPE))
