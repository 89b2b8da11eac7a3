import pytest
from pyspark.sql import functions as F

from orelake.functions.sentiment import register_sentiment, score_batch, sentiment
from orelake.vocab import NEGATIVE_WORDS, POSITIVE_WORDS

CASES = {
    None: (0.0, "neutral", 0.0),
    "": (0.0, "neutral", 0.0),
    "a plain text": (0.0, "neutral", 0.3),
    "It is EXCELLENT": (1.0, "positive", 0.2),
    "terrible": (-1.0, "negative", 0.2),
    "unreliable": (0.0, "neutral", 0.4),  # counts for both lists
    "whatever": (-1.0, "negative", 0.2),  # contains "hate"
    "great great great": (1.0, "positive", 0.2),  # each word counts once
    " ".join(POSITIVE_WORDS[:4] + NEGATIVE_WORDS[:3]): (0.14, "neutral", 1.0),
    " ".join([w for w in POSITIVE_WORDS if w != "reliable"][:9] + NEGATIVE_WORDS[:7]): (0.12, "neutral", 1.0),  # 2/16, half even
    "great best slow": (0.33, "positive", 0.6),
}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in CASES], "t string")


def test_native_expression(texts):
    got = {r.t: tuple(r.s) for r in texts.withColumn("s", sentiment(F.col("t"))).collect()}
    assert got == CASES


def test_named_function_agrees(spark, texts):
    register_sentiment(spark)
    texts.createOrReplaceTempView("review_texts")
    got = {r.t: tuple(r.s) for r in spark.sql("SELECT t, sentiment_score(t) AS s FROM review_texts").collect()}
    assert got == CASES


def test_batch_scorer_on_an_empty_batch():
    import pandas as pd

    assert len(score_batch(pd.Series([], dtype="object"))) == 0


def test_own_word_lists(texts):
    s = sentiment(F.col("t"), positive=["plain"], negative=["text"])
    got = {r.t: r.s.confidence for r in texts.withColumn("s", s).collect()}
    assert got["a plain text"] == 0.4 and got["terrible"] == 0.3
