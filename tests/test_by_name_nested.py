from hashlib import md5

import pytest
from pyspark.sql import functions as F

from orelake.functions import by_name
from orelake.functions.sentiment import sentiment
from orelake.operators import models
from orelake.operators.ranking import random_numbers
from orelake.sources import nested


@pytest.mark.parametrize("per_range", [50_000, 7, 1])
def test_random_numbers_are_a_permutation_however_rows_lie(spark, per_range):
    keys = [*range(200), None]
    want = {k: i for i, k in enumerate(sorted(keys, key=lambda k: (md5(("5:" + str(k) if k is not None else "5").encode()).hexdigest())), 1)}
    for parts in (1, 5):
        df = spark.createDataFrame([(k, "x") for k in keys], "k long, other string").repartition(parts)
        got = {r.k: r.n for r in random_numbers(df, ["k"], "n", seed=5, per_range=per_range).collect()}
        assert got == want
    assert random_numbers(df.limit(0), ["k"], "n").count() == 0


def test_nested_paths_and_elements(spark):
    texts = [
        (1, '{"content": [{"text": "a", "n": 1}, {"text": null}, 7], "meta": {"id": "x"}}'), (2, '{"content": []}'),
        (3, '{"content": {"k": {"text": "in an object"}}}'), (4, "no json {"), (5, None), (6, '{"content": "text"}'),
    ]
    df = nested.as_variant(spark.createDataFrame(texts, "id long, doc string"), "doc")
    heads = nested.at_path(df, "v", {"first": ("$.content[0].text", "string"), "n": ("$.content[0].n", "int"), "bad": ("$.meta.id", "int")})
    assert [(r.id, r.first, r.n, r.bad) for r in heads.orderBy("id").collect()] == [
        (1, "a", 1, None), (2, None, None, None), (3, None, None, None), (4, None, None, None), (5, None, None, None), (6, None, None, None),
    ]
    rows = nested.elements(df, "v", "$.content", {"text": ("$.text", "string"), "n": ("$.n", "bigint")}, ["id"])
    got = sorted((r.id, r.POS, r.text, r.n) for r in rows.filter("id <> 1").collect())
    assert got == [(3, 0, "in an object", None)]
    assert [(r.POS, r.text, r.n) for r in rows.filter("id = 1").orderBy("POS").collect()] == [(0, "a", 1), (1, None, None), (2, None, None)]


def test_sentiment_by_name_equals_the_expression(spark):
    texts = [None, "", "Great and reliable", "TERRIBLE, broke. bad", "great but terrible", "it's \\ plain", "love love amazing excellent great"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_name.create_sentiment(spark, "mood")
    found = spark.sql("SELECT t, mood(t) AS s FROM {df}", df=df).withColumn("w", sentiment(F.col("t"))).collect()
    assert len(found) == len(texts) and all(tuple(r.s) == tuple(r.w) for r in found)
    plan = spark.sql("SELECT mood(t) AS s FROM {df}", df=df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_linear_model_by_name(spark, tmp_path):
    rows = [(float(i), float(i * i % 7), 3.0 + 2 * i - (i * i % 7)) for i in range(30)]
    df = spark.createDataFrame([*rows, (None, 2.0, 1.0)], "a double, b double, MONTHLY_REVENUE double")
    model = models.train_revenue_model(df.filter("a IS NOT NULL"), ["a", "b"], "linear")
    by_name.linear_coefficients(spark, model, ["a", "b"]).write.parquet(str(tmp_path / "c"))
    assert by_name.create_linear(spark, spark.read.parquet(str(tmp_path / "c")), "predict_it") == ["a", "b"]
    got = spark.sql("SELECT predict_it(a, b) AS p, MONTHLY_REVENUE AS y, a FROM {df}", df=df).collect()
    assert all(r.p == pytest.approx(r.y, abs=1e-6) for r in got if r.a is not None)
    assert next(r.p for r in got if r.a is None) == pytest.approx(1.0, abs=1e-6)
