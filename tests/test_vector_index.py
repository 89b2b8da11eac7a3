import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelake.operators import search, vector_index


@pytest.fixture
def store(tmp_path):
    made = itertools.count()

    def write(df, name):
        path = str(tmp_path / f"{name}-{next(made)}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return write


def hits(df):
    return sorted((r.QUERY_ID, r.RANK, r.DOC_ID, round(r.SCORE, 6)) for r in df.collect())


def frames(spark):
    rng = np.random.default_rng(2)
    places = rng.normal(size=(12, 6))
    vecs = {i: places[i % 12] * 3 + rng.normal(size=6) * 0.2 for i in range(500)}
    vecs |= {600 + i: vecs[3] for i in range(9)}  # equal vectors
    vecs[700] = np.zeros(6)
    rows = [(i, v.tolist()) for i, v in vecs.items()] + [(800, None)]
    qs = [(i, (places[i % 12] + rng.normal(size=6) * 0.1).tolist()) for i in range(15)] + [(99, [0.0] * 6), (98, None)]
    v = spark.createDataFrame(rows, "DOC_ID long, V array<double>").repartition(3)
    return v, spark.createDataFrame(qs, "QUERY_ID long, QUERY_VEC array<double>")


def test_equals_brute_force_and_passes_groups_over(spark, tmp_path, store, monkeypatch):
    monkeypatch.setattr(vector_index, "PART", 20)
    v, q = frames(spark)
    index = vector_index.build(v, "DOC_ID", "V", str(tmp_path / "i"), groups=25)
    assert index.groups.agg(F.sum("n")).first()[0] == 510 and index.groups.agg(F.max("parts")).first()[0] > 1
    want = hits(search.vector_topk(v, q.filter("QUERY_VEC IS NOT NULL"), 7, "DOC_ID", "V"))
    assert hits(vector_index.search(index, q, 7, store)) == want
    assert vector_index.passed_over(index, q.filter("QUERY_ID < 20"), 7, store) > 0.3


def test_fewer_than_k_and_no_queries(spark, tmp_path, store):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "DOC_ID long, V array<float>")
    q = spark.createDataFrame([(1, [1.0, 1.0])], "QUERY_ID long, QUERY_VEC array<double>")
    index = vector_index.build(v, "DOC_ID", "V", str(tmp_path / "i"))
    assert hits(vector_index.search(index, q, 5, store)) == [(1, 1, 1, 0.707107), (1, 2, 2, 0.707107)]
    assert vector_index.search(index, q.limit(0), 5, store).count() == 0
    with pytest.raises(ValueError):
        vector_index.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "DOC_ID long, V array<float>"), "DOC_ID", "V", str(tmp_path / "j"))
