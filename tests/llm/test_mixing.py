from math import log

import pytest

from orelake.llm import mixing
from tests.llm.helpers import AWKWARD, by, docs


def corpus(spark, sizes):
    texts, sources = [], []
    for source, n in sizes.items():
        texts += ["w w w w"] * n
        sources += [source] * n
    return docs(spark, texts, sources=sources)


def uses(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["source"], {}).setdefault(r["doc_id"], []).append(r["epoch"])
    return out


def test_repetition_limit_drops_nothing(spark):
    got = uses(mixing.mixed(corpus(spark, {"a": 4000, "b": 400, None: 40})))
    assert {s: len(d) for s, d in got.items()} == {"a": 4000, "b": 400, None: 40}
    mean = {s: sum(map(len, d.values())) / len(d) for s, d in got.items()}
    assert mean["a"] == 1 and 1.1 < mean["b"] < 1.4 and mean[None] == pytest.approx(1.5, abs=0.05)


def test_entropy_and_budget(spark):
    d = corpus(spark, {"a": 3000, "b": 300, "c": 30})
    target = mixing.Target(entropy=0.8, max_repeats=None)
    got = uses(mixing.mixed(d, target, budget=12_000))
    tokens = {s: 4 * sum(map(len, docs_.values())) for s, docs_ in got.items()}
    total = sum(tokens.values())
    assert total == pytest.approx(12_000, rel=0.02)
    assert -sum(t / total * log(t / total) for t in tokens.values()) / log(3) == pytest.approx(0.8, abs=0.01)
    # A document is used about as often as any other of its source, in successive passes.
    for by_doc in got.values():
        counts = [len(e) for e in by_doc.values()]
        assert max(counts) - min(counts) <= 1 and all(sorted(e) == list(range(len(e))) for e in by_doc.values())


def test_exponent_meets_bisection(spark):
    totals = spark.createDataFrame([(900,), (90,), (10,)], "total long")
    a = mixing.exponent(totals, mixing.Target(max_repeats=3.0))
    assert (900 / 10) ** (1 - a) == pytest.approx(3.0, rel=1e-6)
    a = mixing.exponent(totals, mixing.Target(entropy=0.5, max_repeats=None))
    raw = [(t / 1000) ** a for t in (900, 90, 10)]
    shares = [r / sum(raw) for r in raw]
    assert -sum(s * log(s) for s in shares) / log(3) == pytest.approx(0.5, abs=1e-6)


def test_awkward_rows(spark):
    d = docs(spark, [*AWKWARD, "x", "x"], ids=[0, 1, 2, 3, 4, 5, 6, 7, 8, None, None], sources=["e", "e", "e", *["s"] * 8])
    d = d.selectExpr("*", "1 AS epoch", "2 AS place")
    got = mixing.mixed(d)
    assert sorted(got.columns) == sorted(d.columns)
    assert {r[0] for r in by(got, "doc_id")} == {0, 1, 2, 3, 4, 5, 6, 7, 8, None}  # a source without tokens stays
    assert all(0 <= r["place"] <= 1 for r in got.collect())
    assert mixing.mixed(d.limit(0)).collect() == []
