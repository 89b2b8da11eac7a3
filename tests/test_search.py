import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelake.operators import search, search_index

WORDS = ["battery", "charge", "screen", "life", "cable", "the", "slow", "issue", "été"]


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(1)
    docs = {i: " ".join(rnd.choices(WORDS, k=rnd.randrange(1, 30))) + "." for i in range(60)}
    docs[60], docs[61], docs[62] = docs[0], "", None  # a copy, an empty and a missing text
    queries = {1: "Battery life, and charging issues", 2: "the été", 3: "nothing known here"}
    return docs, queries


def tokens(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def bm25(docs, query):
    tf = {i: Counter(tokens(t)) for i, t in docs.items()}
    n, avg = len(docs), sum(sum(c.values()) for c in tf.values()) / len(docs)
    out = {}
    for i, c in tf.items():
        s = 0.0
        for t in set(tokens(query)):
            df = sum(t in d for d in tf.values())
            if c[t]:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                s += idf * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / avg))
        if any(c[t] for t in set(tokens(query))):
            out[i] = round(s, 6)
    return out


def cosine(docs, query):
    tf = {i: Counter(tokens(t)) for i, t in docs.items()}
    q = {t: (1 + math.log(f)) * math.log(len(docs) / d) for t, f in Counter(tokens(query)).items() if (d := sum(t in c for c in tf.values()))}
    nq = math.sqrt(sum(v * v for v in q.values()))
    out = {}
    for i, c in tf.items():
        nd = math.sqrt(sum((1 + math.log(f)) ** 2 for f in c.values()))
        s = sum(q[t] * (1 + math.log(c[t])) for t in q if c[t])
        if nq and nd and s > 0:
            out[i] = round(s / nq / nd, 6)
    return out


def best(scores, k):
    ranked = sorted(scores.items(), key=lambda p: (-p[1], p[0]))[:k]
    return [(d, s, r) for r, (d, s) in enumerate(ranked, 1)]


@pytest.fixture(scope="module")
def frames(spark, corpus, tmp_path_factory):
    docs, queries = corpus
    d = spark.createDataFrame(list(docs.items()), "DOC_ID long, T string")
    q = spark.createDataFrame(list(queries.items()), "QUERY_ID long, QUERY_TEXT string")
    # Small blocks and parts: most terms have several of both.
    return search_index.build_index(d, "DOC_ID", "T", str(tmp_path_factory.mktemp("index")), block=4, part=20), q


def hits(df):
    out = {}
    for r in df.orderBy("QUERY_ID", "RANK").collect():
        out.setdefault(r.QUERY_ID, []).append((r.DOC_ID, round(r.SCORE, 6), r.RANK))
    return out


@pytest.mark.parametrize("find, score", [(search.keyword_search, bm25), (search.text_vector_search, cosine)])
def test_ranking_matches_brute_force(corpus, frames, find, score):
    docs, queries = corpus
    index, q = frames
    got = hits(find(index, q, 7))
    assert got == {i: best(score(docs, t), 7) for i, t in queries.items() if score(docs, t)}


def test_attribute_filter_applies_before_ranking(spark, corpus, frames):
    docs, queries = corpus
    index, q = frames
    attrs = spark.createDataFrame([(i, i % 3) for i in docs], "DOC_ID long, KIND long")
    got = hits(search.keyword_search(index, q, 5, attrs=attrs, where=F.col("KIND") == 1))
    for i, t in queries.items():
        want = best({d: s for d, s in bm25(docs, t).items() if d % 3 == 1}, 5)
        assert got.get(i, []) == want


def test_index_holds_every_posting_and_the_greatest_shares(spark, corpus, frames):
    docs, _ = corpus
    index, _ = frames
    want = {(d, t): n for d, text in docs.items() for t, n in Counter(tokens(text)).items()}
    rows = index.postings.collect()
    assert {(r.DOC_ID, r.term): r.tf for r in rows} == want and len(rows) == len(want)
    assert index.n_docs == len(docs) and index.n_terms == sum(want.values())
    held = {}
    for r in rows:
        held.setdefault((r.term, r.part, r.block), []).append(r)
    for b in index.blocks.collect():
        mine = held.pop((b.term, b.part, b.block))
        assert b.n == len(mine) <= 4
        assert b.keyword_share == max(r.keyword_share for r in mine) and b.vector_share == max(r.vector_share for r in mine)
    assert not held
    assert {r.term: r.df for r in search_index.lexicon(index).collect()} == Counter(t for _, t in want)
    again = search_index.open_index(spark, index.path)
    assert (again.n_docs, again.n_terms, again.buckets) == (index.n_docs, index.n_terms, index.buckets)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Few documents are about anything; most hold a term once among much else."""
    rnd = random.Random(3)
    docs = {}
    for i in range(400):
        words = ["filler"] * rnd.randrange(30, 60) + ["lake"] * (rnd.random() < 0.7) + ["spark"] * (rnd.random() < 0.5)
        docs[i] = " ".join(rnd.sample(words, len(words)))
    for i in range(0, 400, 40):
        docs[i] = " ".join(["lake"] * rnd.randrange(5, 9) + ["spark"] * rnd.randrange(5, 9))
    d = spark.createDataFrame(list(docs.items()), "DOC_ID long, T string").repartition(5)
    q = spark.createDataFrame([(1, "lake spark"), (2, "spark"), (3, "filler lake")], "QUERY_ID long, QUERY_TEXT string")
    return docs, search_index.build_index(d, "DOC_ID", "T", str(tmp_path_factory.mktemp("skewed")), block=16), q


def test_blocks_that_cannot_matter_are_passed_over(skewed):
    docs, index, q = skewed
    terms = search_index.query_terms(q, "QUERY_ID", "QUERY_TEXT")
    hint = F.broadcast
    weights = search_index.keyword_weights(index, terms, "QUERY_ID", hint)
    blocks = search_index.wanted_blocks(index, weights, search_index.KEYWORD, "QUERY_ID", 3, hint).collect()
    passed = [b for b in blocks if not b.wanted]
    assert len(passed) > len(blocks) / 3
    # and nothing is lost by it
    got = hits(search.keyword_search(index, q, 3))
    texts = {1: "lake spark", 2: "spark", 3: "filler lake"}
    assert got == {i: best(bm25(docs, t), 3) for i, t in texts.items()}
    assert hits(search.text_vector_search(index, q, 3)) == {i: best(cosine(docs, t), 3) for i, t in texts.items()}


def test_shuffle_join_beyond_the_broadcast_bound(corpus, frames, monkeypatch):
    index, q = frames
    want = hits(search.keyword_search(index, q, 5))
    monkeypatch.setattr(search, "broadcast_hint", lambda terms: lambda df: df)
    monkeypatch.setattr(search_index, "BROADCAST_ROWS", 0)
    assert hits(search.keyword_search(index, q, 5)) == want


def test_index_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "DOC_ID long, T string")
    index = search_index.build_index(empty, "DOC_ID", "T", str(tmp_path / "i"))
    q = spark.createDataFrame([(1, "a b")], "QUERY_ID long, QUERY_TEXT string")
    assert search.keyword_search(index, q, 3).count() == 0 and search.text_vector_search(index, q, 3).count() == 0


def test_vector_topk_exact_and_in_blocks(spark):
    rng = np.random.default_rng(0)
    vecs = {i: rng.normal(size=8).astype("float32") for i in range(300)}
    vecs[300] = vecs[5]
    vecs[301] = np.zeros(8, dtype="float32")
    qs = {i: rng.normal(size=8) for i in range(9)}
    v = spark.createDataFrame([(i, x.tolist()) for i, x in vecs.items()], "DOC_ID long, V array<float>").repartition(5)
    q = spark.createDataFrame([(i, x.tolist()) for i, x in qs.items()], "QUERY_ID long, QUERY_VEC array<double>")

    def cos(a, b):
        return float(a.astype("float64") @ b / ((np.linalg.norm(a.astype("float64")) or 1) * np.linalg.norm(b)))

    want = {i: best({d: round(cos(x, y), 6) for d, x in vecs.items()}, 4) for i, y in qs.items()}
    assert hits(search.vector_topk(v, q, 4, "DOC_ID", "V")) == want
    assert hits(search.vector_topk(v, q, 4, "DOC_ID", "V", max_queries=4)) == want
    assert search.vector_topk(v, q.limit(0), 4, "DOC_ID", "V").count() == 0


def test_fusion_and_columns(spark):
    a = spark.createDataFrame([(1, 10, 9.0, 1), (1, 11, 8.0, 2)], "QUERY_ID long, DOC_ID long, SCORE double, RANK long")
    b = spark.createDataFrame([(1, 11, 0.9, 1), (1, 12, 0.8, 2)], "QUERY_ID long, DOC_ID long, SCORE double, RANK long")
    got = search.hybrid_search(a, b, 2)
    assert [(r.DOC_ID, r.RANK) for r in got.orderBy("RANK").collect()] == [(11, 1), (10, 2)]
    docs = spark.createDataFrame([(11, "x"), (10, "y")], "DOC_ID long, NAME string")
    assert {r.NAME for r in search.with_attributes(got, docs, "DOC_ID", ["NAME"]).collect()} == {"x", "y"}


def test_blocks_of_a_frequent_term_are_numbered_across_its_parts(spark, corpus, tmp_path, monkeypatch):
    docs, _ = corpus
    monkeypatch.setattr(search_index, "RANGE", 7)  # a term lies in several ranges
    d = spark.createDataFrame(list(docs.items()), "DOC_ID long, T string")
    index = search_index.build_index(d, "DOC_ID", "T", str(tmp_path / "i"), block=4, part=20)
    by_term = {}
    for r in index.postings.collect():
        by_term.setdefault(r.term, []).append(r)
    assert max(map(len, by_term.values())) > 20
    for term, mine in by_term.items():
        mine.sort(key=lambda r: (-r.keyword_share, r.DOC_ID))
        assert [r.block for r in mine] == [i // 4 for i in range(len(mine))], term
    blocks = [(r.term, r.block) for r in index.blocks.collect()]
    assert len(blocks) == len(set(blocks))


def test_best_of_many_deals_and_parties(corpus, frames, monkeypatch):
    docs, queries = corpus
    index, q = frames
    monkeypatch.setattr(search_index, "DEAL", 40)
    monkeypatch.setattr(search_index, "QUERY_TERMS", 2)
    for find, score in ((search.keyword_search, bm25), (search.text_vector_search, cosine)):
        assert hits(find(index, q, 3)) == {i: best(score(docs, t), 3) for i, t in queries.items() if score(docs, t)}
