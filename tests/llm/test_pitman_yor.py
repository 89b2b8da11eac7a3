import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from orelake.llm import pitman_yor as P
from tests.llm.helpers import AWKWARD, docs


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def plain(rows):
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    count = Counter(w for i, ws in tokens if not held_out(i) for w in ws)
    n, v = sum(count.values()), len(count)
    base = lambda w: log10((count[w] + 0.1) / (n + 0.1 * (v + 1)))
    return [(i, held_out(i), len(ws), sum(count[w] > 0 for w in ws), n, sum(map(base, ws))) for i, ws in tokens]


def check(found, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted((tuple(r) for r in found.collect()), key=key)
    want = sorted(plain(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(g[6] < 0 for g in got)
    return got


def test_counts_base_and_perplexity(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    got = check(P.scored(d, block_bytes=1 << 17), rows)
    held = [g for g in got if g[1]]
    assert held and sum(g[6] for g in held) > 0.8 * sum(g[5] for g in held)  # both are negative
    whole = {r["doc_id"]: r["score"] for r in P.scored(d).collect()}
    assert all(abs(whole[g[0]] - g[6]) < 1e-6 for g in got)  # however documents are cut into blocks


def test_awkward_rows(spark):
    texts, ids = [*AWKWARD, "same", "same"], [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 3]
    check(P.scored(docs(spark, texts, ids)), list(zip(ids, texts)))
    assert P.scored(docs(spark, ["x"]).limit(0)).collect() == []


def test_nothing_to_learn_from(spark):
    i = next(i for i in range(1000) if held_out(i))
    assert check(P.scored(docs(spark, ["never seen"], [i])), [(i, "never seen")])[0][3:5] == (0, 0)


def test_predictive_probabilities_sum_to_one():
    """Over all following words and the unknown one, in any seating."""
    customers, context = np.array([5, 2, 1, 0]), 8
    keys = P.mix(np.arange(1, 5, dtype=np.uint64))
    sweep = P.Sweep(0.7, 9.0, 6.0)
    above = sweep.predictive(np.array([4, 3, 1, 1]), np.array([2, 2, 1, 1]), np.array([0.1, 0.2, 0.1, 0.1]))
    unknown = sweep.predictive(np.array([0]), np.array([0]), np.array([0.5]))
    assert above.sum() + unknown.sum() == pytest.approx(1)
    tables = P.seated(customers, above * 2, 0.6, keys, 3)
    mass = P.CONCENTRATION + 0.6 * tables.sum()
    p = (customers - 0.6 * tables + mass * above) / (P.CONCENTRATION + context)
    assert p.sum() + mass * unknown[0] / (P.CONCENTRATION + context) == pytest.approx(1)


def test_seating_follows_the_restaurant_process():
    """The mean number of tables matches a simulation that seats one customer at a time."""
    rng, n, weight, d = np.random.default_rng(0), 40, 1.5, 0.5
    means = []
    for _ in range(4000):
        t = 1
        for sitting in range(1, n):
            t += rng.random() < weight / (weight + sitting - d * t)
        means.append(t)
    keys = P.mix(np.arange(4000, dtype=np.uint64))
    got = P.seated(np.full(4000, n), np.full(4000, weight), d, keys, 1)
    assert got.mean() == pytest.approx(np.mean(means), rel=0.05)
    assert got.min() >= 1 and got.max() <= n


def test_packed_numbers():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (P.unpack_keys(P.pack_keys(keys)) == keys).all()
    for top in (0, 255, 256, 1 << 20, 1 << 40):
        assert P.unpack(P.pack(np.array([0, top]))).tolist() == [0, top]
    assert P.unpack(P.pack(np.zeros(0, np.int64))).tolist() == []


def test_pairs_are_counted_as_by_their_places():
    draw = np.random.default_rng(5)
    sizes, vocabulary = np.array([1, 400, 3, 900, 1]), np.unique(draw.integers(3, 1 << 62, 40, dtype=np.uint64))
    vocabulary = np.concatenate([[P._START, P._END], vocabulary])
    for held in ([0, 1, 0, 0, 0], [0] * 5, [1] * 5):
        codes = draw.zipf(1.5, sizes.sum()) % len(vocabulary)
        block = P.Block({"vocabulary": P.pack_keys(vocabulary), "sizes": P.pack(sizes), "codes": P.pack(codes),
                         "held_out": bytes(held)})
        keys, u, w, place = block.pairs()
        for got, want in zip(block.pair_counts(), (keys, np.bincount(place[block.learned], minlength=len(keys)))):
            assert got.tolist() == want.tolist()
        for got, want in zip(block.different_pairs(), (keys, u, w)):
            assert got.tolist() == want.tolist()


def test_what_is_loaded_is_gone_through_once_only():
    import gc

    from orelake.llm.common import give_back

    gc.unfreeze()
    try:
        give_back()
        assert gc.get_freeze_count() > 0
    finally:
        gc.unfreeze()
