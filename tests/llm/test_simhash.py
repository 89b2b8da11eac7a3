import numpy as np
import pytest
import xxhash

from orelake.llm import simhash
from orelake.llm.components import connected
from tests.llm.helpers import AWKWARD, by, docs


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id reachable over pairs of at most two differing bits."""
    root = list(range(len(prints)))
    while True:
        new = [min(root[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2) for p in prints]
        if new == root:
            return root
        root = new


@pytest.mark.parametrize("dense", [2, 64])
def test_matches_brute_force(spark, small, dense):
    d = spark.read.parquet(f"{small}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in d.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    want = [(i, f"{p:016x}", rows[g][0]) for (i, _), p, g in zip(rows, prints, plain_groups(prints))]
    got = simhash.near_groups(d, dense=dense)
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("dense", [3, 64])
def test_links_of_crowded_fingerprints(spark, dense):
    rng = np.random.default_rng(3)
    prints = {int(rng.integers(1 << 63))}
    while len(prints) < 150:  # balls around few centres, chains between them
        prints.add(rng.choice(list(prints)).item() ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63))))
    prints = sorted(prints)
    rows = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fp long, node long")
    roots = {r["node"]: r["root"] for r in connected(simhash.near_links(rows, len(prints), dense)).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == plain_groups(prints)


def test_masks_meet_within_the_radius():
    for n in (10, 1 << 22, 1 << 30, 1 << 38):
        masks = simhash.block_masks(n)
        for flip in [(0, 63), (0, 1), (31, 32), (20, 43)]:
            assert any(not m & (1 << flip[0]) and not (m >> flip[1]) & 1 for m in masks)


def test_awkward_rows(spark):
    d = docs(spark, [*AWKWARD, "lost words here", "Lost WORDS here"], ids=[9, 8, 7, 4, 3, 11, 12, 13, 14, None, 20])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_groups(d).collect()}
    assert [got[i] for i in (9, 8, 7)] == [("0" * 16, 7)] * 3
    assert got[4] == got[3] == (f"{plain_fingerprint('one'):016x}", 3)
    assert got[None] == got[20] and got[20][1] == 20
    alone = docs(spark, ["a b c d"], ids=[None])
    assert by(simhash.near_groups(alone), "doc_id", "component_id") == [(None, None)]
    assert simhash.near_groups(d.limit(0)).collect() == []


def test_keep_one(spark):
    d = docs(spark, ["a b c d", "a b c d", "other text of words", "other text of words", None, "", "a b c d"], ids=[5, 2, 7, 7, 1, 3, None])
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert by(kept, "doc_id") == sorted([(2,), (7,), (1,), (None,)], key=str)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (3, 1), (4, 4), (None, 5), (7, 8), (10, 3), (30, 29)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 7: 7, 8: 7, 9: 7, 29: 29, 30: 29, **{100 + i: 100 for i in range(41)}}
    assert connected(spark.createDataFrame([], "x long, y long")).collect() == []
