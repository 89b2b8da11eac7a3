import hashlib
import re

import pytest

from orelake.llm import decontaminate
from tests.llm.helpers import AWKWARD, by, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if names := windows.get(tuple(w[i : i + size])):
                    found |= names
                    hit |= set(range(i, i + size))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, row string")


@pytest.mark.parametrize("part", [40, 250_000])
def test_matches_brute_force(spark, small, part):
    d, b = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in d.collect()], [(r["item_id"], r["text"]) for r in b.collect()])
    assert sum(w[-1] for w in want) > 0
    assert by(decontaminate.contamination(d, b, part_windows=part), *COLUMNS) == want


def test_overlaps_short_items_repeated_items_and_awkward_texts(spark):
    item = "a b c d e f g h i j k l m n o p"
    items = [(1, item), (10, "Zwei, WORTE"), (2, "zwei worte"), (2, "eins"), (3, None), (4, "?!"), (5, "one")]
    texts = [*AWKWARD, f"x {item} {item} y", "a b c d e f g h i j k l", "eins", "zwei worte zwei worte " + "z " * 200, "B-A"]
    ids = [*range(len(texts) - 1), None]
    got = by(decontaminate.contamination(docs(spark, texts, ids), benchmark(spark, items)), *COLUMNS)
    assert got == brute(list(zip(ids, texts)), items)


def test_empty_tables(spark):
    d, b = docs(spark, ["a b", None]), benchmark(spark, [(1, "a b")])
    none = hashlib.sha256(b"").hexdigest()
    assert by(decontaminate.contamination(d, b.limit(0)), *COLUMNS) == [(0, 2, 0, 0, none, False), (1, 0, 0, 0, none, False)]
    assert decontaminate.contamination(d.limit(0), b).collect() == []


def test_keep_clean(spark):
    d = docs(spark, ["a b", "a b", "c d", None, "a b"], ids=[1, 1, 2, 3, None])
    kept = decontaminate.keep_clean(d, benchmark(spark, [(1, "A b")]))
    assert kept.columns == d.columns and by(kept, "doc_id") == [(2,), (3,)]
