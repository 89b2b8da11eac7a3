import random

from hypothesis import given, settings
from hypothesis import strategies as st

from orelake.llm import line_dedup as L
from tests.llm.helpers import AWKWARD, docs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    """(doc_id, n_lines, n_exact, n_near, text) with every line compared with all earlier ones."""
    earlier, out = [], {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        kept, exact, near = [], 0, 0
        for line in text.split("\n") if text is not None else []:
            w = line.encode().split()
            if w and w in earlier:
                exact += 1
                continue
            if w and len(w) >= L.MIN_WORDS and any(len(e) >= L.MIN_WORDS and distance(w, e) <= 1 for e in earlier):
                near += 1
            else:
                kept.append(line)
            if w:
                earlier.append(w)
        out[i] = (i, 0 if text is None else text.count("\n") + 1, exact, near, None if text is None else "\n".join(kept))
    return [out[i] for i in sorted(out)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
def test_within_one(a, b):
    assert L.within_one(a, b) == (distance(a, b) <= 1)


def test_variants_meet_within_an_edit():
    a = [w.encode() for w in "a b c d e f g h i".split()]
    keys = L.variants(a)
    replaced = L.variants([*a[:4], b"x", *a[5:]])
    assert keys[0] != replaced[0] and keys[5] == replaced[5]
    assert L.variants(a[:4] + a[5:])[0] == keys[5]


def test_matches_brute_force_on_near_lines(spark):
    draw = random.Random(5)
    lines = [" ".join(draw.choices("ab", k=draw.randint(1, 11))) for _ in range(40)]
    for _ in range(60):
        w = draw.choice([line for line in lines if line]).split()
        at, how = draw.randrange(len(w)), draw.random()
        w[at : at + (how < 0.7)] = [] if how < 0.35 else ["x"] if how < 0.7 else ["y"]
        lines.append(" ".join(w))
    lines += [f"the template line of many words holds number {i} here" for i in range(30)]
    draw.shuffle(lines)
    texts = ["\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)]
    ids = draw.sample(range(100), len(texts))
    got = sorted(tuple(r) for r in L.deduplicated(docs(spark, texts, ids)).collect())
    assert got == brute(list(zip(ids, texts)))
    assert sum(r[3] for r in got) > 30


def test_matches_brute_force_on_documents(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet").filter("n_chars < 1500")
    got = sorted(tuple(r) for r in L.deduplicated(d).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in d.collect()])


def test_awkward_rows(spark):
    texts, ids = [*AWKWARD, "one\n\none\n two ", "one"], [5, 6, 7, 3, 4, 1, 2, 8, 9, 0, None]
    got = sorted((tuple(r) for r in L.deduplicated(docs(spark, texts, ids)).collect()), key=str)
    want = brute([(i, t) for i, t in zip(ids, texts) if i is not None])
    assert got == sorted([*want, (None, 1, 0, 0, "one")], key=str)
    twice = docs(spark, ["a\nb", "a\nb"], ids=[1, 1])
    assert [tuple(r) for r in L.deduplicated(twice).collect()] == [(1, 2, 0, 0, "a\nb")] * 2
    assert L.deduplicated(twice.limit(0)).collect() == []


def test_rows_that_share_an_id(spark):
    texts = ["a\nb\nc\nd", "a", "x\nb", "x\nb", "one two three four five six seven eight nine\nd", "one two three four five six seven eight ten"]
    ids = [1, 1, 1, 1, 1, 2]
    rows = sorted(set(zip(ids, texts)))
    want = [(i, *r[1:]) for (i, _), r in zip(rows, brute([(k, t) for k, (_, t) in enumerate(rows)]))]
    twice = next(r for (i, t), r in zip(rows, want) if t == "x\nb")
    for turn in (texts, texts[::-1]):
        found = L.deduplicated(docs(spark, turn, ids if turn is texts else ids[::-1]).repartition(3))
        assert sorted(tuple(r) for r in found.collect()) == sorted([*want, twice])


def test_a_line_is_cut_into_words_once(spark, monkeypatch):
    plans, real = {}, L.stored

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(L, "stored", noted)
    L.deduplicated(docs(spark, ["one two\n\x0b\n \t", "", None, "three"]))
    assert plans["firsts"].count("split(") == 2  # a text into lines, a line into words
