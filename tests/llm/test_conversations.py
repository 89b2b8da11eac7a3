import hashlib
import random

import pytest
from pyspark.sql import functions as F

from orelake.llm import conversations as conv
from tests.llm.helpers import AWKWARD

TURNS = "conv_id long, turn long, role string, text string, block string, whole long, row string"


def plain(codes, start=conv.EMPTY, end=conv.CLOSING):
    """The cheapest edits and their least audit, place by place: (cost, audit, state)."""
    best = {start: (0, "")}
    for code in codes:
        grown = dict(best)
        for _ in range(2):
            for state, (cost, audit) in list(grown.items()):
                to = conv.ASSISTANT if state == conv.USER else conv.USER
                grown[to] = min(grown.get(to, (conv.NEVER, "")), (cost + 2, audit + "I"))
        best = {}
        for state, (cost, audit) in grown.items():
            for edit, price, ahead, to in conv.MOVES[code][state]:
                if ahead:
                    best[to] = min(best.get(to, (conv.NEVER, "")), (cost + price, audit + edit))
    return min((c + end[s], a, s) for s, (c, a) in best.items())


CODES = [k | f for k in range(4) for f in (0, 0, 0, conv.TRUNCATED, conv.FORCED)]


def test_search_finds_the_cheapest_least_audit():
    draw = random.Random(5)
    for _ in range(1500):
        codes = bytes(draw.choice(CODES) for _ in range(draw.randrange(1, 12)))
        cost, audit, state = plain(codes)
        assert conv.closed(codes) == (audit + "I" * (conv.CLOSING[state] // 2), cost)
        end = [draw.randrange(9) for _ in range(4)]
        start = draw.randrange(4)
        found = conv.search(codes, start, end)
        assert (found[2] + end[found[1]], found[0], found[1]) == plain(codes, start, end)


def test_bounds_are_never_too_high():
    draw = random.Random(6)
    for _ in range(500):
        codes = bytes(draw.choice(CODES) for _ in range(draw.randrange(1, 9)))
        end = [draw.randrange(9) for _ in range(4)]
        bounds = conv.lower_bounds(codes, end)
        for i in range(len(codes)):
            for state in range(4):
                assert bounds[4 * i + state] <= plain(codes[i:], state, end)[0]


def test_costs_of_a_block():
    draw = random.Random(7)
    for _ in range(200):
        codes = bytes(draw.choice(CODES) for _ in range(draw.randrange(1, 9)))
        found = conv.costs(codes)
        for start in range(4):
            for state in range(4):
                end = [conv.NEVER] * 4
                end[state] = 0
                assert min(found[4 * start + state], conv.NEVER) == min(plain(codes, start, end)[0], conv.NEVER)


def test_thousands_of_turns_take_few_steps():
    draw = random.Random(8)
    alternating = bytes(c | draw.choice([0] * 15 + [conv.TRUNCATED, conv.FORCED]) for c in [1, 2] * 5000 if draw.random() < 0.95)
    for codes in (alternating, bytes(draw.choice(CODES) for _ in range(1000))):
        cost, audit, state = plain(codes)
        assert conv.closed(codes) == (audit + "I" * (conv.CLOSING[state] // 2), cost)


def brute(rows):
    """Reports of conversations by their definition, with the plain table of ways."""
    out = []
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0), " " if ro is None else ro, " " if x is None else x) for i, t, ro, x in (r[:4] for r in rows) if i == c)
        turns = [t[0][1] for t in own if t[0][0]]
        roles, texts = [t[1] for t in own], [t[2] for t in own]
        codes, faults = conv.kinds(roles, texts)
        cost, audit, state = plain(codes)
        audit += "I" * (conv.CLOSING[state] // 2)
        kept, at = [], 0
        for edit in audit:
            shift = bool(kept) and kept[0][0][:1] == "s"
            role = ("user", "assistant")[(len(kept) - shift) % 2]
            if edit != "D":
                kept.append((roles[at] if edit == "K" else role, "" if edit == "I" else texts[at]))
            at += edit != "I"
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(n, conversations, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "Why? \n", "", " \t", "Fine!", "é.", None]
    roles = ["user", "assistant", "assistant", "user", "system", "tool", "", None]
    rows = []
    for _ in range(n):
        c = draw.choice(conversations)
        rows.append((c, draw.choice([None, *range(40)]), draw.choice(roles), draw.choice(texts) or draw.choice(["", None]), "b", 1, "r"))
        if draw.random() < 0.5:
            rows[-1] = (*rows[-1][:3], f"turn {draw.randrange(n)}.", "b", 1, "r")
    return rows


@pytest.mark.parametrize("long_rows", [10_000, 0, 15])
def test_equals_plain_repair_whole_and_in_blocks(spark, long_rows):
    rows = sample(160, [None, 1, 1, 1, 2, 3, 4, 5], 11)
    rows += [(9, 2, "user", "Same.", "b", 1, "r")] * 3
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    blocks = conv.repaired(df, long_rows=long_rows, block_rows=4)
    assert as_rows(conv.reports(blocks)) == brute(rows)


def test_repaired_turns_alternate(spark):
    df = spark.createDataFrame(sample(120, [1, 2, 3], 3), TURNS)
    for row in conv.repaired(df).collect():
        initials = "".join(t["role"][0] for t in row["turns"])
        rest = initials.removeprefix("s")
        assert rest == "ua" * (len(rest) // 2) and initials != "s"


def test_awkward_texts(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t, "b", 1, "r") for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, TURNS)
    assert as_rows(conv.reports(conv.repaired(df))) == brute(rows)
    assert as_rows(conv.reports(conv.repaired(df, long_bytes=1000, block_rows=2))) == brute(rows)


def test_conversations_that_lose_all_rows_and_empty_tables(spark):
    rows = [(i, 0, "user", "Hi.", "b", 1, "r") for i in range(60)] + [(None, None, None, None, "b", 1, "r")]
    df = spark.createDataFrame(rows, TURNS)
    found = {r["conv_id"]: r for r in conv.audited(df).collect()}
    assert set(found) == {r[0] for r in rows}
    gone = set(found) - {r["conv_id"] for r in conv.damaged(df).select("conv_id").distinct().collect()}
    assert gone and all(tuple(found[c])[1:7] == (0,) * 6 and found[c]["audit"] == "" for c in gone)
    assert all(found[c]["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for c in gone)
    assert conv.audited(df.filter(F.lit(False))).count() == 0
