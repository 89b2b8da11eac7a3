import hashlib
import zlib
from itertools import groupby

import numpy as np
import pytest

from orelake.llm import merkle
from tests.llm.helpers import AWKWARD, docs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, at):
    """(root, siblings of node ``at``) by plain levels."""
    found = []
    while len(nodes) > 1:
        if at ^ 1 < len(nodes):
            found.append(nodes[at ^ 1])
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at //= 2
    return nodes[0], found


def refold(nodes, at, start):
    while len(nodes) > 1:
        run = nodes[at - at % 2 : at - at % 2 + 2]
        run[at % 2] = start
        start, nodes, at = h(*run), [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], at // 2
    return start


def brute(rows):
    def first(v):
        return (v is not None, v)

    made = sorted(((r[2], r[0], leaf(r), r) for r in rows), key=lambda t: (first(t[0]), first(t[1]), t[2]))
    groups = {k: list(g) for k, g in groupby(made, key=lambda t: t[0])}
    roots = [climb([t[2] for t in g], 0)[0] for g in groups.values()]
    out = []
    for k, (name, group) in enumerate(groups.items()):
        digests = [t[2] for t in group]
        for i, (_, doc_id, own, row) in enumerate(group):
            subroot, inner = climb(digests, i)
            root, outer = climb(roots, k)
            shown = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row[3] is not None:
                shown = leaf((*row[:3], row[3] + 1, row[4]))
            end = refold(roots, k, refold(digests, i, shown))
            out.append((doc_id, own, subroot, root, h(*inner, *outer), end, end == root))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 7, 11])
def test_addresses_are_a_recursive_layout(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    assert places[0][0] == 0
    if levels > 1:  # the upper half comes first, then each part below it in one piece
        top = levels // 2
        size = (1 << (levels - top)) - 1
        for i in range(1 << top):
            below = [merkle.address(levels, top + d, (i << d) + np.arange(1 << d)) for d in range(levels - top)]
            held = sorted(np.concatenate(below).tolist())
            assert held == list(range((1 << top) - 1 + i * size, (1 << top) - 1 + (i + 1) * size))


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equals_plain_tree(spark, height):
    rows = [(i, f"s{i % 3}", ["en", "de", None, "é"][0 if i % 5 else i % 4], i % 9 or None, f"text {i}") for i in range(61)]
    rows += [(None, None, None, None, None)] * 2 + [(3, "s", "en", 1, "other"), (3, "s", "en", 1, "other"), (-5, "", "zz", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert as_rows(merkle.verified(df.repartition(3), height)) == brute(rows)


def test_awkward_texts_and_clashing_names(spark):
    df = docs(spark, AWKWARD, langs=["en"] * 5 + ["de"] * 4).withColumn("n_chars", df_len()).withColumnRenamed("block", "place")
    rows = [tuple(r[c] for c in FIELDS) for r in df.collect()]
    assert as_rows(merkle.verified(df)) == brute(rows)


def df_len():
    from pyspark.sql import functions as F

    return F.length("text").cast("long")


def test_empty(spark):
    df = docs(spark, ["x"]).limit(0)
    found = merkle.verified(df)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.count() == 0


def test_single_proofs_are_read_from_few_subtrees(spark, tmp_path):
    rows = [(i, "s", "en" if i % 3 else "fr", 1, str(i)) for i in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in FIELDS))
    levels = merkle.write_manifest(merkle.document_leaves(df), str(tmp_path / "m"), height=2)
    assert levels[0] == 3
    for row in merkle.proofs(spark, str(tmp_path / "m"), levels, height=2).collect():
        path = merkle.proof_of(spark, str(tmp_path / "m"), levels, row["doc_id"], height=2) if row["doc_id"] % 13 == 0 else None
        if path is not None:
            assert merkle.siblings(path) == bytes(row["proof"]) and merkle.folded(bytes(row["leaf"]), path) == bytes(row["top"])
    assert merkle.proof_of(spark, str(tmp_path / "m"), levels, 999, height=2) is None
