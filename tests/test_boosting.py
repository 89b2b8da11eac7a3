import itertools
import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from orelake.operators import boosting as B


@pytest.fixture
def store(tmp_path):
    made = itertools.count()

    def write(df, name):
        path = str(tmp_path / f"{name}-{next(made)}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return write


def data(n, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = draw.randrange(12), draw.randrange(9), draw.random() < 0.4
        rows.append((i, float(a), float(b), float(c), 3.0 * a - 2.0 * (b > 4) * a + 5 * c + draw.gauss(0, 0.3)))
    return rows


INPUTS = ["a", "b", "c"]


def on_one_machine(rows, s):
    """The same method over lists: (base, trees as nested tuples)."""
    xs = [dict(zip(INPUTS, r[1:4])) for r in rows]
    base = sum(r[4] for r in rows) / len(rows)
    cuts = {c: sorted({x[c] for x in xs}) for c in INPUTS}
    p, trees = [base] * len(rows), []

    def seen(i, t):
        return int(md5(f"{s.seed}:{t}:{rows[i][0]}".encode()).hexdigest()[:8], 16) < int(s.rows * (1 << 32))

    def grow(ids, g, inputs, depth):
        total = sum(g[i] for i in ids)
        best = None
        if depth:
            for c in inputs:
                for cut in cuts[c]:
                    left = [i for i in ids if xs[i][c] <= cut]
                    if s.least_hessian <= len(left) <= len(ids) - s.least_hessian:
                        lg = sum(g[i] for i in left)
                        gain = B.worth(lg, len(left), s) + B.worth(total - lg, len(ids) - len(left), s) - B.worth(total, len(ids), s)
                        if gain > 1e-9 * (1 + B.worth(total, len(ids), s)) and (best is None or gain > best[0] * (1 + 1e-9)):
                            best = (gain, c, cut, left)
        if best is None:
            return B.leaf(total, len(ids), s)
        _, c, cut, left = best
        right = sorted(set(ids) - set(left))
        return B.Split(c, cut, grow(left, g, inputs, depth - 1), grow(right, g, inputs, depth - 1))

    def value(tree, x):
        while isinstance(tree, B.Split):
            tree = tree.left if x[tree.feature] <= tree.cut else tree.right
        return tree

    for t in range(s.trees):
        g = [p[i] - rows[i][4] for i in range(len(rows))]
        tree = grow([i for i in range(len(rows)) if seen(i, t)], g, B.chosen_inputs(INPUTS, t, s), s.depth)
        trees.append(tree)
        p = [v + value(tree, x) for v, x in zip(p, xs)]
    return p


@pytest.mark.parametrize("settings", [
    B.Settings(trees=12, depth=3),
    B.Settings(trees=4, depth=2, l1=8.0, l2=20.0, rows=0.5, inputs=0.4, rate=0.3, least_hessian=25.0),
])
def test_equals_one_machine(spark, store, settings):
    rows = data(240, 3)
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double").repartition(3)
    model = B.fit(df, INPUTS, "y", "k", store, settings)
    got = {r.k: r.PREDICTED for r in B.predict(model, df).collect()}
    want = on_one_machine(rows, settings)
    assert all(got[i] == pytest.approx(w, abs=1e-6) for i, w in enumerate(want))


def test_penalties_shrink_leaves():
    plain, l1, l2 = (B.Settings(l1=a, l2=b, rate=1.0) for a, b in ((0, 0), (3, 0), (0, 5)))
    assert (B.leaf(-10, 5, plain), B.leaf(-10, 5, l1), B.leaf(-10, 5, l2), B.leaf(2, 5, l1)) == (2.0, 1.4, 1.0, 0.0)


def test_learns_and_passes_over_what_is_missing(spark, store):
    rows = [(*r[:4], r[4] if r[0] % 10 else None) for r in data(300, 4)] + [(999, None, None, None, 4.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double")
    model = B.fit(df, INPUTS, "y", "k", store, B.Settings(trees=30, depth=3, rate=0.3))
    found = B.predict(model, df).filter("y IS NOT NULL")
    mean = found.agg(F.avg("y")).first()[0]
    errors = found.agg(F.avg((F.col("y") - F.col("PREDICTED")) ** 2), F.avg((F.col("y") - F.lit(mean)) ** 2)).first()
    assert errors[0] < 0.05 * errors[1]
    with pytest.raises(ValueError):
        B.fit(df.filter("y IS NULL"), INPUTS, "y", "k", store)
