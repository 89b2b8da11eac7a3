"""Gradient-boosted regression trees with L1 and L2 penalties on the leaves.

Squared loss, second-order form: a leaf with gradient sum G and hessian sum H (the rows
in it) is worth -shrunk(G) / (H + l2), where shrunk takes l1 off the size of G, and a split
is as good as the values it adds. Inputs are cut into bins at approximate quantiles once.
A level of a tree is one hash aggregate over (node, input, bin), so what reaches the
driver is bounded by nodes, inputs and bins, never by rows; the driver picks the
splits, and the trees so far are an expression that tasks evaluate. Rows and inputs are
sampled for each tree by hashes of the row's key and the input's name, which a
recomputed task repeats.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Settings:
    trees: int = 200
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8  # share of the rows a tree sees
    inputs: float = 0.8  # share of the inputs
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 64
    least_hessian: float = 1.0  # on either side of a split
    seed: int = 42


@dataclass(frozen=True)
class Split:
    feature: str
    cut: float  # rows up to it go left
    left: "Split | float"
    right: "Split | float"


@dataclass(frozen=True)
class Boosted:
    """A fitted model: ``base`` and the trees, whose leaves hold the learning rate already."""

    inputs: tuple[str, ...]
    base: float
    trees: tuple["Split | float", ...]

    def predicted(self) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _value(tree)
        return total


def _value(tree: Split | float) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(F.col(tree.feature) <= tree.cut, _value(tree.left)).otherwise(_value(tree.right))


def shrunk(gradient: float, l1: float) -> float:
    return max(abs(gradient) - l1, 0.0) * (1 if gradient > 0 else -1)


def worth(gradient: float, hessian: float, s: Settings) -> float:
    return shrunk(gradient, s.l1) ** 2 / (hessian + s.l2)


def leaf(gradient: float, hessian: float, s: Settings) -> float:
    return -shrunk(gradient, s.l1) / (hessian + s.l2) * s.rate


def chosen_inputs(inputs: Sequence[str], tree: int, s: Settings) -> list[str]:
    """The inputs of a tree: those whose hashes are least."""
    order = sorted(inputs, key=lambda c: md5(f"{s.seed}:{tree}:{c}".encode()).digest())
    return sorted(order[: max(1, round(len(order) * s.inputs))], key=list(inputs).index)


def in_tree(key: str, tree: int, s: Settings) -> Column:
    """Whether a tree sees a row, by the md5 of seed, tree and the row's key."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(s.seed)), F.lit(str(tree)), F.col(key).cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") < F.lit(int(s.rows * (1 << 32)))


def cuts_of(rows: DataFrame, inputs: Sequence[str], bins: int) -> dict[str, list[float]]:
    """For each input the values between its bins; few enough different values are bins of their own."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(c, shares, 100_000).alias(c) for c in inputs]).first()
    return {c: sorted(set(found[c] or [])) for c in inputs}


def _bin(feature: str, cuts: Sequence[float]) -> Column:
    """The number of cuts below a value, so that bin b holds what is at most cut b."""
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts]), lambda x: x < F.col(feature)))


def best_split(sums: dict[str, dict[int, tuple[float, float]]], cuts: dict[str, list[float]], s: Settings) -> tuple[float, str, int] | None:
    """(gain, input, bin) of the best split of a node by the gradient and hessian sums of
    its bins: everything up to the bin goes left. The first input, then bin, wins a tie."""
    best = None
    for feature, held in sums.items():
        g, h = (sum(x[i] for x in held.values()) for i in (0, 1))
        whole, left_g, left_h = worth(g, h, s), 0.0, 0.0
        for b in range(len(cuts[feature])):
            more = held.get(b)
            if more is None:
                continue
            left_g, left_h = left_g + more[0], left_h + more[1]
            if left_h < s.least_hessian or h - left_h < s.least_hessian:
                continue
            gain = worth(left_g, left_h, s) + worth(g - left_g, h - left_h, s) - whole
            if gain > 1e-9 * (1 + abs(whole)) and (best is None or gain > best[0] + 1e-9 * abs(best[0])):
                best = (gain, feature, b)
    return best


def _node(paths: dict[int, tuple[str, float]], at: int = 1) -> Column:
    """The open node a row is in, by the splits made so far: node n has 2n and 2n + 1 below it."""
    if at not in paths:
        return F.lit(at)
    feature, cut = paths[at]
    return F.when(F.col(feature) <= cut, _node(paths, 2 * at)).otherwise(_node(paths, 2 * at + 1))


def grown(rows: DataFrame, features: Sequence[str], cuts: dict[str, list[float]], s: Settings) -> Split | float:
    """One tree over rows with the columns ``_g`` and ``_bin_<input>``."""
    splits: dict[int, tuple[str, float]] = {}
    totals: dict[int, tuple[float, float]] = {}
    open_nodes = {1}
    for level in range(s.depth + 1):
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_bin_{c}").alias("b")) for i, c in enumerate(features)]))
        at = rows.select(_node(splits).alias("node"), "_g", cells.alias("cell"))
        sums = at.filter(F.col("node").isin(sorted(open_nodes))).groupBy("node", "cell.f", "cell.b").agg(
            F.sum("_g").alias("g"), F.count(F.lit(1)).cast("double").alias("h")
        )
        held: dict[int, dict[str, dict[int, tuple[float, float]]]] = {n: {c: {} for c in features} for n in open_nodes}
        for r in sums.collect():  # at most nodes x inputs x bins rows
            held[r["node"]][features[r["f"]]][r["b"]] = (r["g"], r["h"])
        below = set()
        for n in sorted(open_nodes):
            first = held[n][features[0]].values()
            totals[n] = (sum(x[0] for x in first), sum(x[1] for x in first))
            found = best_split({c: held[n][c] for c in features}, cuts, s) if level < s.depth else None
            if found is not None:
                splits[n] = (found[1], cuts[found[1]][found[2]])
                below |= {2 * n, 2 * n + 1}
        open_nodes = below
        if not open_nodes:
            break

    def built(n: int) -> Split | float:
        if n not in splits:
            return leaf(*totals[n], s)
        return Split(*splits[n], built(2 * n), built(2 * n + 1))

    return built(1)


def fit(rows: DataFrame, inputs: Sequence[str], label: str, key: str, store, settings: Settings = Settings()) -> Boosted:
    """Fit on ``rows``, of which those without a label are passed over; missing inputs
    count as 0. ``key`` identifies a row. ``store(df, name)`` writes a table and reads
    it back: it cuts the lineage once before and after every ten trees."""
    s = settings
    plain = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in inputs]
    y = F.col(label).cast("double").alias("_y")
    known = store(rows.filter(F.col(label).isNotNull()).select(F.col(key).cast("string").alias("_key"), y, *plain), "rows")
    base = known.agg(F.avg("_y")).first()[0]
    if base is None:
        raise ValueError("no row has a label")
    cuts = cuts_of(known, inputs, s.bins)
    binned = known.select("*", F.lit(float(base)).alias("_p"), *[_bin(c, cuts[c]).alias(f"_bin_{c}") for c in inputs])
    held = store(binned, "binned")
    trees: list[Split | float] = []
    since = 0  # trees that the stored predictions lack
    for t in range(s.trees):
        p = F.col("_p")
        for tree in trees[len(trees) - since :]:
            p = p + _value(tree)
        seen = held.filter(in_tree("_key", t, s)).withColumn("_g", p - F.col("_y"))
        tree = grown(seen, chosen_inputs(inputs, t, s), cuts, s)
        trees.append(tree)
        since += 1
        if since == 10:
            for tree in trees[-since:]:
                held = held.withColumn("_p", F.col("_p") + _value(tree))
            held, since = store(held, f"after{t}"), 0
    return Boosted(tuple(inputs), float(base), tuple(trees))


def predict(model: Boosted, rows: DataFrame, out: str = "PREDICTED") -> DataFrame:
    names = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.inputs}
    return rows.withColumns(names).withColumn(out, model.predicted())
