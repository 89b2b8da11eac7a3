"""Exact top-k inner products by a vector-approximation file.

Vectors are integer; every dimension is cut into 2^bits equal cells between its
smallest and largest value. The file of approximations holds one byte per
dimension. A query's score with any vector of a cell lies between two bounds,
which differ by a constant of the query, so one product with the cells' lower
corners gives both, widened by what floating-point sums of that size may lose.

Scan: vectors and queries are cut into blocks; the grid of block pairs is shuffled
as packed rows, approximations only. In a pair, a vector stays a candidate for
a query if its upper bound reaches the pair's k-th best lower bound. Candidates
of all pairs are then cut by the k-th best lower bound overall.

Read: candidates are taken in the order of their bounds. The exact vectors of the
first k give the score that the k-th result has at least; of the others only
those whose bound reaches it are read, which makes the result certain.

Equal vectors differ in nothing but their ids, and ties go to smaller ids, so of
each group of equal vectors only the k + 1 smallest ids enter the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import give_back, in_arrow, stored

BITS = 6
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 1_024
AT_ONCE = 128
EXACT = 1 << 20  # scaled components below it have products whose sums fit 64 bits
GREATEST = 1 << 61  # a scaled component beyond it counts as it
EPSILON = float(np.finfo(np.float64).eps)


def scaled(vector: str, factor: int = 256) -> Column:
    end = float(GREATEST)
    x = lambda c: F.floor(c * F.lit(float(factor)))
    return F.transform(
        F.col(vector).cast("array<double>"),
        lambda c: F.when(F.abs(c * F.lit(float(factor))) < end, x(c)).otherwise((F.signum(c) * end).cast("long")),
    )


def usable(vectors: DataFrame, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """(row, id, v array<bigint>, wide) of the vectors that take part; ``wide`` ones may
    have scores beyond 64 bits."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = kept.select(F.col(id_col).cast("long").alias("id"), scaled(vector_col, factor).alias("v"))
    wide = F.exists("v", lambda c: F.abs(c) >= EXACT)
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "v", wide.alias("wide"))


def _ranges(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length the smallest and largest value of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            sizes = np.diff(column.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                m = column.filter(pa.array(sizes == d)).flatten().to_numpy().reshape(-1, max(d, 1))
                if not d:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d]), pa.array([m.min(0).tolist()]), pa.array([m.max(0).tolist()])], names=["d", "lo", "hi"]
                )

    found = in_arrow(rows.select("v"), run, "d bigint, lo array<bigint>, hi array<bigint>")
    each = found.select("d", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "b"))
    ends = each.groupBy("d", "at").agg(F.min("b.lo").alias("lo"), F.max("b.hi").alias("hi"))
    out: dict[int, list] = {}
    for r in ends.orderBy("d", "at").collect():  # one row per dimension
        out.setdefault(r["d"], []).append((r["lo"], r["hi"]))
    found = {d: tuple(np.array(x, dtype=np.int64) for x in zip(*pairs)) for d, pairs in out.items()}
    return {0: (np.zeros(0, np.int64), np.zeros(0, np.int64))} | found


def _candidates(rows: DataFrame, asked: DataFrame, k: int, bits: int, n: int, n_asked: int) -> DataFrame:
    """(query_id, vec_id, lower, upper) of the pairs that a block's bounds cannot rule out."""
    ranges = _ranges(rows)
    widths = {d: -(-(hi - lo + 1) // (1 << bits)) for d, (lo, hi) in ranges.items()}
    v_blocks, q_blocks = -(-n // BLOCK_VECTORS), -(-n_asked // BLOCK_QUERIES)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids, home = batch.column("v"), batch.column("row").to_numpy(), batch.column("vb").to_numpy()
            sizes = np.diff(column.offsets.to_numpy())
            for d, b in sorted(set(zip(sizes.tolist(), home.tolist()))):
                here = (sizes == d) & (home == b)
                m = column.filter(pa.array(here)).flatten().to_numpy().reshape(int(here.sum()), d)
                cells = ((m - ranges[d][0]) // widths[d]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d]), pa.array([b]), pa.array([ids[here].tobytes()]), pa.array([cells.tobytes()])],
                    names=["d", "vb", "ids", "cells"],
                )

    block = F.pmod(F.xxhash64("row"), F.lit(v_blocks))
    cells = in_arrow(rows.withColumn("vb", block), approximate, "d bigint, vb bigint, ids binary, cells binary")
    grid = cells.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumn("qb", F.col("qb").cast("long"))
    held = asked.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(q_blocks))).withColumn("d", F.size("v").cast("long"))
    packed = held.groupBy("d", "qb").agg(F.collect_list(F.struct("row", "v")).alias("queries"))  # about BLOCK_QUERIES
    spread = packed.withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)))).withColumn("vb", F.col("vb").cast("long"))

    def bound(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        names = ["query", "row", "lower", "upper"]
        out: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            d = key[0].as_py()
            low, width = ranges[d][0], widths[d]
            ids = np.concatenate([np.frombuffer(x, np.int64) for x in left.column("ids").to_pylist()])
            cells = np.frombuffer(b"".join(left.column("cells").to_pylist()), np.uint8).reshape(len(ids), d)
            corners = (cells * width + low).astype(np.float64)
            lengths = np.sqrt((corners * corners).sum(axis=1))
            queries = [q for row in right.column("queries").to_pylist() for q in row]
            for at in range(0, len(queries), AT_ONCE):
                some = queries[at : at + AT_ONCE]
                own = np.array([q["row"] for q in some])
                q = np.array([q["v"] for q in some], dtype=np.float64).reshape(len(some), d)
                base = q @ corners.T
                # What rounding can add up to follows the products' sizes, not their sum.
                sizes = np.sqrt((q * q).sum(axis=1))[:, None] * lengths + (np.abs(q) @ width.astype(np.float64))[:, None]
                slack = 1 + 8 * (d + 2) * EPSILON * sizes
                under, over = np.minimum(q, 0) @ (width - 1), np.maximum(q, 0) @ (width - 1)
                lower, upper = base + under[:, None] - slack, base + over[:, None] + slack
                lower[own[:, None] == ids[None, :]] = -np.inf
                if len(ids) > k:
                    least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
                else:
                    least = np.full(len(some), -np.inf)
                stay = (upper >= least[:, None]) & (lower > -np.inf)
                i, j = np.nonzero(stay)
                for part, x in zip(out, (own[i], ids[j], lower[i, j], upper[i, j])):
                    part.append(x)
        kinds = [np.int64, np.int64, np.float64, np.float64]
        return pa.table([np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, kinds)], names=names)

    pairs = grid.groupBy("d", "vb", "qb").cogroup(spread.groupBy("d", "vb", "qb"))
    return pairs.applyInArrow(bound, "query bigint, row bigint, lower double, upper double")


def _wide_score() -> Column:
    """The exact score in decimal arithmetic; beyond 64 bits the nearest that fits."""
    wide = "decimal(38,0)"
    product = lambda a, b: F.try_multiply(a.cast(wide), b.cast(wide)).cast(wide)
    exact = F.aggregate(F.zip_with("x", "y", product), F.lit(0).cast(wide), lambda s, p: F.try_add(s, p).cast(wide))
    about = F.aggregate(F.zip_with("x", "y", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, p: s + p)
    least, most = F.lit(-(1 << 63)).cast(wide), F.lit((1 << 63) - 1).cast(wide)
    ends = F.when(about < 0, least).otherwise(most)
    return F.greatest(F.least(F.coalesce(exact, ends), most), least).cast("long")


def _scored(pairs: DataFrame, asked: DataFrame, rows: DataFrame) -> DataFrame:
    theirs = rows.select("row", F.col("id").alias("vec_id"), F.col("v").alias("y"), F.col("wide").alias("wide_y"))
    mine = asked.select(F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("x"), "wide")
    full = pairs.join(theirs, "row").join(mine, "query")
    plain = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, p: s + p)
    score = F.when(F.col("wide") | F.col("wide_y"), _wide_score()).otherwise(plain)
    return full.select("query", "query_id", "row", "vec_id", score.alias("score"))


def topk(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 256,
    bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other vectors for each
    vector whose id is divisible by ``every``.

    A component x counts as floor(factor * x), one beyond 2^61 as that. Vectors that
    are null or hold a null or non-finite component take no part, nor do rows with a
    null id. Rows that share an id are rows of their own, as queries and as results.
    Only vectors of one length are compared. Equal scores rank by smaller id; scores
    beyond 64 bits count as the nearest that fits. Queries with fewer than k others
    get them all.
    """
    rows = stored(usable(vectors, id_col, vector_col, factor), "vectors")
    asked = rows.filter(F.col("id") % every == 0)
    alike = F.row_number().over(W.partitionBy("v").orderBy("id", "row"))
    kept = rows.withColumn("alike", alike).filter(F.col("alike") <= k + 1).drop("alike")
    n, n_asked = rows.count(), asked.count()
    if not n_asked:
        return rows.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")
        ).limit(0)
    kept = stored(kept, "file")
    found = _candidates(kept, asked, k, bits, n, n_asked)
    place = F.row_number().over(W.partitionBy("query").orderBy(F.col("lower").desc()))
    least = F.max(F.when(F.col("place") == k, F.col("lower"))).over(W.partitionBy("query"))
    found = found.withColumn("place", place).withColumn("least", least)
    found = found.filter(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    order = F.row_number().over(W.partitionBy("query").orderBy(F.col("upper").desc(), "row"))
    found = stored(found.select("query", "row", "upper", order.alias("turn")), "candidates")

    first = stored(_scored(found.filter(F.col("turn") <= k), asked, kept), "first")
    sure = first.groupBy("query").agg(F.min("score").alias("sure"))
    others = found.filter(F.col("turn") > k).join(sure, "query").filter(F.col("upper") >= F.col("sure"))
    read = first.unionByName(_scored(others.drop("sure", "upper", "turn"), asked, kept))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row"))
    best = read.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
  SELECT a.place, a.vec_id AS query_id, b.vec_id, CAST(CASE WHEN len(a.q) > 0 THEN list_dot_product(a.q, b.q) ELSE 0 END AS BIGINT) AS score
  FROM v a JOIN v b ON a.place <> b.place AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
