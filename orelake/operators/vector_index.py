"""Exact cosine top-k over vectors grouped around centroids.

Vectors are scaled to length one and put into the group of their nearest centroid;
centroids are vectors of the table, chosen by a hash of their ids. A group knows its
radius. By the triangle inequality no vector of a group is nearer to a query than the
centroid's distance less the radius. A search looks into the nearest groups of each
query until they hold k vectors, which bounds the k-th best score, and then only into
groups that may hold something better. Queries are a table that is joined with the
groups, however many there are; nothing but the centroids, a bounded number, goes
through the driver. A group of very many vectors is cut into parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.operators.search import SCORE_DIGITS, best_k

MAX_GROUPS = 2048
PART = 8192  # vectors of a group that one task compares at once
SLACK = 1e-6 + 1e-9  # rounding of scores, and of the arithmetic


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms > 0, norms, 1.0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    path: str
    id_col: str
    id_type: str
    width: int
    centroids: np.ndarray

    @property
    def vectors(self) -> DataFrame:
        """Rows (id, unit, part, grp) by group."""
        kind = f"`{self.id_col}` {self.id_type}, unit array<double>, part long, grp long"
        return self.spark.read.schema(kind).parquet(f"{self.path}/vectors")

    @property
    def groups(self) -> DataFrame:
        """Rows (grp, radius, n, parts)."""
        return self.spark.read.schema("grp long, radius double, n long, parts long").parquet(f"{self.path}/groups")


def build(vectors: DataFrame, id_col: str, vec_col: str, path: str, groups: int | None = None) -> VectorIndex:
    """Write the index of the vectors that are not null, all of one length, below ``path``."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    usable = vectors.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    sizes = usable.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    rows, width = sizes[0], sizes[2] or 0
    if sizes[1] != sizes[2]:
        raise ValueError(f"vectors have from {sizes[1]} to {sizes[2]} components")
    number = groups or max(1, min(MAX_GROUPS, int(rows**0.5)))
    chosen = usable.orderBy(F.xxhash64(id_col), id_col).select("v").limit(min(number, MAX_GROUPS)).collect()  # bounded
    centroids = _unit(np.array([r["v"] for r in chosen], dtype=np.float64).reshape(len(chosen), width))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _unit(_matrix(batch.column("v"), width))
            near = np.argmax(units @ centroids.T, axis=1)
            away = np.linalg.norm(units - centroids[near], axis=1)
            cells = pa.ListArray.from_arrays(np.arange(0, units.size + 1, max(width, 1), dtype=np.int32), units.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), cells, pa.array(away), pa.array(near.astype(np.int64))], names=[id_col, "unit", "away", "grp"]
            )

    placed = usable.mapInArrow(assign, f"`{id_col}` {id_type}, unit array<double>, away double, grp long")
    placed.write.parquet(f"{path}/placed")
    placed = spark.read.schema(placed.schema).parquet(f"{path}/placed")
    sums = placed.groupBy("grp").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
    sums = sums.withColumn("parts", F.ceil(F.col("n") / PART).cast("long"))
    sums.write.parquet(f"{path}/groups")
    index = VectorIndex(spark, path, id_col, id_type, width, centroids)
    parts = placed.join(F.broadcast(index.groups.select("grp", "parts")), "grp")  # at most MAX_GROUPS rows
    part = F.pmod(F.xxhash64(id_col, F.lit(7)), F.col("parts"))
    parts.select(id_col, "unit", part.alias("part"), "grp").repartition("grp", "part").write.partitionBy("grp").parquet(f"{path}/vectors")
    return index


def _reachable(index: VectorIndex, queries: DataFrame, query_id: str, query_vec: str) -> DataFrame:
    """(query, unit, grp, at_most): the best score a query can find in each group."""
    held = index.groups.orderBy("grp").collect()  # at most MAX_GROUPS rows
    numbers = np.array([r["grp"] for r in held], dtype=np.int64)
    radii, centroids, width = np.array([r["radius"] for r in held]), index.centroids[numbers], index.width
    kind = queries.schema[query_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(numbers):
                continue
            units = _unit(_matrix(batch.column("v"), width))
            for i, q in enumerate(units):
                low = np.maximum(np.linalg.norm(centroids - q, axis=1) - radii, 0.0)
                n = len(numbers)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(query_id)[i].as_py()] * n, batch.column(query_id).type), pa.array(numbers),
                     pa.array(1 - low * low / 2)], names=[query_id, "grp", "at_most"],
                )

    asked = queries.select(query_id, F.col(query_vec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    return asked.mapInArrow(run, f"`{query_id}` {kind}, grp long, at_most double")


def _looked(index: VectorIndex, wanted: DataFrame, queries: DataFrame, query_id: str, query_vec: str, k: int) -> DataFrame:
    """The k best of each wanted group part for each query: (query, id, SCORE)."""
    width, id_col = index.width, index.id_col
    asked = queries.select(query_id, F.col(query_vec).cast("array<double>").alias("v"))
    spread = wanted.join(index.groups.select("grp", "parts"), "grp").join(asked, query_id)
    spread = spread.select(F.col("grp").alias("g"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), query_id, "v")
    kinds = queries.schema[query_id].dataType.simpleString()

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column(id_col).combine_chunks()
        names = right.column(query_id).combine_chunks()
        places, hits, scores = [], [], []
        if len(ids) and len(names):
            units = _matrix(left.column("unit").combine_chunks(), width)
            asked = _unit(_matrix(right.column("v").combine_chunks(), width))
            order = np.argsort(np.array(ids.to_pylist()), kind="stable")  # ties go to smaller ids
            for at in range(0, len(asked), 256):
                found = np.round(asked[at : at + 256] @ units[order].T, SCORE_DIGITS)
                best = np.argsort(-found, axis=1, kind="stable")[:, :k]
                places.append(np.repeat(np.arange(at, at + len(found)), best.shape[1]))
                hits.append(order[best].ravel())
                scores.append(np.take_along_axis(found, best, axis=1).ravel())
        empty = np.zeros(0, dtype=np.int64)
        places, hits = (np.concatenate([empty, *x]) for x in (places, hits))
        return pa.table([names.take(pa.array(places)), ids.take(pa.array(hits)), np.concatenate([np.zeros(0), *scores])],
                        names=[query_id, id_col, "SCORE"])

    pairs = index.vectors.groupBy("grp", "part").cogroup(spread.groupBy("g", "p"))
    return pairs.applyInArrow(compare, f"`{query_id}` {kinds}, `{id_col}` {index.id_type}, SCORE double")


def search(index: VectorIndex, queries: DataFrame, k: int, store, query_id: str = "QUERY_ID", query_vec: str = "QUERY_VEC") -> DataFrame:
    """The k best vectors of each query (its id is unique) by cosine, ties to smaller ids.
    ``store(df, name)`` writes a table and reads it back."""
    queries = store(queries.select(query_id, query_vec), "queries")
    reach = store(_reachable(index, queries, query_id, query_vec), "reach")
    order = W.partitionBy(query_id).orderBy(F.col("at_most").desc(), "grp")
    sized = reach.join(F.broadcast(index.groups.select("grp", "n")), "grp")
    before = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1))
    first = sized.withColumn("before", F.coalesce(before, F.lit(0)))
    marked = store(first.select(query_id, "grp", "at_most", (F.col("before") < k).alias("first")), "marked")
    found = store(_looked(index, marked.filter("first").select(query_id, "grp"), queries, query_id, query_vec, k), "first")
    known = best_k(found, query_id, index.id_col, k)
    least = known.groupBy(query_id).agg(F.min("SCORE").alias("least"), F.count(F.lit(1)).alias("held"))
    others = marked.filter("NOT first").join(least, query_id, "left")
    may = (F.coalesce("held", F.lit(0)) < k) | (F.col("at_most") >= F.col("least") - SLACK)
    more = _looked(index, others.filter(may).select(query_id, "grp"), queries, query_id, query_vec, k)
    return best_k(found.unionByName(more), query_id, index.id_col, k)


def passed_over(index: VectorIndex, queries: DataFrame, k: int, store, query_id: str = "QUERY_ID", query_vec: str = "QUERY_VEC") -> float:
    """The share of (query, group) pairs that a search for the k best need not look into."""
    reach = store(_reachable(index, queries, query_id, query_vec), "reach")
    best = search(index, queries, k, store, query_id, query_vec).groupBy(query_id).agg(F.min("SCORE").alias("least"))
    row = reach.join(best, query_id).agg(F.count_if(F.col("at_most") < F.col("least") - SLACK), F.count(F.lit(1))).first()
    return row[0] / row[1] if row[1] else 0.0
