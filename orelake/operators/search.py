"""Batch text search: keyword (BM25), vector (cosine) and hybrid ranking.

Both text searches read a stored index (``search_index``), never the texts. Query
terms come to the postings by broadcast when they are few enough. Each task
keeps its best k hits per query before the last shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.operators import search_index
from orelake.operators.search_index import Index
from orelake.operators.sizing import broadcast_hint

SCORE_DIGITS = 6


def best_k(scored: DataFrame, query_id: str, id_col: str, k: int, digits: int = SCORE_DIGITS) -> DataFrame:
    """The k best documents per query; equal rounded scores go by id."""
    rounded = scored.withColumn("SCORE", F.round("SCORE", digits))
    order = W.partitionBy(query_id).orderBy(F.col("SCORE").desc(), F.col(id_col))
    return (
        rounded.withColumn("RANK", F.row_number().over(order))
        .filter(F.col("RANK") <= k)
        .select(query_id, id_col, "SCORE", F.col("RANK").cast("bigint").alias("RANK"))
    )


def _allowed(id_col: str, attrs: DataFrame | None, where: Column | None) -> DataFrame | None:
    return None if attrs is None or where is None else attrs.filter(where).select(id_col)


def keyword_search(
    index: Index,
    queries: DataFrame,
    k: int,
    query_id: str = "QUERY_ID",
    query_text: str = "QUERY_TEXT",
    attrs: DataFrame | None = None,
    where: Column | None = None,
) -> DataFrame:
    """BM25 top-k per query over the documents whose attributes pass ``where``."""
    terms = search_index.query_terms(queries, query_id, query_text)
    hint = broadcast_hint(terms)  # the weighted terms are no more than these
    weights = search_index.keyword_weights(index, terms, query_id, hint)
    allowed = _allowed(index.id_col, attrs, where)
    found = search_index.scores(index, weights, search_index.KEYWORD, query_id, k, hint, allowed)
    return best_k(found, query_id, index.id_col, k)


def text_vector_search(
    index: Index,
    queries: DataFrame,
    k: int,
    query_id: str = "QUERY_ID",
    query_text: str = "QUERY_TEXT",
    attrs: DataFrame | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Cosine top-k between term vectors: log term frequency for documents, the
    same times inverse document frequency for queries. Document vectors depend
    on their document alone."""
    terms = search_index.query_terms(queries, query_id, query_text)
    hint = broadcast_hint(terms)
    weights = search_index.vector_weights(index, terms, query_id, hint)
    allowed = _allowed(index.id_col, attrs, where)
    found = search_index.scores(index, weights, search_index.VECTOR, query_id, k, hint, allowed)
    return best_k(found.filter(F.col("SCORE") > 0), query_id, index.id_col, k)


def _top_of_batch(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) positions of the k best rows per query; ties go by id."""
    queries, rows = [], []
    for j in range(scores.shape[1]):
        col = scores[:, j]
        pool = np.arange(len(col))
        if len(col) > k:
            pool = np.flatnonzero(col >= np.partition(col, len(col) - k)[len(col) - k])
        best = pool[np.lexsort((ids[pool], -col[pool]))][:k]
        queries.append(np.full(len(best), j))
        rows.append(best)
    return np.concatenate(queries), np.concatenate(rows)


def vector_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    query_id: str = "QUERY_ID",
    query_vec: str = "QUERY_VEC",
    max_queries: int = 4096,
) -> DataFrame:
    """Exact cosine top-k per query vector.

    The query vectors, at most ``max_queries`` at a time, travel with the tasks;
    each Arrow batch is one matrix product that keeps k rows per query. More
    queries than that are handled in blocks, one pass over the vectors each.
    """
    wanted = queries.select(query_id, query_vec)
    count = wanted.count()
    if count > max_queries:
        # Rows are numbered inside hash blocks, so that no block grows with repeated ids.
        blocks = F.lit(-(-count // max_queries))
        numbered = wanted.withColumn("_home", F.pmod(F.xxhash64(query_id), blocks))
        place = F.row_number().over(W.partitionBy("_home").orderBy(query_id))
        numbered = numbered.withColumn("_turn", F.floor((place - 1) / max_queries))
        parts = numbered.select("_home", "_turn").distinct().collect()  # about count / max_queries rows
        found = [
            vector_topk(
                vectors, numbered.filter((F.col("_home") == p["_home"]) & (F.col("_turn") == p["_turn"])),
                k, id_col, vec_col, query_id, query_vec, max_queries,
            )
            for p in parts
        ]
        return reduce(DataFrame.unionByName, found)
    rows = wanted.collect()

    schema = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(id_col, vectors.schema[id_col].dataType),
        T.StructField("SCORE", T.DoubleType()),
    ])
    if not rows:
        return best_k(vectors.sparkSession.createDataFrame([], schema), query_id, id_col, k)

    def unit(m: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norms > 0, norms, 1.0)

    names = np.array([r[0] for r in rows], dtype=object)
    targets = unit(np.array([r[1] for r in rows], dtype="float64"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                ids = pdf[id_col].to_numpy()
                sims = np.round(unit(np.vstack(pdf[vec_col].to_numpy()).astype("float64")) @ targets.T, SCORE_DIGITS)
                q, r = _top_of_batch(ids, sims, k)
                yield pd.DataFrame({query_id: names[q], id_col: ids[r], "SCORE": sims[r, q]})

    usable = vectors.select(id_col, vec_col).filter(F.col(vec_col).isNotNull())
    return best_k(usable.mapInPandas(score, schema), query_id, id_col, k)


def hybrid_search(
    keyword_hits: DataFrame, vector_hits: DataFrame, k: int, query_id: str = "QUERY_ID", id_col: str = "DOC_ID", c: int = 60
) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists."""
    both = keyword_hits.select(query_id, id_col, "RANK").unionByName(vector_hits.select(query_id, id_col, "RANK"))
    fused = both.groupBy(query_id, id_col).agg(F.sum(F.lit(1.0) / (c + F.col("RANK"))).alias("SCORE"))
    return best_k(fused, query_id, id_col, k, digits=9)


def with_attributes(hits: DataFrame, docs: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Ranked hits with the chosen document columns."""
    return hits.join(docs.select(id_col, *columns), id_col, "left")
