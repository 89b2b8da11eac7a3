"""Connected components of a graph that no task and no driver holds whole.

Edges are rewritten by alternating large-star and small-star steps until each
component is a star around its smallest node. A step is one min-aggregate,
combined on the map side, and one join, so a node with a third of all edges is
only a skewed join key. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(both[0].alias("n")).agg(F.least(F.min(both[1]), F.first(both[0])).alias("m"))
    return edges.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("n", "m")).filter(F.col("a") != F.col("b"))


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns, any order) that has a
    link to another node; root is the smallest node it can reach. Links to itself
    and links with a null end are ignored."""
    a, b = (F.col(f"`{c}`") for c in links.columns)
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = stored(edges.filter(a.isNotNull() & b.isNotNull() & (F.col("a") != F.col("b"))).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        state = now
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
