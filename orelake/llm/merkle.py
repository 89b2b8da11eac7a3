"""Merkle manifest of a dataset, kept as subtrees in van Emde Boas order.

Every row is a leaf. The leaves of a group stand in order; every two
neighbours are hashed to their parent, a last one without a neighbour alone,
until one node, the group's subroot, remains. The subroots, in order of their
groups, make the dataset's root in the same way.

A tree is cut into aligned subtrees of ``HEIGHT`` levels of edges. A subtree is
one row of the manifest, its nodes side by side in one byte string: the upper
half of its levels first, then each subtree that hangs below, every part split
again at half its height. ``address`` finds a node from depth and number alone, so a
path from leaf to root of a subtree touches few cache lines whatever their size,
and no pointers are stored. The roots of the subtrees are the leaves of the next
level of subtrees, up to the one whose root is the whole tree's.

No task holds more than one subtree and its rows; places come from counts of
sorted ranges, so a group with most of the rows is cut like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import bounded, in_arrow, remainder, stored
from orelake.llm.sql import crc32
from orelake.session import scratch_dir

HEIGHT = 10
STEP = 33  # bytes of a step of a path: the side of the sibling and its digest
ALONE, LEFT, RIGHT = 0, 1, 2

_BLOCK = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("height", pa.int32()), ("n", pa.int32()),
        ("root", pa.binary()), ("nodes", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("presented", pa.list_(pa.binary())),
    ]
)
_BLOCK_DDL = (
    "tree string, block bigint, size bigint, height int, n int, root binary, nodes binary, "
    "doc_ids array<bigint>, presented array<binary>"
)


def hashed(*digests: bytes) -> bytes:
    """SHA-256 of digests as hexadecimal text, one after another."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def address(levels: int, depth: int, number: np.ndarray | int) -> np.ndarray | int:
    """The place of the ``number``-th node at ``depth`` of a complete tree of
    ``levels`` levels in van Emde Boas order."""
    at = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels -= top
        depth -= top
        at = at + (1 << top) - 1 + (number >> depth) * ((1 << levels) - 1)
        number = number & ((1 << depth) - 1)
    return at + 0 * number


def subtree(leaves: list[bytes], height: int) -> np.ndarray:
    """The nodes over ``leaves`` up to ``height`` levels above, one a row, in their
    places; places of a complete tree that have no node are zero."""
    nodes = np.zeros(((2 << height) - 1, 32), dtype=np.uint8)
    for depth in range(height, -1, -1):
        at = address(height + 1, depth, np.arange(len(leaves)))
        nodes[at] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32)
        leaves = [hashed(*leaves[i : i + 2]) for i in range(0, len(leaves), 2)]
    return nodes


def steps(nodes: np.ndarray, n: int, height: int) -> np.ndarray:
    """For each of the ``n`` leaves, the steps (side, sibling) from it to the subtree's root."""
    out = np.zeros((n, height, STEP), dtype=np.uint8)
    for up in range(height):
        number = np.arange(n) >> up
        other = number ^ 1
        there = other <= (n - 1) >> up
        out[:, up, 0] = np.where(there, np.where(number & 1, LEFT, RIGHT), ALONE)
        out[there, up, 1:] = nodes[address(height + 1, height - up, other[there])]
    return out


def siblings(path: bytes) -> bytes:
    """The digests of a path, from the leaf upwards."""
    return b"".join(path[i + 1 : i + STEP] for i in range(0, len(path), STEP) if path[i] != ALONE)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings on its path lead to."""
    for i in range(0, len(path), STEP):
        side, other = path[i], path[i + 1 : i + STEP]
        leaf = hashed(leaf) if side == ALONE else hashed(other, leaf) if side == LEFT else hashed(leaf, other)
    return leaf


def field(value: Column) -> Column:
    """A value in a leaf: ``-`` for null, else its UTF-8 length in bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _joined(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """The inner join on ``names``, where null equals null."""
    right = right.withColumnsRenamed({n: f"_{n}" for n in names})
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    return left.join(right, same).drop(*[f"_{n}" for n in names])


def placed(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves`` with ``place``, their number within their ``tree`` from 0 in the given
    order, and ``size``, the number of leaves of the tree. Rows are sorted in ranges
    and stored; a place is the row's own number in its range after the counts of
    the ranges before."""
    in_ranges = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = stored(in_ranges.withColumn("row", F.monotonically_increasing_id()), "leaves")
    rows = rows.withColumn("part", F.shiftright("row", 33))
    runs = rows.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("tree").orderBy("part")) - F.col("n")
    runs = bounded(
        runs.withColumn("before", before - F.col("first")).withColumn("size", F.sum("n").over(W.partitionBy("tree")))
    )
    numbered = _joined(rows, runs.drop("first", "n"), "tree", "part")
    return numbered.select(*leaves.columns, (F.col("row") + F.col("before")).alias("place"), "size")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """The subtrees over ``nodes`` (tree, place, size, digest, doc_id, presented)."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place").to_pydict()
        size, n = rows["size"][0], len(rows["place"])
        levels = height if size > 1 << height else (size - 1).bit_length()
        nodes = subtree(rows["digest"], levels)
        ids, presented = (rows[c] if c in rows else None for c in ("doc_id", "presented"))
        row = [rows["tree"][0], rows["place"][0] >> height, size, levels, n, nodes[0].tobytes(), nodes.tobytes(), ids, presented]
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCK.types)], schema=_BLOCK)

    cut = nodes.withColumn("block", F.shiftright("place", height))
    return cut.groupBy("tree", "block").applyInArrow(build, _BLOCK_DDL)


def _levels(spark: SparkSession, nodes: DataFrame, path: str, height: int) -> int:
    """Write the subtrees of all levels below ``path``; the number of levels."""
    level = 0
    while True:
        at = f"{path}/level={level}"
        _blocks(nodes, height).write.option("compression", "none").parquet(at)
        level += 1
        higher = spark.read.schema(_BLOCK_DDL).parquet(at).filter(F.col("size") > 1 << height)
        nodes = higher.select(
            "tree", F.col("block").alias("place"), (F.shiftright(F.col("size") - 1, height) + 1).alias("size"),
            F.col("root").alias("digest"),
        )
        if nodes.isEmpty():
            return level


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema(_BLOCK_DDL).parquet(f"{path}/level={level}")


def write_manifest(leaves: DataFrame, path: str, height: int = HEIGHT) -> tuple[int, int]:
    """Write the manifest of ``leaves`` (doc_id, tree, leaf, presented) below ``path``;
    the numbers of levels of its group trees and of the tree over their subroots.

    Leaves of a tree stand in order of doc_id (null first), rows that share an id in
    order of their digests; equal rows are leaves of their own. A null tree is a
    group like any other, before all others. ``presented`` is a leaf to be verified
    in place of the stored one, null for the stored one."""
    spark = leaves.sparkSession
    nodes = placed(leaves.select("doc_id", "tree", "leaf", "presented"), "doc_id", "leaf")
    groups = _levels(spark, nodes.withColumnRenamed("leaf", "digest"), f"{path}/groups", height)
    subroots = [_level(spark, f"{path}/groups", k).filter(F.col("size") <= 1 << height) for k in range(groups)]
    tops = reduce(DataFrame.unionByName, [s.select(F.col("tree").alias("name"), F.col("root").alias("digest")) for s in subroots])
    named = placed(tops.select(F.lit("").alias("tree"), "name", "digest"), "name").withColumnRenamed("name", "group")
    stored_names = stored(named, "names")
    stored_names.write.parquet(f"{path}/names")
    return groups, _levels(spark, stored_names.drop("group"), f"{path}/roots", height)


_PATHS_DDL = "tree string, block bigint, path binary, subroot binary, top binary"


def _below(blocks: DataFrame, height: int) -> DataFrame:
    """(tree, block, path, subroot, top) of the subtrees that hang below ``blocks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                paths = [s.tobytes() + row["path"] for s in steps(nodes, n, row["height"])]
                first = row["block"] << height
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                     pa.array(paths, pa.binary()), pa.array([row["subroot"]] * n, pa.binary()),
                     pa.array([row["top"]] * n, pa.binary())],
                    names=["tree", "block", "path", "subroot", "top"],
                )

    return in_arrow(blocks.select("tree", "block", "height", "n", "nodes", "path", "subroot", "top"), run, _PATHS_DDL)


def _with_paths(spark: SparkSession, path: str, levels: int, above: DataFrame, height: int) -> DataFrame:
    """The subtrees of level 0 with the path from their root to the top. ``above``
    has (tree, path, top): the path beyond each tree's own root."""
    paths = None
    for k in range(levels - 1, -1, -1):
        blocks = _level(spark, path, k)
        whole = blocks.filter(F.col("size") <= 1 << height).withColumn("subroot", F.col("root"))
        found = _joined(whole, above, "tree")
        if paths is not None:
            parts = blocks.filter(F.col("size") > 1 << height)
            found = found.unionByName(_joined(parts, paths, "tree", "block"))
        if k == 0:
            return found
        paths = stored(_below(found, height), f"paths{k}")
    raise ValueError("a manifest has one level or more")


_PROOF_DDL = "doc_id bigint, leaf binary, subroot binary, top binary, proof binary, folded binary"


def proofs(spark: SparkSession, path: str, levels: tuple[int, int], height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, top, proof, folded) of every leaf, read back from the
    manifest: ``proof`` is the siblings from leaf to root, ``folded`` the root that the
    presented leaf and these siblings lead to."""
    single = _level(spark, f"{path}/roots", levels[1] - 1).select("tree", F.unhex(F.lit("")).alias("path"), F.col("root").alias("top"))
    rooted = _with_paths(spark, f"{path}/roots", levels[1], single, height)
    # A step down from the top tree leads to the groups' own roots, by their place.
    names = spark.read.parquet(f"{path}/names").select(F.col("group").alias("tree"), F.col("place").alias("block"))
    upper = stored(_below(rooted, height).drop("tree", "subroot").join(names, "block").select("tree", "path", "top"), "above")
    blocks = _with_paths(spark, f"{path}/groups", levels[0], upper, height)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, levels = row["n"], row["height"]
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                leaves = [x.tobytes() for x in nodes[address(levels + 1, levels, np.arange(n))]]
                paths = [s.tobytes() + row["path"] for s in steps(nodes, n, levels)]
                ends = [folded(given or leaf, p) for given, leaf, p in zip(row["presented"], leaves, paths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(leaves, pa.binary()),
                     pa.array([row["subroot"]] * n, pa.binary()), pa.array([row["top"]] * n, pa.binary()),
                     pa.array([siblings(p) for p in paths], pa.binary()), pa.array(ends, pa.binary())],
                    names=["doc_id", "leaf", "subroot", "top", "proof", "folded"],
                )

    chosen = blocks.select("height", "n", "nodes", "doc_ids", "presented", "path", "subroot", "top")
    return in_arrow(chosen, run, _PROOF_DDL)


def proof_of(spark: SparkSession, path: str, levels: tuple[int, int], doc_id: int, height: int = HEIGHT) -> bytes | None:
    """The path (steps of side and sibling) of the first leaf of ``doc_id``, from one
    subtree of each level; None for an id that has no leaf."""

    def climb(row: dict, number: int, at: str, top: int) -> Iterator[bytes]:
        for level in range(top):
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
            yield steps(nodes, row["n"], row["height"])[number].tobytes()
            if row["size"] <= 1 << height:
                return
            number, block = row["block"] & ((1 << height) - 1), row["block"] >> height
            held = _level(spark, at, level + 1).filter(F.col("block") == block)
            row = held.filter(F.col("tree").eqNullSafe(F.lit(row["tree"]).cast("string"))).first().asDict()

    held = _level(spark, f"{path}/groups", 0).filter(F.array_contains("doc_ids", F.lit(doc_id))).orderBy("tree", "block").first()
    if held is None:
        return None
    inner = list(climb(held.asDict(), held["doc_ids"].index(doc_id), f"{path}/groups", levels[0]))
    name = spark.read.parquet(f"{path}/names").filter(F.col("group").eqNullSafe(F.lit(held["tree"]).cast("string"))).first()
    block = _level(spark, f"{path}/roots", 0).filter(F.col("block") == name["place"] >> height).first().asDict()
    return b"".join(inner + list(climb(block, name["place"] & ((1 << height) - 1), f"{path}/roots", levels[1])))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, presented) of documents. Those whose crc32 of the id is a
    multiple of 7 are presented with ``n_chars`` one greater; a null stays null."""
    altered = leaf_of(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    tampered = (remainder("doc_id", 7) == 0) & F.col("n_chars").isNotNull()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("tree"),
        leaf_of(*[F.col(c) for c in FIELDS]).alias("leaf"), F.when(tampered, altered).alias("presented"),
    )


def verified(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per row of ``docs``: the digests and proof of its leaf, the root that the row as
    presented folds to, and whether this is the manifest's root. Without rows, nothing."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark, 'llm')}/manifest"
    found = proofs(spark, path, write_manifest(document_leaves(docs), path, height), height)
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "top", "folded")}
    return found.select(
        "doc_id", text["leaf"].alias("leaf"), text["subroot"].alias("subroot"), text["top"].alias("root"),
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("top")).alias("verified"),
    )


def _oracle() -> str:
    def field(name: str) -> str:
        return f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""{name}(tree, up, place, size, digest) AS (
            SELECT tree, 0, place, size, digest FROM {leaves}
            UNION ALL
            SELECT tree, up + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
            FROM {name} WHERE size > 1 GROUP BY tree, up, place // 2)"""

    def fold(name: str, start: str, nodes: str) -> str:
        return f"""{name}(id, tree, up, place, size, digest, proof) AS (
            SELECT id, tree, 0, place, size, digest, proof FROM {start}
            UNION ALL
            SELECT f.id, f.tree, f.up + 1, f.place // 2, (f.size + 1) // 2, sha256(CASE WHEN s.digest IS NULL THEN f.digest
                WHEN f.place % 2 = 1 THEN s.digest || f.digest ELSE f.digest || s.digest END), f.proof || coalesce(s.digest, '')
            FROM {name} f LEFT JOIN {nodes} s
                ON s.tree IS NOT DISTINCT FROM f.tree AND s.up = f.up AND s.place = xor(f.place, 1) WHERE f.size > 1)"""

    return f"""
    WITH RECURSIVE digests AS (
        SELECT doc_id, lang AS tree, {leaf("n_chars")} AS digest,
            CASE WHEN ({crc32("doc_id::VARCHAR")}) % 7 = 0 THEN {leaf("(n_chars + 1)")} END AS altered FROM documents),
    leaves AS (
        SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY tree) AS size,
            row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM digests),
    {tree("nodes", "leaves")},
    subroots AS (
        SELECT '' AS tree, tree AS name, digest, count(*) OVER () AS size, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place
        FROM nodes WHERE size = 1),
    {tree("tops", "subroots")},
    presented AS (SELECT id, tree, place, size, coalesce(altered, digest) AS digest, '' AS proof FROM leaves),
    {fold("inner_fold", "presented", "nodes")},
    between AS (
        SELECT f.id, s.tree, s.place, s.size, f.digest, f.proof FROM inner_fold f
        JOIN subroots s ON s.name IS NOT DISTINCT FROM f.tree WHERE f.size = 1),
    {fold("outer_fold", "between", "tops")}
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(o.proof) AS proof_sha256,
        o.digest AS folded_root, o.digest = t.digest AS verified
    FROM leaves l JOIN subroots s ON s.name IS NOT DISTINCT FROM l.tree JOIN outer_fold o ON o.id = l.id AND o.size = 1
    JOIN tops t ON t.size = 1
    """


ORACLE = _oracle()
