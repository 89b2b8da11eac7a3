"""SimHash near-dedup with a pivot distance table.

Every text becomes a 64-bit fingerprint. Fingerprints link where at most
``RADIUS`` bits differ; components of links are groups of near duplicates.

The join works on distinct fingerprints. Two of them that differ in at most two
bits agree on all but two of any blocks of bits, so candidates meet on masked
fingerprints (how many blocks follows from the number of fingerprints, which
keeps a mask's groups small). For each candidate pair the distances to many
reference fingerprints, computed once per fingerprint, are compared: if they
differ by more than the radius in any coordinate, the triangle inequality rules
the pair out; survivors are verified bit by bit.

A large group of near copies would make a mask's group quadratic. Members of a
group above ``DENSE`` take another exact way: each fingerprint is sent to itself
and its 64 one-bit neighbours. Two fingerprints differ in at most two bits
exactly if they meet at one of these points, and all that meet there are linked
with one another, so each is joined with the smallest only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import as_bytes, bounded, in_arrow, stored, text_slices
from orelake.llm.components import connected

RADIUS = 2
SHINGLE = 3
REFERENCES = 16
DENSE = 64
SEED = 42


def fingerprint(text: bytes) -> int:
    """The SimHash of a text as an unsigned 64-bit integer; no words: zero."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        octets = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) for every row. Null texts and texts without words have 0."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = np.array([fingerprint(t) for t in as_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return in_arrow(source, run, f"doc_id {kind}, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(n: int, bits: int = 64) -> list[int]:
    """Masks of which any two fingerprints within the radius agree on one at least,
    wide enough that ``n`` random fingerprints seldom share a masked value."""
    blocks = next((b for b in range(RADIUS + 1, 9) if bits * (b - RADIUS) // b >= log2(max(n, 2))), 8)
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << j for j in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(parts, blocks - RADIUS)]


def references(count: int = REFERENCES) -> list[int]:
    """Reference fingerprints: fixed pseudo-random 64-bit values."""
    return [_signed(xxhash.xxh64_intdigest(str(i).encode(), 7)) for i in range(count)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(classes: DataFrame, n: int, dense: int = DENSE) -> DataFrame:
    """(a, b) node pairs that connect all fingerprints within the radius.

    ``classes`` has one row (fp, node) per fingerprint.
    """
    to_references = F.array(*[_distance(F.col("fp"), F.lit(r)).cast("tinyint") for r in references()])
    masked = [
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
        for i, m in enumerate(block_masks(n))
    ]
    rows = classes.select("fp", "node", F.inline(F.array(*masked)))
    sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    met = stored(rows.join(sizes, ["mask", "value"]), "masked")

    small = met.filter(F.col("size") <= dense).select("mask", "value", "fp", "node", to_references.alias("d"))
    left = small.select("mask", "value", *[F.col(c).alias(f"{c}_a") for c in ("fp", "node", "d")])
    right = small.select("mask", "value", *[F.col(c).alias(f"{c}_b") for c in ("fp", "node", "d")])
    apart = F.array_max(F.zip_with("d_a", "d_b", lambda x, y: F.abs(x - y)))
    survivors = left.join(right, ["mask", "value"]).filter((F.col("fp_a") < F.col("fp_b")) & (apart <= RADIUS))
    pairs = survivors.filter(_distance(F.col("fp_a"), F.col("fp_b")) <= RADIUS).select("node_a", "node_b")

    crowd = met.filter(F.col("size") > dense).select("fp", "node").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    points = crowd.select("node", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("point"))
    meeting = points.groupBy("point").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("size"))
    starred = points.join(meeting.filter(F.col("size") > 1), "point").select("node", "least")
    return pairs.union(starred.filter(F.col("node") != F.col("least")).distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dense: int = DENSE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links, the row's own included.
    Rows without words share fingerprint zero. A null id is returned as it is,
    joins groups by its fingerprint and never names one: a group of null ids only
    has a null component. Repeated rows and ids each keep a row.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    named = classes.filter(F.col("node").isNotNull())
    roots = connected(near_links(named, named.count(), dense))
    ids = classes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Of rows that share the kept id the one with the least digest of all its columns
    stays, whatever task reads it; rows with a null id cannot be told apart from
    others and stay.
    """
    groups = near_groups(docs, id_col, text_col)
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.join(kept, id_col, "left_semi").select(*[f"`{c}`" for c in docs.columns])
    nameless = docs.filter(F.col(id_col).isNull())
    digest = F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in docs.columns]), {"ignoreNullFields": "false"}), 256)
    repeated = docs.groupBy(F.col(id_col).alias("__llm_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND __llm_id IS NOT NULL")
    repeated = stored(repeated.select("__llm_id"), "repeated")
    if repeated.isEmpty():
        return named.unionByName(nameless)
    marked = named.join(bounded(repeated), F.col(id_col) == F.col("__llm_id"), "left")
    several = marked.filter(F.col("__llm_id").isNotNull()).drop("__llm_id").withColumn("__llm_digest", digest)
    least = several.groupBy(F.col(id_col).alias("__llm_id")).agg(F.min("__llm_digest").alias("__llm_least"))
    same = (F.col(id_col) == F.col("__llm_id")) & (F.col("__llm_digest") == F.col("__llm_least"))
    one = several.join(least, same).drop("__llm_id", "__llm_digest", "__llm_least").dropDuplicates([id_col])
    alone = marked.filter(F.col("__llm_id").isNull()).drop("__llm_id")
    return alone.unionByName(one).unionByName(nameless)
