"""Exact distinct counts that can be added up.

A summary keeps, for each of its groups, which ids occurred: one bitmap of 32,768 bits
for each block of ids. Bitmaps are built by a hash aggregate (no Expand, no shuffle of
the ids themselves) and or-ed to coarser groups, so one stored summary answers for
months, quarters, regions and all of them together, where adding up distinct counts
would count an id again in every group. Sums and counts may stand beside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "ids"


def id_bitmaps(df: DataFrame, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """(keys, id_block, ids): the integer ids of each group; null ids do not count."""
    rows = df.filter(F.col(id_col).isNotNull())
    value = F.col(id_col).cast("long")
    return rows.groupBy(*keys, F.bitmap_bucket_number(value).alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITS)
    )


def rolled_up(bitmaps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str | Column], out: str) -> DataFrame:
    """The number of different ids in each group of ``keys``, which may be coarser than
    those of the bitmaps; without keys one row."""
    whole = rolled_up(bitmaps, keys)
    names = whole.columns[: len(keys)]
    return whole.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(out))


def added(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A summary with the ids of more rows: bitmaps of the same keys merged."""
    return rolled_up(old.unionByName(new), keys)


def counts_by_level(bitmaps: DataFrame, levels: Mapping[str, Sequence[Column]], names: Sequence[str], out: str) -> DataFrame:
    """Distinct counts at several levels of one summary: (LEVEL, names, out). A level
    gives one column for each name; null stands for all."""
    found = None
    for level, columns in levels.items():
        keys = [c.alias(n) for c, n in zip(columns, names)]
        rows = distinct_counts(bitmaps, keys, out).select(F.lit(level).alias("LEVEL"), *names, out)
        found = rows if found is None else found.unionByName(rows)
    return found
