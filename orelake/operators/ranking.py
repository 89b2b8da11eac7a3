"""Top-k, ordinal cuts, exact medians and sequence ids without a global window.

A window with no partition key runs in one task. Each operator here first
reduces the data to a small set of distinct values or buckets, ranks that, and
brings the answer back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_by_dense_rank(df: DataFrame, value: str, k: int, rank_name: str) -> DataFrame:
    """Rows whose ``value`` is among the k largest distinct ones, ties kept.

    The distinct values are cut to k before they are numbered, so the only
    unpartitioned window sees at most k rows however many rows tie.
    """
    best = df.select(value).filter(F.col(value).isNotNull()).distinct().orderBy(F.col(value).desc()).limit(k)
    ranks = best.select(
        F.col(value).alias("_value"),
        F.dense_rank().over(W.orderBy(F.col(value).desc())).cast("bigint").alias(rank_name),
    )
    return df.join(ranks, F.col(value) == F.col("_value")).drop("_value")


def ordinal_cut(df: DataFrame, column: str, frac: float) -> Column:
    """Scalar: the distinct value of ``column`` at position int(n * frac) when sorted.

    NULL is no value. The distinct values are counted and sorted in a distributed
    way; only the one at the position is taken.
    """
    keys = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return keys.orderBy(column).offset(int(keys.count() * frac)).limit(1).scalar()


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, bucket_width: int = 100) -> DataFrame:
    """Exact median of a decimal column per group, by counting.

    Values are counted per (group, value), which shrinks a hot group on the map
    side. Bucket counts then locate the one or two middle positions, and only
    the buckets holding them are ranked value by value. Groups whose values
    are all NULL are not returned.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.floor(F.col(value) / bucket_width))
    )
    buckets = counted.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bn"))
    by_bucket = W.partitionBy(*keys).orderBy("_bucket")
    whole = W.partitionBy(*keys)
    placed = buckets.select(
        *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_gb"),
        (F.sum("_bn").over(by_bucket.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_bn")).alias("_below"),
        F.col("_bn"),
        F.sum("_bn").over(whole).alias("_total"),
    )
    lower = F.floor((F.col("_total") + 1) / 2)  # 1-based middle positions
    upper = F.floor(F.col("_total") / 2) + 1
    middle = placed.filter((upper > F.col("_below")) & (lower <= F.col("_below") + F.col("_bn")))
    same = F.col("_bucket") == F.col("_gb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    inside = W.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counted.join(middle, same).withColumn("_last", F.col("_below") + F.sum("_n").over(inside))
    first = F.col("_last") - F.col("_n") + 1
    low = F.max(F.when((first <= lower) & (lower <= F.col("_last")), F.col(value)))
    high = F.max(F.when((first <= upper) & (upper <= F.col("_last")), F.col(value)))
    return ranked.groupBy(*keys).agg(((low + high) / 2).alias(out))


def sequence_ids(df: DataFrame, key: Sequence[str], out: str, start: int | Column = 1, per_bucket: int = 50_000) -> DataFrame:
    """Unique ids counting up from ``start``, a pure function of the data.

    Rows are numbered inside hash buckets of ``key`` (which must be unique), and
    every bucket takes its own residue class, so no bucket has to know the size
    of another. Even buckets make the ids nearly consecutive; like those of any
    sequence, they may have gaps. There are as many buckets as hold about
    ``per_bucket`` rows each, so the largest task does not grow with the table.
    """
    buckets = df.agg(F.ceil(F.count(F.lit(1)) / per_bucket + 1)).scalar()
    bucket = F.pmod(F.xxhash64(*key), buckets)
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(*key))
    begin = start if isinstance(start, Column) else F.lit(start)
    return (
        df.withColumn("_bucket", bucket)
        .withColumn(out, (begin + (place - 1) * buckets + F.col("_bucket")).cast("bigint"))
        .drop("_bucket")
    )


def random_numbers(df: DataFrame, key: Sequence[str], out: str, seed: int = 42, per_range: int = 50_000) -> DataFrame:
    """The numbers 1 to n in random order, a function of ``key`` (which must be unique)
    and the seed alone, however the rows are partitioned.

    Rows stand in the order of the md5 of seed and key. Its values are cut into equal
    ranges of about ``per_range`` rows; ranges are counted, the counts of those before
    are added up, and rows are numbered inside their range. Only the counts meet in one
    task.
    """
    digits = 0
    rows = df.count()
    while rows > per_range << 4 * digits:
        digits += 1
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    drawn = df.withColumn("_draw", draw).withColumn("_range", F.substring("_draw", 1, digits) if digits else F.lit(""))
    counts = drawn.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_range")) - F.col("_n")
    starts = counts.select("_range", before.alias("_before"))  # 16 ** digits rows, about n / per_range
    place = F.row_number().over(W.partitionBy("_range").orderBy("_draw", *key))
    return (
        drawn.join(starts, "_range")
        .withColumn(out, (F.col("_before") + place).cast("bigint"))
        .drop("_draw", "_range", "_before")
    )
