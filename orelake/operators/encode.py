"""Encoders, scalers and train/test splits as column expressions.

Fitting is an aggregate used as a scalar subquery: one row of statistics,
computed by map-side aggregation and read by every task, with no join. All the
statistics a table needs are fitted in one pass (``with_fit``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.operators.ranking import ordinal_cut


def number(c: str) -> Column:
    return F.col(c).cast("double")


def levels_fit(columns: Iterable[str]) -> dict[str, Column]:
    """Sorted distinct values per column. They travel as one array, which suits
    closed vocabularies."""
    return {f"{c}_levels": F.sort_array(F.collect_set(c)) for c in columns}


def standard_fit(columns: Iterable[str]) -> dict[str, Column]:
    return {f"{c}_{n}": f(number(c)) for c in columns for n, f in (("mean", F.avg), ("spread", F.stddev_pop))}


def minmax_fit(columns: Iterable[str]) -> dict[str, Column]:
    return {f"{c}_{n}": f(number(c)) for c in columns for n, f in (("low", F.min), ("high", F.max))}


def with_fit(df: DataFrame, statistics: Mapping[str, Column]) -> DataFrame:
    """Adds ``_fit``, a struct of the statistics over the whole of ``df``."""
    fit = df.agg(F.struct(*[c.alias(n) for n, c in statistics.items()]).alias("f")).scalar()
    return df.withColumn("_fit", fit)


def position_in(levels: Column, c: str) -> Column:
    """0-based position among ``levels``; NULL for NULL and unknown values."""
    at = F.array_position(levels, F.col(c))
    return F.when(at > 0, (at - 1).cast("double"))


def encoded(c: str) -> Column:
    return position_in(F.col(f"_fit.{c}_levels"), c)


def standardised(c: str) -> Column:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    spread = F.col(f"_fit.{c}_spread")
    return (number(c) - F.col(f"_fit.{c}_mean")) / F.when(spread > 0, spread).otherwise(1.0)


def ranged(c: str) -> Column:
    """(x - min) / (max - min); a constant column becomes 0."""
    low = F.col(f"_fit.{c}_low")
    span = F.col(f"_fit.{c}_high") - low
    return (number(c) - low) / F.when(span > 0, span).otherwise(1.0)


def ordinal_encode(df: DataFrame, column: str, out: str, categories: Sequence[str] | None = None) -> DataFrame:
    """0-based position of the value among ``categories``, or among the sorted
    distinct values when none are given."""
    if categories is not None:
        return df.withColumn(out, position_in(F.array(*[F.lit(c) for c in categories]), column))
    return with_fit(df, levels_fit([column])).withColumn(out, encoded(column)).drop("_fit")


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_SCALED") -> DataFrame:
    fitted = with_fit(df, standard_fit(columns))
    return fitted.select(*df.columns, *[standardised(c).alias(c + suffix) for c in columns])


def minmax_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_SCALED") -> DataFrame:
    fitted = with_fit(df, minmax_fit(columns))
    return fitted.select(*df.columns, *[ranged(c).alias(c + suffix) for c in columns])


def hash_split(df: DataFrame, id_col: str, train_pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random-looking split that depends on the ids alone: neither partitioning nor
    the engine changes it."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.filter(bucket < train_pct), df.filter(bucket >= train_pct)


def chrono_split(df: DataFrame, column: str, frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut for training, rows from the cut on for testing."""
    cut = ordinal_cut(df, column, frac)
    return df.filter(F.col(column) < cut), df.filter(F.col(column) >= cut)
