"""Nested JSON as variants: paths into objects and arrays, one row per array element."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_variant(df: DataFrame, column: str, out: str = "v") -> DataFrame:
    """``df`` with the JSON text of ``column`` as a variant; what is no JSON is null."""
    return df.withColumn(out, F.try_parse_json(F.col(column)))


def at_path(df: DataFrame, variant: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each field: the value at its path, of its type; null where
    the path leads nowhere or the value is of another type."""
    return df.withColumns({name: F.try_variant_get(variant, path, kind) for name, (path, kind) in fields.items()})


def elements(df: DataFrame, variant: str, path: str, fields: Mapping[str, tuple[str, str]], keep: list[str], place: str = "POS") -> DataFrame:
    """One row per element of the array (or member of the object) at ``path``: the kept
    columns, the element's place, counted from 0, and the values at paths inside it.
    Rows without such an array give none."""
    spark: SparkSession = df.sparkSession
    inner = df.select(*keep, F.try_variant_get(variant, path, "variant").alias("_inner"))
    rows = spark.sql("SELECT d.*, e.pos AS _pos, e.value AS _element FROM {d} d, LATERAL variant_explode(d._inner) e", d=inner)
    named = at_path(rows, "_element", fields)
    return named.select(*keep, F.col("_pos").cast("long").alias(place), *fields)
