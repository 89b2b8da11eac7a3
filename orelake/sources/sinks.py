"""Writing, appending, exporting and reconciling tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.operators.history import as_ntz
from orelake.operators.ranking import sequence_ids


def save(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Save as a catalog table."""
    df.write.format(fmt).mode(mode).saveAsTable(name)


def append_with_defaults(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, Column] | None = None,
    key: str | None = None,
    start: int | Column = 1,
) -> DataFrame:
    """Rows in the declared shape, ready to append.

    Columns the rows lack take their default or NULL. The surrogate key counts up
    from ``start`` as a function of the rows, not of their partitions, so a
    recomputed task gives the same keys; take one past the largest key so far for
    the next append.
    """
    defaults = defaults or {}
    given = set(df.columns) | {key}
    if key is not None:
        df = sequence_ids(df.drop(key), [c for c in df.columns if c != key], key, start)

    def value(f: T.StructField) -> Column:
        if f.name in given:
            c = F.col(f.name)
        else:
            c = defaults.get(f.name, F.lit(None))
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[value(f) for f in schema.fields])


def append_and_reconcile(df: DataFrame, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Append to the table at ``path`` and report its row counts before and after."""
    spark = df.sparkSession
    stored = spark.read.schema(df.schema).format(fmt)

    def counted(phase: str) -> list:
        return [(phase, table, stored.load(path).count())]

    before = counted("BEFORE")
    df.write.format(fmt).mode("append").save(path)
    return spark.createDataFrame(before + counted("AFTER"), "PHASE string, TABLE_NAME string, ROW_COUNT long")


def export(df: DataFrame, path: str, columns: Sequence[str | Column], exported_at=None, fmt: str = "parquet") -> DataFrame:
    """Write the chosen columns with an EXPORTED_AT stamp; returns the stored table."""
    stamp = as_ntz(exported_at if exported_at is not None else F.current_timestamp())
    df.select(*columns, stamp.alias("EXPORTED_AT")).write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)


def holds_files(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target) and len(fs.listStatus(target)) > 0


def publish_snapshot(df: DataFrame, path: str, version: int, published_at=None) -> None:
    """Write one immutable version of a table, then its manifest row.

    The data comes first, so a version is visible only once it is complete. What
    a failed attempt left is replaced; a version in the manifest is refused.
    """
    if holds_files(df.sparkSession, f"{path}/manifest/version={version}"):
        raise ValueError(f"version {version} of {path} has been published")
    df.write.mode("overwrite").parquet(f"{path}/data/version={version}")
    stamp = as_ntz(published_at if published_at is not None else F.current_timestamp())
    row = df.sparkSession.range(1).select(stamp.alias("PUBLISHED_AT"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def snapshot_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest").select(F.col("version").cast("long"), "PUBLISHED_AT")


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A published version, the latest unless one is named."""
    if version is None:
        version = snapshot_versions(spark, path).agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/data/version={version}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """TABLE_NAME and ROW_COUNT of each table, sorted by name."""
    counts = [df.agg(F.lit(n).alias("TABLE_NAME"), F.count(F.lit(1)).alias("ROW_COUNT")) for n, df in tables.items()]
    return reduce(DataFrame.unionAll, counts).orderBy("TABLE_NAME")


def list_tables(spark: SparkSession, schemas: Sequence[str] | None = None) -> DataFrame:
    """Schema, name and type of the catalog's tables, sorted."""
    found = [
        (".".join(t.namespace or []), t.name, t.tableType)
        for s in (schemas or [d.name for d in spark.catalog.listDatabases()])
        for t in spark.catalog.listTables(s)
    ]
    return spark.createDataFrame(found, "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string").orderBy(
        "TABLE_SCHEMA", "TABLE_NAME"
    )
