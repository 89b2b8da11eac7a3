"""Partitioned tables of which a step replaces only the partitions it touched.

Every step writes the new content of its partitions to a folder of its own and then a
manifest that says, for each partition, which step wrote what is current. Readers
open what the latest manifest names, so a table changes at one moment, a step that
failed halfway shows nothing, and its repetition replaces what it left.
A partition that has lost all its rows stays in the manifest without data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.sources.sinks import holds_files

MANIFEST = "part string, version long, filled boolean"


def current_parts(spark: SparkSession, path: str, before: int | None = None) -> dict[str, int | None]:
    """The step that wrote each partition, None where it is empty; as of the last
    step, or the last one before ``before``. One entry per partition."""
    if not holds_files(spark, f"{path}/manifest"):
        return {}
    steps = spark.read.schema(f"{MANIFEST}, step long").parquet(f"{path}/manifest")
    if before is not None:
        steps = steps.filter(F.col("step") < before)
    last = steps.agg(F.max("step")).first()[0]
    rows = steps.filter(F.col("step") == last).collect() if last is not None else []
    return {r["part"]: r["version"] if r["filled"] else None for r in rows}


def read_parts(
    spark: SparkSession, path: str, like: DataFrame, by: str, only: set[str] | None = None, before: int | None = None
) -> DataFrame:
    """The current rows, in the shape of ``like``, of all partitions or of those named."""
    found = current_parts(spark, path, before)
    chosen = [
        f"{path}/data/version={v}/{by}={p}" for p, v in sorted(found.items()) if v is not None and (only is None or p in only)
    ]
    if not chosen:
        return spark.createDataFrame([], like.schema)
    rows = spark.read.schema(like.schema).option("basePath", f"{path}/data").parquet(*chosen)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


def replace_parts(df: DataFrame, path: str, by: str, touched: set[str], step: int) -> None:
    """Make ``df``, whose ``by`` (string) lies within ``touched``, the content of these
    partitions. Step numbers rise; the last one may be repeated."""
    spark = df.sparkSession
    target = f"{path}/data/version={step}"
    df.repartition(by).write.partitionBy(by).mode("overwrite").parquet(target)
    written = spark.read.schema(df.schema).parquet(target).select(by).distinct().collect()  # partitions, not rows
    filled = {r[0] for r in written}
    parts = current_parts(spark, path, before=step)
    parts |= {p: step if p in filled else None for p in touched}
    rows = [(p, v if v is not None else step, v is not None) for p, v in sorted(parts.items())]
    manifest = spark.createDataFrame(rows, MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/step={step}")


def drop_unused(spark: SparkSession, path: str) -> list[int]:
    """Delete the folders of steps that the latest manifest does not name."""
    used = {v for v in current_parts(spark, path).values() if v is not None}
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version=") and int(name.removeprefix("version=")) not in used:
            fs.delete(status.getPath(), True)
            gone.append(int(name.removeprefix("version=")))
    return sorted(gone)
