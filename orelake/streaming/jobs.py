"""Structured Streaming jobs: file ingest, change streams, enrichment.

Each job processes what has arrived and stops (``availableNow``). The
checkpoint is the offset, so a run with nothing new starts no batch. Batch
output goes to a folder named by the batch id and is written with overwrite:
a batch replayed after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orelake.operators.history import CHANGE_COLUMNS, COMMIT, COMMITTED_AT, scd2_from_log
from orelake.plans.metrics import daily_order_metrics, order_images, support_ticket_metrics
from orelake.plans.silver import orders_cleaned, orders_enriched
from orelake.schemas import Feed
from orelake.sources.files import CSV_OPTIONS, blank_nulls, load_log, raw_schema, typed_rows
from orelake.sources.sinks import holds_files


def run_available(source: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``fn(batch, batch_id)`` over what the source has that is new, then stop."""
    query = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def skip_existing(source: DataFrame, checkpoint: str) -> StreamingQuery:
    """Start a stream at the present: what the source already holds is marked as
    seen without being processed."""
    return run_available(source, lambda batch, batch_id: None, checkpoint)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def ingest_stream(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    feed: Feed,
    loaded_at: datetime | str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Load newly arrived CSV files of a feed, each file once.

    Accepted rows go to ``dst/data``, rejected ones to ``dst/rejected``, and
    per-file counts to ``dst/log``.
    """
    raw = (
        spark.readStream.schema(raw_schema(feed.schema))
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", max_files)
        .csv(src)
        .withColumn("SOURCE_FILE", F.col("_metadata.file_path"))
    )
    rows = typed_rows(blank_nulls(raw, feed.schema.fieldNames()), feed, loaded_at)

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch.filter(~F.col("REJECTED")).drop("REJECTED"), f"{dst}/data", batch_id)
            write_batch(batch.filter("REJECTED").drop("REJECTED"), f"{dst}/rejected", batch_id)
            write_batch(load_log(batch, feed.name), f"{dst}/log", batch_id)
        finally:
            batch.unpersist()

    return run_available(rows, load, checkpoint)


def change_source(spark: SparkSession, src: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Change files (row images with ``_action`` and ``_is_update``) as a stream. A feed
    without ``_commit`` or ``_committed_at`` gets the time its file landed, which does
    not change when a batch is replayed."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src)
    landed = F.col("_metadata.file_modification_time")
    given = {COMMIT: F.unix_micros(landed), COMMITTED_AT: landed.cast("timestamp_ntz")}
    return files.select("*", *[value.alias(name) for name, value in given.items() if name not in files.columns])


def change_log_stream(source: DataFrame, key: str, log: str, checkpoint: str) -> StreamingQuery:
    """Append every batch of change images to a log that ``scd2_from_log`` reads as
    type 2 history. Nothing already written is touched:
    batches are numbered by the checkpoint, so a log that others have filled is
    refused to a new one."""
    spark = source.sparkSession
    if holds_files(spark, log) and not holds_files(spark, checkpoint):
        raise ValueError(f"{log} holds a log, but {checkpoint} is new and would number its batches from 0 again")

    def append(batch: DataFrame, batch_id: int) -> None:
        # A commit may go on in the next batch, so its images are kept, not folded.
        write_batch(batch, log, batch_id)

    return run_available(source, append, checkpoint)


def read_change_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log).drop("batch_id")


def order_history_stream(source: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    return change_log_stream(order_images(source), "ORDER_ID", log, checkpoint)


def daily_metrics_stream(source: DataFrame, log: str, daily: str, checkpoint: str) -> StreamingQuery:
    """Order changes to the log and, after each batch, the daily metrics of the months it
    touched: only orders that ever stood in such a month are looked at, and only those
    months' partitions of the stored table are replaced. A month that has lost all its
    orders keeps a row of zero, which ``read_daily`` passes over."""
    spark = source.sparkSession
    if holds_files(spark, log) and not holds_files(spark, checkpoint):
        raise ValueError(f"{log} holds a log, but {checkpoint} is new and would number its batches from 0 again")

    def month(c: str) -> Column:
        return F.trunc(F.col(c).cast("date"), "month")

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, log, batch_id)
        touched = spark.read.parquet(f"{log}/batch_id={batch_id}").select(month("ORDER_DATE").alias("METRIC_MONTH")).distinct()
        images = read_change_log(spark, log)
        orders = images.join(touched, month("ORDER_DATE") == F.col("METRIC_MONTH"), "left_semi").select("ORDER_ID").distinct()
        history = scd2_from_log(images.join(orders, "ORDER_ID", "left_semi"), "ORDER_ID")
        fresh = daily_order_metrics(history).withColumn("METRIC_MONTH", month("METRIC_DATE"))
        rows = touched.join(fresh, "METRIC_MONTH", "left").withColumn("ORDER_COUNT", F.coalesce("ORDER_COUNT", F.lit(0)))
        writer = rows.repartition("METRIC_MONTH").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("METRIC_MONTH").parquet(daily)

    return run_available(order_images(source), step, checkpoint)


def read_daily(spark: SparkSession, daily: str) -> DataFrame:
    return spark.read.parquet(daily).filter(F.col("ORDER_COUNT") > 0).drop("METRIC_MONTH")


def ticket_metrics_stream(source: DataFrame, dst: str, checkpoint: str, as_of) -> StreamingQuery:
    """One metrics row per category and priority for the tickets each run brings in."""
    return run_available(source, lambda b, i: write_batch(support_ticket_metrics(b, as_of), dst, i), checkpoint)


def enrich_stream(source: DataFrame, customers: DataFrame, dst: str, checkpoint: str) -> StreamingQuery:
    """Arriving orders, cleaned and joined to the customer table, appended to ``dst``."""
    enriched = orders_enriched(orders_cleaned(source.drop(*CHANGE_COLUMNS, COMMIT, COMMITTED_AT)), customers)
    query = (
        enriched.writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
