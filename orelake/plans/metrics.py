"""Metrics kept up to date from change history."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.functions.columns import mean
from orelake.operators.history import as_ntz, empty_history, scd2_apply, upsert
from orelake.plans.silver import net_amount
from orelake.vocab import OPEN_TICKET_STATUSES

HISTORY_COLUMNS = [
    "ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "ORDER_STATUS", "TOTAL_AMOUNT", "NET_AMOUNT", "REGION", "CHANNEL", "SOURCE_SYSTEM",
]
DAILY_KEYS = ["METRIC_DATE", "REGION", "CHANNEL"]


def order_images(changes: DataFrame) -> DataFrame:
    """Order changes with the net amount, in the shape the history keeps."""
    extra = [c for c in changes.columns if c.startswith("_")]
    return changes.withColumn("NET_AMOUNT", net_amount().cast("decimal(14,2)")).select(*HISTORY_COLUMNS, *extra)


def orders_scd2(history: DataFrame | None, changes: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Order history after a batch of order changes; None starts a new history."""
    images = order_images(changes)
    if history is None:
        history = empty_history(images.select(*HISTORY_COLUMNS))
    return scd2_apply(history, images, "ORDER_ID", as_of)


def history_view(history: DataFrame) -> DataFrame:
    return history.select(
        "ORDER_ID", "ORDER_STATUS", "IS_CURRENT", "EFFECTIVE_FROM", "EFFECTIVE_TO", "DML_TYPE"
    ).orderBy("ORDER_ID", "EFFECTIVE_FROM")


def daily_order_metrics(history: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Current orders by day, region and channel (labels as recorded, not upper-cased).

    ``dates`` (one METRIC_DATE column) limits the work to the days a batch touched.
    NEW_CUSTOMERS counts the day's distinct customers.
    """
    live = history.filter(F.col("IS_CURRENT")).withColumn("METRIC_DATE", F.col("ORDER_DATE").cast("date"))
    if dates is not None:
        live = live.join(dates.select("METRIC_DATE").distinct(), "METRIC_DATE", "left_semi")
    return live.groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("ORDER_COUNT"),
        F.sum("NET_AMOUNT").alias("TOTAL_REVENUE"),
        mean(F.col("NET_AMOUNT"), 2).cast("decimal(14,2)").alias("AVG_ORDER_VALUE"),
        F.count_distinct("CUSTOMER_ID").alias("NEW_CUSTOMERS"),
    )


def touched_dates(changes: DataFrame) -> DataFrame:
    return changes.select(F.col("ORDER_DATE").cast("date").alias("METRIC_DATE")).distinct()


def refresh_daily(target: DataFrame, history: DataFrame, as_of, changes: DataFrame | None = None, null_safe=False) -> DataFrame:
    """Daily metrics brought up to date, recomputing only touched days when given the batch."""
    dates = None if changes is None else touched_dates(changes)
    return upsert(target, daily_order_metrics(history, dates), DAILY_KEYS, as_of, null_safe=null_safe)


def support_ticket_metrics(changes: DataFrame, as_of: date, stamp: datetime | str | None = None) -> DataFrame:
    """One row per category and priority over the tickets a batch brought in."""
    moment = as_ntz(stamp if stamp is not None else F.lit(as_of))
    return (
        changes.filter(F.col("_action") == "INSERT")
        .groupBy("CATEGORY", "PRIORITY")
        .agg(
            F.count(F.lit(1)).alias("TICKET_COUNT"),
            mean(F.col("RESOLUTION_TIME_HOURS"), 2).cast("decimal(10,2)").alias("AVG_RESOLUTION_HRS"),
            mean(F.col("SATISFACTION_SCORE"), 2).cast("decimal(4,2)").alias("AVG_SATISFACTION"),
            F.count_if(F.col("STATUS").isin(OPEN_TICKET_STATUSES)).alias("OPEN_TICKETS"),
        )
        .select(F.lit(as_of).alias("METRIC_DATE"), "*", moment.alias("UPDATED_AT"))
    )
