"""Silver and Gold kept up to date by change batches instead of rebuilds.

A batch is a feed of row images. Cleaning, the calendar columns and the customer join
work row by row, so an image that came counts +1 and one that went -1 through all of
them. What Gold needs of the orders is kept as cells, sums and counts that such signed
rows are simply added to: per month, region, channel and customer for sales (a cell
with orders left is one distinct customer), and per customer and order time for the
customers (the latest time with orders left is the last order, also after deletions).
Only the partitions that a batch touches, months and customer buckets, are read and
written, and Gold is derived again for these alone.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators.history import COMMIT
from orelake.plans import gold, silver
from orelake.sources.versions import read_parts, replace_parts

BUCKETS = 64  # of customers; a refresh reads and writes whole buckets
MONTH, BUCKET = "month_part", "bucket_part"
SALES_KEYS = ["ORDER_MONTH", "REGION", "CHANNEL", "CUSTOMER_ID"]
DAY_KEYS = ["CUSTOMER_ID", "ORDER_DATE"]


def month_part(column: str = "ORDER_DATE") -> Column:
    return F.date_format(F.col(column).cast("date"), "yyyy-MM").alias(MONTH)


def bucket_part(buckets: int) -> Column:
    return F.pmod(F.xxhash64("CUSTOMER_ID"), F.lit(buckets)).cast("string").alias(BUCKET)


def signed(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The images that came and those that went."""
    return tuple(changes.filter(F.col("_action") == a).drop("_action", "_is_update") for a in ("INSERT", "DELETE"))


def _measures(rows: DataFrame, sign: int, keys: list[str]) -> DataFrame:
    """Orders, and sum and number of known values of each amount, with a sign."""
    each = {"NET": F.col("NET_AMOUNT"), "DISCOUNT": F.col("DISCOUNT_AMOUNT")}
    s = F.lit(sign).cast("long")
    return rows.groupBy(*keys).agg(
        (F.count("ORDER_ID") * s).alias("ORDERS"),
        *[(F.coalesce(F.sum(c), F.lit(0)) * F.lit(sign)).cast("decimal(38,2)").alias(n) for n, c in each.items()],
        *[(F.count(c) * s).alias(f"{n}_N") for n, c in each.items()],
    )


MEASURES = ["ORDERS", "NET", "DISCOUNT", "NET_N", "DISCOUNT_N"]


def merged(cells: list[DataFrame], keys: list[str]) -> DataFrame:
    """Cells added up; those without orders are gone."""
    rows = reduce(DataFrame.unionByName, [c.select(*keys, *MEASURES) for c in cells])
    sums = [F.sum(m).cast("decimal(38,2)" if m in ("NET", "DISCOUNT") else "long").alias(m) for m in MEASURES]
    return rows.groupBy(*keys).agg(*sums).filter(F.col("ORDERS") != 0)


def _known(total: str) -> Column:
    return F.when(F.sum(f"{total}_N") > 0, F.sum(total))


def _mean(total: str) -> Column:
    return F.round(F.sum(total).cast("decimal(38,2)") / F.nullif(F.sum(f"{total}_N"), F.lit(0)), 2)


def sales_from_cells(cells: DataFrame, like: DataFrame) -> DataFrame:
    """``gold.sales_summary`` from its cells; ``like`` gives the types."""
    found = cells.groupBy(F.col("ORDER_MONTH").alias("MONTH"), "REGION", "CHANNEL").agg(
        F.sum("ORDERS").alias("TOTAL_ORDERS"),
        _known("NET").alias("TOTAL_REVENUE"),
        F.count("CUSTOMER_ID").alias("UNIQUE_CUSTOMERS"),
        _mean("NET").alias("AVG_ORDER_VALUE"),
        _known("DISCOUNT").alias("TOTAL_DISCOUNT"),
    )
    return found.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


def totals_from_days(days: DataFrame, like: DataFrame) -> DataFrame:
    """``gold.customer_totals`` from the cells by customer and order time."""
    found = days.groupBy("CUSTOMER_ID").agg(
        _known("NET").alias("_ltv"), F.sum("ORDERS").alias("_orders"), _mean("NET").alias("_avg"), F.max("ORDER_DATE").alias("_last")
    )
    return found.select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


class Lake:
    """The stored layers below ``path`` that follow a feed of order changes."""

    def __init__(self, spark: SparkSession, path: str, orders_like: DataFrame, customers: DataFrame, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        none = orders_like.limit(0)
        cleaned = silver.orders_cleaned(none)
        valid = silver.valid_orders(cleaned)
        self.like = {
            "orders_cleaned": cleaned.withColumn(MONTH, month_part()),
            "orders_enriched": silver.orders_enriched(cleaned, customers.limit(0)).withColumn(MONTH, month_part()),
            "sales_cells": merged([_measures(valid, 1, SALES_KEYS)], SALES_KEYS).withColumn(MONTH, month_part("ORDER_MONTH")),
            "customer_days": merged([_measures(valid, 1, DAY_KEYS)], DAY_KEYS).withColumn(BUCKET, bucket_part(buckets)),
            "sales_summary": gold.sales_summary(valid).withColumn(MONTH, month_part("MONTH")),
            "customer_totals": gold.customer_totals(valid).withColumn(BUCKET, bucket_part(buckets)),
        }

    def _by(self, name: str) -> str:
        return self.like[name].columns[-1]

    def _held(self, name: str, only: set[str], step: int) -> DataFrame:
        return read_parts(self.spark, f"{self.path}/{name}", self.like[name], self._by(name), only, before=step)

    def _put(self, name: str, rows: DataFrame, touched: set[str], step: int) -> DataFrame:
        by = self._by(name)
        replace_parts(rows.select(*self.like[name].columns), f"{self.path}/{name}", by, touched, step)
        return read_parts(self.spark, f"{self.path}/{name}", self.like[name], by, touched)

    def table(self, name: str) -> DataFrame:
        """The current rows of a stored table."""
        return read_parts(self.spark, f"{self.path}/{name}", self.like[name], self._by(name)).drop(self._by(name))

    def customer_360(self, customers: DataFrame, as_of: date) -> DataFrame:
        return gold.customer_360_from(customers, self.table("customer_totals"), as_of)

    def refresh(self, changes: DataFrame, customers: DataFrame, step: int) -> dict[str, set[str]]:
        """Bring all tables up to date with one batch of order changes; the partitions
        it rewrote. Steps are numbered by the caller, upwards; one that failed is
        repeated under its number."""
        if COMMIT in changes.columns:
            changes = collapse_net(changes, "ORDER_ID")
        # The batch is used several times, so it is written first.
        changes.write.mode("overwrite").parquet(f"{self.path}/batches/step={step}")
        batch = self.spark.read.schema(changes.schema).parquet(f"{self.path}/batches/step={step}")
        came, went = (silver.orders_cleaned(rows) for rows in signed(batch))
        came_valid, went_valid = silver.valid_orders(came), silver.valid_orders(went)
        months = {r[0] for r in came.select(month_part()).union(went.select(month_part())).distinct().collect()}
        valid = came_valid.select("CUSTOMER_ID").union(went_valid.select("CUSTOMER_ID"))
        held_in = {r[0] for r in valid.select(bucket_part(self.buckets)).distinct().collect()}

        def rows_after(name: str, went: DataFrame, came: DataFrame) -> DataFrame:
            kept = self._held(name, months, step).join(went.select("ORDER_ID"), "ORDER_ID", "left_anti")
            return kept.unionByName(came.withColumn(MONTH, month_part()))

        self._put("orders_cleaned", rows_after("orders_cleaned", went, came), months, step)
        enriched = silver.orders_enriched(came, customers)
        self._put("orders_enriched", rows_after("orders_enriched", went, enriched), months, step)

        def cells(name: str, keys: list[str], touched: set[str], part: Column) -> DataFrame:
            delta = [_measures(came_valid, 1, keys), _measures(went_valid, -1, keys)]
            rows = merged([self._held(name, touched, step), *delta], keys).withColumn(self._by(name), part)
            return self._put(name, rows, touched, step)

        sales = cells("sales_cells", SALES_KEYS, months, month_part("ORDER_MONTH"))
        days = cells("customer_days", DAY_KEYS, held_in, bucket_part(self.buckets))
        like = self.like["sales_summary"].drop(MONTH)
        self._put("sales_summary", sales_from_cells(sales, like).withColumn(MONTH, month_part("MONTH")), months, step)
        like = self.like["customer_totals"].drop(BUCKET)
        totals = totals_from_days(days, like).withColumn(BUCKET, bucket_part(self.buckets))
        self._put("customer_totals", totals, held_in, step)
        return {MONTH: months, BUCKET: held_in}


def collapse_net(changes: DataFrame, key: str) -> DataFrame:
    """One batch of images out of several commits: for each key the image that stood
    before the first of them, if any, goes, and the one after the last comes."""
    inserted = F.col("_action") == "INSERT"
    place = F.struct(F.col(COMMIT), inserted)
    columns = [c for c in changes.columns if c not in ("_action", "_is_update", COMMIT, "_committed_at")]
    image = F.struct("_action", F.struct(*columns).alias("image"))
    ends = changes.groupBy(key).agg(F.min_by(image, place).alias("first"), F.max_by(image, place).alias("last"))
    was, stays = F.col("first._action") == "DELETE", F.col("last._action") == "INSERT"
    moved = ends.filter((was | stays) & ~(was & stays & F.col("first.image").eqNullSafe(F.col("last.image"))))
    pair = F.array(F.when(was, F.col("first")), F.when(stays, F.col("last")))
    rows = moved.select(F.explode(F.filter(pair, lambda p: p.isNotNull())).alias("i"), (was & stays).alias("_is_update"))
    return rows.select("i.image.*", F.col("i._action").alias("_action"), "_is_update")

