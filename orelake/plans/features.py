"""Feature tables for the ticket-priority and monthly-revenue models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.functions.columns import days_between, growth_pct, mean
from orelake.operators.encode import (
    encoded,
    levels_fit,
    minmax_fit,
    position_in,
    ranged,
    standard_fit,
    standardised,
    with_fit,
)
from orelake.plans.silver import order_category_totals
from orelake.vocab import TICKET_PRIORITIES

TICKET_NUMERIC = [
    "TICKET_DESC_LENGTH", "TICKET_SUBJECT_LENGTH", "TICKET_WORD_COUNT", "DAYS_AS_CUSTOMER", "TICKET_HOUR",
    "TICKET_DAY_OF_WEEK", "UNIT_PRICE", "CUSTOMER_ORDER_COUNT", "CUSTOMER_TOTAL_SPEND", "CUSTOMER_AVG_ORDER",
]
TICKET_ENCODED = {"CATEGORY": "CATEGORY_ENCODED", "CUSTOMER_SEGMENT": "SEGMENT_ENCODED", "STATUS": "STATUS_ENCODED"}
TICKET_INPUTS = [*TICKET_ENCODED.values(), "HAS_PRODUCT", *[f"{c}_SCALED" for c in TICKET_NUMERIC]]

REVENUE_NUMERIC = [
    "ORDER_COUNT", "UNIQUE_CUSTOMERS", "TOTAL_UNITS", "AVG_DISCOUNT", "REVENUE_LAG_1", "REVENUE_LAG_2",
    "REVENUE_LAG_3", "REVENUE_MA_3", "ORDER_COUNT_LAG_1",
]
REVENUE_INPUTS = ["CATEGORY_ENCODED", "MONTH_NUM", "QUARTER", "YEAR", *[f"{c}_SCALED" for c in REVENUE_NUMERIC]]


def ticket_features(tickets: DataFrame, customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per ticket: text sizes, timing, product price and order history.

    CATEGORY is the ticket's. Orders are reduced to one row per customer first.
    """
    spend = orders.groupBy("CUSTOMER_ID").agg(
        F.count("ORDER_ID").alias("_orders"),
        F.sum("TOTAL_AMOUNT").alias("_spend"),
        mean(F.col("TOTAL_AMOUNT"), 6).alias("_avg"),
    )
    people = customers.select("CUSTOMER_ID", "CUSTOMER_SEGMENT", "REGISTRATION_DATE")
    prices = products.select("PRODUCT_ID", "UNIT_PRICE")
    text, created = F.col("TICKET_DESCRIPTION"), F.col("CREATED_AT")

    def filled(c):
        return F.coalesce(c.cast("double"), F.lit(0.0))

    return (
        tickets.join(people, "CUSTOMER_ID", "left")
        .join(spend, "CUSTOMER_ID", "left")  # next to the join on the same key: one shuffle of tickets
        .join(prices, "PRODUCT_ID", "left")
        .select(
            "TICKET_ID",
            "PRIORITY",
            "CATEGORY",
            "CUSTOMER_SEGMENT",
            "STATUS",
            F.length(text).alias("TICKET_DESC_LENGTH"),
            F.length("TICKET_SUBJECT").alias("TICKET_SUBJECT_LENGTH"),
            F.size(F.split(text, " ")).alias("TICKET_WORD_COUNT"),
            F.coalesce(days_between(F.col("REGISTRATION_DATE"), created), F.lit(0)).alias("DAYS_AS_CUSTOMER"),
            F.hour(created).alias("TICKET_HOUR"),
            (F.dayofweek(created) - 1).alias("TICKET_DAY_OF_WEEK"),  # 0 = Sunday
            F.col("PRODUCT_ID").isNotNull().cast("int").alias("HAS_PRODUCT"),
            filled(F.col("UNIT_PRICE")).alias("UNIT_PRICE"),
            F.coalesce("_orders", F.lit(0)).alias("CUSTOMER_ORDER_COUNT"),
            filled(F.col("_spend")).alias("CUSTOMER_TOTAL_SPEND"),
            filled(F.col("_avg")).alias("CUSTOMER_AVG_ORDER"),
        )
    )


def ticket_model_table(features: DataFrame) -> DataFrame:
    """Encoded and standardised form: id, label, encoded label, inputs."""
    fitted = with_fit(features, {**levels_fit(TICKET_ENCODED), **standard_fit(TICKET_NUMERIC)})
    return fitted.select(
        "TICKET_ID",
        "PRIORITY",
        position_in(F.array(*[F.lit(p) for p in TICKET_PRIORITIES]), "PRIORITY").alias("PRIORITY_ENCODED"),
        *[encoded(c).alias(out) for c, out in TICKET_ENCODED.items()],
        "HAS_PRODUCT",
        *[standardised(c).alias(f"{c}_SCALED") for c in TICKET_NUMERIC],
    )


def revenue_features(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Monthly figures per category with lags; months without three predecessors are dropped."""
    monthly = (
        order_category_totals(orders, items, products)
        .groupBy("ORDER_MONTH", "CATEGORY")
        .agg(
            F.sum("REVENUE").cast("decimal(20,2)").alias("MONTHLY_REVENUE"),
            F.count("ORDER_ID").alias("ORDER_COUNT"),  # one row per order by now, so no Expand
            F.count_distinct("CUSTOMER_ID").alias("UNIQUE_CUSTOMERS"),
            F.sum("UNITS").alias("TOTAL_UNITS"),
            F.round(F.sum("DISCOUNT_SUM") / F.nullif(F.sum("DISCOUNT_N"), F.lit(0)), 6).alias("AVG_DISCOUNT"),
        )
    )
    by_month = W.partitionBy("CATEGORY").orderBy("ORDER_MONTH")
    last_three = by_month.rowsBetween(-3, -1)
    revenue = F.col("MONTHLY_REVENUE")
    averaged = F.round(F.sum(revenue).over(last_three) / F.nullif(F.count(revenue).over(last_three), F.lit(0)), 6)
    return monthly.select(
        "*",
        F.month("ORDER_MONTH").alias("MONTH_NUM"),
        F.quarter("ORDER_MONTH").alias("QUARTER"),
        F.year("ORDER_MONTH").alias("YEAR"),
        *[F.lag(revenue, n).over(by_month).alias(f"REVENUE_LAG_{n}") for n in (1, 2, 3)],
        averaged.alias("REVENUE_MA_3"),
        F.lag("ORDER_COUNT").over(by_month).alias("ORDER_COUNT_LAG_1"),
    ).withColumn("REVENUE_GROWTH_PCT", growth_pct(revenue, F.col("REVENUE_LAG_1"), positive_only=True)).filter(
        F.col("REVENUE_LAG_3").isNotNull()
    )


def revenue_model_table(features: DataFrame) -> DataFrame:
    fitted = with_fit(features, {**levels_fit(["CATEGORY"]), **minmax_fit(REVENUE_NUMERIC)})
    return fitted.select(
        "ORDER_MONTH",
        "CATEGORY",
        "MONTHLY_REVENUE",
        encoded("CATEGORY").alias("CATEGORY_ENCODED"),
        "MONTH_NUM",
        "QUARTER",
        "YEAR",
        *[ranged(c).alias(f"{c}_SCALED") for c in REVENUE_NUMERIC],
        "REVENUE_GROWTH_PCT",
    )
