"""Silver layer: cleaned and enriched orders, purchase patterns, review sentiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.functions.columns import (
    banded,
    clean_label,
    days_between,
    flag,
    growth_pct,
    mean,
    month_start,
    quarter_start,
)
from orelake.functions.sentiment import sentiment_from_hits, words_found
from orelake.operators.sequences import purchase_sequence
from orelake.vocab import (
    ALERT_RULES,
    DEFAULT_SENSOR_UNIT,
    NEGATIVE_WORDS,
    ORDER_VALUE_BANDS,
    ORDER_VALUE_FLOOR,
    POSITIVE_WORDS,
    SENSOR_UNITS,
)


def net_amount():
    return F.col("TOTAL_AMOUNT") - F.col("DISCOUNT_AMOUNT") + F.col("SHIPPING_AMOUNT")


def orders_cleaned(orders: DataFrame) -> DataFrame:
    """Dated, priced orders with normalised labels; bad rows are flagged, not dropped."""
    return orders.filter(F.col("ORDER_DATE").isNotNull() & F.col("TOTAL_AMOUNT").isNotNull()).select(
        "ORDER_ID",
        "CUSTOMER_ID",
        "ORDER_DATE",
        clean_label("ORDER_STATUS"),
        "TOTAL_AMOUNT",
        "DISCOUNT_AMOUNT",
        "SHIPPING_AMOUNT",
        net_amount().alias("NET_AMOUNT"),
        clean_label("PAYMENT_METHOD"),
        "SHIPPING_ADDRESS",
        clean_label("REGION"),
        clean_label("CHANNEL"),
        "SOURCE_SYSTEM",
        "CREATED_AT",
        "UPDATED_AT",
        flag(F.col("TOTAL_AMOUNT") > 0).alias("IS_VALID_AMOUNT"),
        flag(F.col("CUSTOMER_ID") > 0).alias("HAS_VALID_CUSTOMER"),
    )


def valid_orders(cleaned: DataFrame) -> DataFrame:
    """The order side of ``orders_enriched``: valid rows, calendar columns, value tier.

    CUSTOMER_ID is the key of the customers, so the enrichment join neither adds
    nor drops orders; summaries that use no customer attribute read this instead
    and save the join.
    """
    day = F.col("ORDER_DATE")
    return cleaned.filter(F.col("IS_VALID_AMOUNT") & F.col("HAS_VALID_CUSTOMER")).select(
        "ORDER_ID",
        "CUSTOMER_ID",
        "ORDER_DATE",
        month_start(day).alias("ORDER_MONTH"),
        quarter_start(day).alias("ORDER_QUARTER"),
        F.year(day).alias("ORDER_YEAR"),
        "ORDER_STATUS",
        "TOTAL_AMOUNT",
        "DISCOUNT_AMOUNT",
        "SHIPPING_AMOUNT",
        "NET_AMOUNT",
        "PAYMENT_METHOD",
        "REGION",
        "CHANNEL",
        "SOURCE_SYSTEM",
        banded(F.col("NET_AMOUNT"), ORDER_VALUE_BANDS, ORDER_VALUE_FLOOR).alias("ORDER_VALUE_TIER"),
    )


def orders_enriched(cleaned: DataFrame, customers: DataFrame) -> DataFrame:
    """Valid orders with the customer's attributes, calendar columns and value tier.

    Left join on CUSTOMER_ID. No hint: Spark broadcasts the customers when they
    are small, and otherwise AQE splits the partitions of hot customers.
    """
    people = customers.select(
        "CUSTOMER_ID",
        "FIRST_NAME",
        "LAST_NAME",
        F.col("EMAIL").alias("CUSTOMER_EMAIL"),
        "CUSTOMER_SEGMENT",
        F.col("CITY").alias("CUSTOMER_CITY"),
        F.col("STATE").alias("CUSTOMER_STATE"),
        "REGISTRATION_DATE",
    )
    return valid_orders(cleaned).join(people, "CUSTOMER_ID", "left").select(
        "ORDER_ID",
        "CUSTOMER_ID",
        "FIRST_NAME",
        "LAST_NAME",
        "CUSTOMER_EMAIL",
        "CUSTOMER_SEGMENT",
        "CUSTOMER_CITY",
        "CUSTOMER_STATE",
        "ORDER_DATE",
        "ORDER_MONTH",
        "ORDER_QUARTER",
        "ORDER_YEAR",
        "ORDER_STATUS",
        "TOTAL_AMOUNT",
        "DISCOUNT_AMOUNT",
        "SHIPPING_AMOUNT",
        "NET_AMOUNT",
        "PAYMENT_METHOD",
        "REGION",
        "CHANNEL",
        "SOURCE_SYSTEM",
        days_between(F.col("REGISTRATION_DATE"), F.col("ORDER_DATE")).alias("CUSTOMER_TENURE_DAYS"),
        "ORDER_VALUE_TIER",
    )


def customer_order_patterns(orders: DataFrame, heavy_rows: int = 2_000_000) -> DataFrame:
    """Each order with its place in the customer's history. Ties go by ORDER_ID."""
    slim = orders.select("ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "REGION", "CHANNEL")
    return purchase_sequence(slim, "CUSTOMER_ID", "ORDER_DATE", "ORDER_ID", "TOTAL_AMOUNT", heavy_rows)


def processed_reviews(
    reviews: DataFrame,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
) -> DataFrame:
    # Hit counts are columns of their own: Catalyst keeps such a projection apart,
    # so every text is lower-cased and searched once for all three results.
    lowered = F.lower(F.col("REVIEW_TEXT"))
    found = reviews.withColumns({"_up": words_found(lowered, positive), "_down": words_found(lowered, negative)})
    result = sentiment_from_hits(F.col("REVIEW_TEXT"), F.col("_up"), F.col("_down"))
    return found.withColumn("_s", result).select(
        "REVIEW_ID",
        "PRODUCT_ID",
        "CUSTOMER_ID",
        "REVIEW_TEXT",
        "RATING",
        "REVIEW_DATE",
        "HELPFUL_VOTES",
        F.col("_s.score").alias("SENTIMENT_SCORE"),
        F.col("_s.label").alias("SENTIMENT_LABEL"),
        F.col("_s.confidence").alias("SENTIMENT_CONFIDENCE"),
    )


def exact_score():
    """Scores have two decimals; summing them as decimals is exact in any order."""
    return F.col("SENTIMENT_SCORE").cast("decimal(9,2)")


def sentiment_distribution(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("SENTIMENT_LABEL")
        .agg(
            F.count(F.lit(1)).alias("COUNT"),
            mean(F.col("RATING"), 2).alias("AVG_RATING"),
            mean(exact_score(), 2).alias("AVG_SENTIMENT_SCORE"),
        )
        .orderBy(F.col("COUNT").desc(), "SENTIMENT_LABEL")
    )


def product_sentiment_summary(processed: DataFrame, products: DataFrame) -> DataFrame:
    """Review figures per product. Reviews are aggregated before the product join,
    so texts never reach a shuffle and a much-reviewed product costs one row per task."""

    def labelled(label: str):
        return F.count_if(F.col("SENTIMENT_LABEL") == label)

    per_product = processed.groupBy("PRODUCT_ID").agg(
        F.count(F.lit(1)).alias("REVIEW_COUNT"),
        mean(F.col("RATING"), 6).alias("AVG_RATING"),
        mean(exact_score(), 6).alias("AVG_SENTIMENT"),
        labelled("positive").alias("POSITIVE_REVIEWS"),
        labelled("negative").alias("NEGATIVE_REVIEWS"),
        F.sum("HELPFUL_VOTES").alias("TOTAL_HELPFUL_VOTES"),
    )
    names = products.select("PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "BRAND")
    return per_product.join(names, "PRODUCT_ID", "left").select(
        "PRODUCT_ID",
        "PRODUCT_NAME",
        "CATEGORY",
        "BRAND",
        "REVIEW_COUNT",
        "AVG_RATING",
        "AVG_SENTIMENT",
        "POSITIVE_REVIEWS",
        "NEGATIVE_REVIEWS",
        "TOTAL_HELPFUL_VOTES",
    )


def order_category_totals(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Items rolled up to one row per (month, category, customer, order).

    Shared first step of the monthly category tables: it runs map-side on the
    joined items, so the distinct counts that follow see far fewer rows.
    """
    return (
        items.select("ORDER_ID", "PRODUCT_ID", "ORDER_ITEM_ID", "QUANTITY", "LINE_TOTAL", "DISCOUNT_PCT")
        .join(products.select("PRODUCT_ID", "CATEGORY"), "PRODUCT_ID", "left")
        .join(orders.select("ORDER_ID", "CUSTOMER_ID", "ORDER_DATE"), "ORDER_ID")
        .groupBy(month_start(F.col("ORDER_DATE")).alias("ORDER_MONTH"), "CATEGORY", "CUSTOMER_ID", "ORDER_ID")
        .agg(
            F.sum("LINE_TOTAL").alias("REVENUE"),
            F.count("ORDER_ITEM_ID").alias("ITEMS"),
            F.sum("QUANTITY").alias("UNITS"),
            F.sum("DISCOUNT_PCT").alias("DISCOUNT_SUM"),
            F.count("DISCOUNT_PCT").alias("DISCOUNT_N"),
        )
    )


def monthly_revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    monthly = (
        order_category_totals(orders, items, products)
        .groupBy("ORDER_MONTH", "CATEGORY")
        .agg(
            F.sum("REVENUE").cast("decimal(20,2)").alias("MONTHLY_REVENUE"),
            F.sum("ITEMS").alias("ITEM_COUNT"),
            F.count("ORDER_ID").alias("ORDER_COUNT"),  # one row per order by now
        )
    )
    previous = F.lag("MONTHLY_REVENUE").over(W.partitionBy("CATEGORY").orderBy("ORDER_MONTH"))
    return monthly.withColumn("PREV_MONTH_REVENUE", previous).withColumn(
        "MOM_GROWTH_PCT", growth_pct(F.col("MONTHLY_REVENUE"), F.col("PREV_MONTH_REVENUE"))
    )


def sensor_unit(kind):
    cases = [F.when(kind == k, F.lit(u)) for k, u in SENSOR_UNITS.items()]
    return F.coalesce(*cases, F.lit(DEFAULT_SENSOR_UNIT))


def sensor_alert(kind, value, rules=ALERT_RULES):
    """TRUE when any rule for this kind of device is broken."""
    hit = F.lit(False)
    for device, op, limit in rules:
        hit = hit | ((kind == device) & ((value > limit) if op == ">" else (value < limit)))
    return flag(hit)


def iot_alerts(readings: DataFrame, rules=ALERT_RULES) -> DataFrame:
    kind, value = F.col("DEVICE_TYPE"), F.col("SENSOR_VALUE")
    return readings.select(
        "DEVICE_ID",
        "DEVICE_TYPE",
        "SENSOR_VALUE",
        sensor_unit(kind).alias("UNIT"),
        sensor_alert(kind, value, rules).alias("ALERT_TRIGGERED"),
        "EVENT_TIMESTAMP",
    )
