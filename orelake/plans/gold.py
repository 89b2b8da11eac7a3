"""Gold layer: sales, customer and product summaries and the views over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.functions.columns import banded, mean, percent, within
from orelake.operators.ranking import exact_median, top_by_dense_rank
from orelake.vocab import CUSTOMER_TIER_BANDS, CUSTOMER_TIER_FLOOR, ENGAGEMENT_LIMITS, ENGAGEMENT_REST

NO_AMOUNT = "cast(0 as decimal(38,2))"


def sales_summary(enriched: DataFrame) -> DataFrame:
    """Monthly sales by region and channel; every order status counts.

    Enriched or just valid orders will do: no customer attribute is used.
    """
    return enriched.groupBy(F.col("ORDER_MONTH").alias("MONTH"), "REGION", "CHANNEL").agg(
        F.count("ORDER_ID").alias("TOTAL_ORDERS"),
        F.sum("NET_AMOUNT").alias("TOTAL_REVENUE"),
        F.count_distinct("CUSTOMER_ID").alias("UNIQUE_CUSTOMERS"),
        mean(F.col("NET_AMOUNT"), 2).alias("AVG_ORDER_VALUE"),
        F.sum("DISCOUNT_AMOUNT").alias("TOTAL_DISCOUNT"),
    )


def monthly_kpi(sales: DataFrame) -> DataFrame:
    """Sales summary with the discount rate and the region's cumulative revenue.

    Channels share a month, so the running sum breaks ties by channel.
    """
    so_far = W.partitionBy("REGION").orderBy("MONTH", "CHANNEL").rowsBetween(W.unboundedPreceding, W.currentRow)
    gross = F.col("TOTAL_REVENUE") + F.col("TOTAL_DISCOUNT")
    return sales.select(
        "*",
        percent(F.col("TOTAL_DISCOUNT"), gross, 2).alias("DISCOUNT_RATE_PCT"),
        F.sum("TOTAL_REVENUE").over(so_far).alias("CUMULATIVE_REVENUE"),
    )


def _customer_standing(as_of: date):
    idle = F.datediff(F.lit(as_of), F.col("_last").cast("date"))
    value = F.coalesce(F.col("_ltv"), F.expr(NO_AMOUNT))
    return {
        "LIFETIME_VALUE": value,
        "TOTAL_ORDERS": F.coalesce(F.col("_orders"), F.lit(0)),
        "AVG_ORDER_VALUE": F.col("_avg"),
        "DAYS_SINCE_LAST_ORDER": idle,
        "ENGAGEMENT_STATUS": within(idle, ENGAGEMENT_LIMITS, ENGAGEMENT_REST),
        "CUSTOMER_TIER": banded(value, CUSTOMER_TIER_BANDS, CUSTOMER_TIER_FLOOR),
    }


def _order_history():
    return [
        F.sum("NET_AMOUNT").cast("decimal(38,2)").alias("_ltv"),
        F.count_distinct("ORDER_ID").alias("_orders"),
        mean(F.col("NET_AMOUNT"), 2).alias("_avg"),
        F.max("ORDER_DATE").alias("_last"),
    ]


def customer_totals(enriched: DataFrame) -> DataFrame:
    """What customer 360 needs of the orders (enriched or just valid), one row per customer."""
    return enriched.groupBy("CUSTOMER_ID").agg(*_order_history())


def customer_360(customers: DataFrame, enriched: DataFrame, as_of: date) -> DataFrame:
    """One row per customer, with or without orders.

    Orders (enriched or just valid) shrink to one row per customer before they
    meet the customers, so the join sees unique keys on both sides.
    """
    return customer_360_from(customers, customer_totals(enriched), as_of)


def customer_360_from(customers: DataFrame, totals: DataFrame, as_of: date) -> DataFrame:
    """Customer 360 from totals that are at hand."""
    standing = _customer_standing(as_of)
    return customers.join(totals, "CUSTOMER_ID", "left").select(
        "CUSTOMER_ID",
        F.concat("FIRST_NAME", F.lit(" "), "LAST_NAME").alias("CUSTOMER_NAME"),
        "CUSTOMER_SEGMENT",
        "CITY",
        "STATE",
        "COUNTRY",
        *[c.alias(n) for n, c in standing.items()],
    )


def customer_360_wide(customers: DataFrame, enriched: DataFrame, as_of: date) -> DataFrame:
    """Customer 360 with first and last order, preferences and cancellations.

    A preference is the most frequent value, the alphabetically first on a tie.
    """
    history = customer_totals(enriched)
    # Apart from the distinct count, which would carry these per-value counts
    # through a shuffle keyed by order; both sides end up partitioned by customer.
    habits = enriched.groupBy("CUSTOMER_ID").agg(
        F.min("ORDER_DATE").alias("FIRST_ORDER_DATE"),
        F.mode("PAYMENT_METHOD", True).alias("PREFERRED_PAYMENT"),
        F.mode("CHANNEL", True).alias("PREFERRED_CHANNEL"),
        F.mode("REGION", True).alias("PRIMARY_REGION"),
        F.count_if(F.col("ORDER_STATUS") == "CANCELLED").alias("_cancelled"),
    )
    s = {n: c.alias(n) for n, c in _customer_standing(as_of).items()}
    return customers.join(history, "CUSTOMER_ID", "left").join(habits, "CUSTOMER_ID", "left").select(
        "CUSTOMER_ID",
        "FIRST_NAME",
        "LAST_NAME",
        F.col("EMAIL").alias("CUSTOMER_EMAIL"),
        "CUSTOMER_SEGMENT",
        F.col("CITY").alias("CUSTOMER_CITY"),
        F.col("STATE").alias("CUSTOMER_STATE"),
        s["TOTAL_ORDERS"],
        s["LIFETIME_VALUE"],
        s["AVG_ORDER_VALUE"],
        "FIRST_ORDER_DATE",
        F.col("_last").alias("LAST_ORDER_DATE"),
        s["DAYS_SINCE_LAST_ORDER"],
        "PREFERRED_PAYMENT",
        "PREFERRED_CHANNEL",
        "PRIMARY_REGION",
        F.coalesce(F.col("_cancelled"), F.lit(0)).alias("CANCELLED_ORDERS"),
        s["ENGAGEMENT_STATUS"],
        s["CUSTOMER_TIER"],
    )


def top_customers(c360: DataFrame, k: int = 1000) -> DataFrame:
    """Customers holding the k highest positive lifetime values, ties included."""
    return top_by_dense_rank(c360.filter(F.col("LIFETIME_VALUE") > 0), "LIFETIME_VALUE", k, "LTV_RANK")


def _review_figures(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("PRODUCT_ID").agg(
        F.count(F.lit(1)).alias("_review_rows"),
        mean(F.col("RATING"), 2).alias("AVG_RATING"),
        F.count_distinct("REVIEW_ID").alias("_reviews"),
        percent(F.count_if(F.col("RATING") >= 4), F.count("REVIEW_ID"), 1).alias("POSITIVE_REVIEW_PCT"),
    )


def _item_figures(items: DataFrame, *extra) -> DataFrame:
    return items.groupBy("PRODUCT_ID").agg(
        F.sum("QUANTITY").alias("_units"),
        F.sum("LINE_TOTAL").cast("decimal(38,2)").alias("_revenue"),
        *extra,
    )


def product_performance(products: DataFrame, items: DataFrame, reviews: DataFrame, dedupe: bool = False) -> DataFrame:
    """Units, revenue and review figures per product.

    By default totals are those of joining items and reviews to the product in
    one go, where each item repeats once per review. Both sides are aggregated
    first and the repetition is applied as a factor, so nothing fans out.
    ``dedupe=True`` leaves the factor out.
    """
    repeats = F.lit(1) if dedupe else F.greatest(F.coalesce(F.col("_review_rows"), F.lit(0)), F.lit(1))
    return (
        products.join(_item_figures(items), "PRODUCT_ID", "left")
        .join(_review_figures(reviews), "PRODUCT_ID", "left")
        .select(
            "PRODUCT_ID",
            "PRODUCT_NAME",
            "CATEGORY",
            "SUB_CATEGORY",
            "BRAND",
            "UNIT_PRICE",
            (F.coalesce(F.col("_units"), F.lit(0)) * repeats).alias("TOTAL_UNITS_SOLD"),
            (F.coalesce(F.col("_revenue"), F.expr(NO_AMOUNT)) * repeats).alias("TOTAL_REVENUE"),
            "AVG_RATING",
            F.coalesce(F.col("_reviews"), F.lit(0)).alias("REVIEW_COUNT"),
            "POSITIVE_REVIEW_PCT",
        )
    )


def product_performance_wide(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Product performance without the repetition, plus selling figures."""
    figures = _item_figures(
        items,
        F.count_distinct("ORDER_ID").alias("_orders"),
        mean(F.col("UNIT_PRICE"), 2).alias("AVG_SELLING_PRICE"),
        mean(F.col("DISCOUNT_PCT"), 2).alias("AVG_DISCOUNT_PCT"),
    )
    return (
        products.withColumnRenamed("UNIT_PRICE", "LIST_PRICE")
        .join(figures, "PRODUCT_ID", "left")
        .join(_review_figures(reviews), "PRODUCT_ID", "left")
        .select(
            "PRODUCT_ID",
            "PRODUCT_NAME",
            "CATEGORY",
            "SUB_CATEGORY",
            "BRAND",
            "LIST_PRICE",
            F.coalesce(F.col("_orders"), F.lit(0)).alias("ORDERS_CONTAINING_PRODUCT"),
            F.coalesce(F.col("_units"), F.lit(0)).alias("TOTAL_UNITS_SOLD"),
            F.coalesce(F.col("_revenue"), F.expr(NO_AMOUNT)).alias("TOTAL_REVENUE"),
            "AVG_SELLING_PRICE",
            "AVG_DISCOUNT_PCT",
            "AVG_RATING",
            F.coalesce(F.col("_reviews"), F.lit(0)).alias("REVIEW_COUNT"),
            "POSITIVE_REVIEW_PCT",
        )
    )


def product_health(performance: DataFrame, sentiment: DataFrame) -> DataFrame:
    rating, mood = F.col("AVG_RATING"), F.col("AVG_SENTIMENT")
    health = (
        F.when((rating >= 4.5) & (mood > 0.3), "Star")
        .when((rating >= 4.0) & (mood > 0.1), "Strong")
        .when(rating >= 3.0, "Average")
        .when((rating < 3.0) | (mood < -0.1), "At Risk")
        .otherwise("Unrated")
    )
    extra = sentiment.select(
        "PRODUCT_ID", "AVG_SENTIMENT", "POSITIVE_REVIEWS", "NEGATIVE_REVIEWS", "TOTAL_HELPFUL_VOTES"
    )
    return performance.join(extra, "PRODUCT_ID", "left").withColumn("PRODUCT_HEALTH_SCORE", health)


def sales_summary_wide(enriched: DataFrame) -> DataFrame:
    """Monthly sales by region, channel, segment and value tier."""
    keys = ["ORDER_MONTH", "ORDER_YEAR", "REGION", "CHANNEL", "CUSTOMER_SEGMENT", "ORDER_VALUE_TIER"]
    cancelled = F.count_if(F.col("ORDER_STATUS") == "CANCELLED")
    summary = enriched.groupBy(*keys).agg(
        F.count("ORDER_ID").alias("ORDER_COUNT"),
        F.count_distinct("CUSTOMER_ID").alias("UNIQUE_CUSTOMERS"),
        F.sum("TOTAL_AMOUNT").alias("GROSS_REVENUE"),
        F.sum("DISCOUNT_AMOUNT").alias("TOTAL_DISCOUNTS"),
        F.sum("NET_AMOUNT").alias("NET_REVENUE"),
        mean(F.col("NET_AMOUNT"), 2).alias("AVG_ORDER_VALUE"),
        F.max("NET_AMOUNT").alias("MAX_ORDER_VALUE"),
        cancelled.alias("CANCELLED_ORDERS"),
        percent(cancelled, F.count("ORDER_ID"), 2).alias("CANCELLATION_RATE_PCT"),
    )
    medians = exact_median(enriched, keys, "NET_AMOUNT", "MEDIAN_ORDER_VALUE")
    same = F.lit(True)
    for k in keys:
        same = same & summary[k].eqNullSafe(medians[k])
    return summary.join(medians, same, "left").select(
        *[summary[k] for k in keys],
        "ORDER_COUNT",
        "UNIQUE_CUSTOMERS",
        "GROSS_REVENUE",
        "TOTAL_DISCOUNTS",
        "NET_REVENUE",
        "AVG_ORDER_VALUE",
        "MEDIAN_ORDER_VALUE",
        "MAX_ORDER_VALUE",
        "CANCELLED_ORDERS",
        "CANCELLATION_RATE_PCT",
    )


def region_revenue(sales: DataFrame, revenue: str = "TOTAL_REVENUE") -> DataFrame:
    return sales.groupBy("REGION").agg(F.sum(revenue).alias("TOTAL_REVENUE"))
