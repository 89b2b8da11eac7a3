"""Business questions with a defined answer, each one semantic query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.operators.semantic import semantic_query
from orelake.plans.retail_model import RETAIL_MODEL

Tables = dict[str, DataFrame]


def ask(tables: Tables, metrics, dimensions=(), where=None, where_dimensions=()) -> DataFrame:
    return semantic_query(RETAIL_MODEL, tables, metrics, dimensions, where, where_dimensions)


def revenue_by_region(tables: Tables) -> DataFrame:
    return ask(tables, ["total_revenue", "order_count"], ["region"]).orderBy(F.col("total_revenue").desc())


def monthly_trend(tables: Tables) -> DataFrame:
    return ask(tables, ["total_revenue", "average_order_value"], ["order_month"]).orderBy("order_month")


def revenue_by_segment(tables: Tables, year: int) -> DataFrame:
    return ask(
        tables, ["total_revenue", "order_count"], ["customer_segment"], F.col("order_year") == year, ["order_year"]
    ).orderBy(F.col("total_revenue").desc())


def average_order_value_last_month(tables: Tables) -> DataFrame:
    """Average order value of the latest month that has orders."""
    months = ask(tables, ["average_order_value"], ["order_month"])
    return months.filter(F.col("order_month") == months.agg(F.max("order_month")).scalar())


def unique_customers_per_channel(tables: Tables) -> DataFrame:
    return ask(tables, ["unique_customers"], ["channel"]).orderBy("channel")


def top_categories_by_units(tables: Tables, k: int = 5) -> DataFrame:
    return (
        ask(tables, ["total_units_sold"], ["category"]).orderBy(F.col("total_units_sold").desc(), "category").limit(k)
    )


def category_sales(tables: Tables) -> DataFrame:
    """Revenue, orders and average order value per product category, from the lines.

    Lines are first summed per category and order, so an order counts once.
    """
    lines = tables["order_items"].select("ORDER_ID", "PRODUCT_ID", "LINE_TOTAL")
    kinds = tables["products"].select("PRODUCT_ID", F.col("CATEGORY").alias("category"))
    per_order = lines.join(kinds, "PRODUCT_ID", "left").groupBy("category", "ORDER_ID").agg(
        F.sum("LINE_TOTAL").alias("_revenue")
    )
    return per_order.groupBy("category").agg(
        F.sum("_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("_revenue") / F.count(F.lit(1)), 2).alias("average_order_value"),
    )


def category_support(tickets: DataFrame, tables: Tables, category: str) -> DataFrame:
    """Tickets and average review rating for one product category."""
    mine = F.col("CATEGORY") == category
    ids = tables["products"].filter(mine).select("PRODUCT_ID")
    tickets_n = tickets.join(ids, "PRODUCT_ID", "left_semi").agg(F.count(F.lit(1))).scalar()
    rating = ask(tables, ["average_rating", "review_count"], ["category"], F.col("category") == category)
    return rating.select("category", tickets_n.alias("ticket_count"), "average_rating", "review_count")


def net_revenue_by_region(tables: Tables, year: int) -> DataFrame:
    return ask(tables, ["net_revenue"], ["region"], F.col("order_year") == year, ["order_year"]).orderBy("region")
