"""The retail semantic model: five related tables, their dimensions and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orelake.functions.columns import mean, month_start, quarter_start
from orelake.operators.semantic import (
    Entity,
    Expression,
    Parts,
    Relationship,
    SemanticModel,
    averaged,
    counted,
    counted_if,
    distinct,
    summed,
)
from orelake.plans.silver import net_amount


def column(entity: str, name: str, source: str, *synonyms: str) -> Expression:
    return Expression(entity, name, lambda: F.col(source), synonyms)


def computed(entity: str, name: str, build, *synonyms: str) -> Expression:
    return Expression(entity, name, build, synonyms)


def measured(entity: str, name: str, build, parts: Parts, *synonyms: str) -> Expression:
    return Expression(entity, name, build, synonyms, parts)


def cancelled():
    return F.col("ORDER_STATUS") == "Cancelled"


# The names and synonyms users ask with.
RETAIL_MODEL = SemanticModel(
    entities=[
        Entity("customers", "CUSTOMER_ID", ("customer", "buyer", "client")),
        Entity("products", "PRODUCT_ID", ("product", "item", "SKU")),
        Entity("orders", "ORDER_ID", ("order", "sale", "transaction", "purchase")),
        Entity("order_items", "ORDER_ITEM_ID", ("line item", "order line", "order detail")),
        Entity("reviews", "REVIEW_ID", ("review", "feedback", "rating")),
    ],
    relationships=[
        Relationship("orders", "CUSTOMER_ID", "customers"),
        Relationship("order_items", "ORDER_ID", "orders"),
        Relationship("order_items", "PRODUCT_ID", "products"),
        Relationship("reviews", "PRODUCT_ID", "products"),
        Relationship("reviews", "CUSTOMER_ID", "customers"),
    ],
    facts=[
        computed("orders", "net_amount", net_amount),
        column("order_items", "line_total_amount", "LINE_TOTAL"),
        computed("products", "margin", lambda: F.col("UNIT_PRICE") - F.col("COST_PRICE")),
        column("reviews", "review_rating", "RATING"),
    ],
    dimensions=[
        computed("customers", "customer_name", lambda: F.concat("FIRST_NAME", F.lit(" "), "LAST_NAME"), "name", "client name"),
        column("customers", "customer_segment", "CUSTOMER_SEGMENT", "segment", "tier", "type"),
        column("customers", "customer_city", "CITY"),
        column("customers", "customer_state", "STATE"),
        column("customers", "customer_country", "COUNTRY"),
        column("customers", "registration_date", "REGISTRATION_DATE"),
        column("products", "product_name", "PRODUCT_NAME", "item name"),
        column("products", "category", "CATEGORY", "product category", "type"),
        column("products", "sub_category", "SUB_CATEGORY"),
        column("products", "brand", "BRAND"),
        column("orders", "order_date", "ORDER_DATE", "date", "purchase date", "sale date"),
        computed("orders", "order_year", lambda: F.year("ORDER_DATE")),
        computed("orders", "order_month", lambda: month_start(F.col("ORDER_DATE"))),
        computed("orders", "order_quarter", lambda: quarter_start(F.col("ORDER_DATE"))),
        column("orders", "order_status", "ORDER_STATUS", "status"),
        column("orders", "payment_method", "PAYMENT_METHOD", "payment type"),
        column("orders", "region", "REGION", "geography", "area", "market"),
        column("orders", "channel", "CHANNEL", "sales channel"),
        column("orders", "source_system", "SOURCE_SYSTEM"),
    ],
    metrics=[
        measured("orders", "total_revenue", lambda: F.sum("TOTAL_AMOUNT"), summed("TOTAL_AMOUNT"), "revenue", "sales", "gross revenue"),
        measured("orders", "net_revenue", lambda: F.sum("net_amount"), summed("net_amount"), "net sales"),
        measured("orders", "total_discount", lambda: F.sum("DISCOUNT_AMOUNT"), summed("DISCOUNT_AMOUNT")),
        measured("orders", "average_order_value", lambda: mean(F.col("TOTAL_AMOUNT"), 6), averaged("TOTAL_AMOUNT", 6), "AOV", "avg order"),
        measured("orders", "order_count", lambda: F.count("ORDER_ID"), counted("ORDER_ID"), "number of orders", "total orders"),
        measured("orders", "unique_customers", lambda: F.count_distinct("CUSTOMER_ID"), distinct("CUSTOMER_ID")),
        measured("orders", "cancelled_orders", lambda: F.count_if(cancelled()), counted_if(cancelled)),
        measured("order_items", "total_units_sold", lambda: F.sum("QUANTITY"), summed("QUANTITY"), "units sold", "quantity sold"),
        measured("order_items", "total_line_revenue", lambda: F.sum("LINE_TOTAL"), summed("LINE_TOTAL")),
        measured("customers", "customer_count", lambda: F.count("CUSTOMER_ID"), counted("CUSTOMER_ID"), "number of customers"),
        measured("reviews", "average_rating", lambda: mean(F.col("RATING"), 6), averaged("RATING", 6), "avg rating", "avg stars"),
        measured("reviews", "review_count", lambda: F.count("REVIEW_ID"), counted("REVIEW_ID"), "number of reviews"),
    ],
)
