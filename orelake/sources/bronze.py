"""Bronze tables derived from the star-schema test tables.

Only deterministic integer and decimal arithmetic is used, so any SQL engine
reading the same files gets the same Bronze rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions.columns import padded

AMOUNT = "decimal(12,2)"
PRICE = "decimal(10,2)"
TURNS_PER_CONVERSATION = 1_000_000  # ticket numbers leave room for as many


# Stated, so that opening a table reads no file.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def pick(selector: Column, *values: str, rest: str | None = None) -> Column:
    """values[i] where selector == i, else ``rest``."""
    cases = [F.when(selector == i, F.lit(v)) for i, v in enumerate(values)]
    return F.coalesce(*cases, F.lit(rest).cast("string"))


def money(c: Column, to: str = AMOUNT) -> Column:
    return c.cast(to)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = (
        read(spark, sf_dir, "nation")
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", "n_name", "r_name")
    )
    c = read(spark, sf_dir, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("c_custkey")
    return c.select(
        key.alias("CUSTOMER_ID"),
        F.substring("c_name", 1, 8).alias("FIRST_NAME"),
        F.expr("substring(c_name, 10)").alias("LAST_NAME"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("EMAIL"),
        F.col("n_name").alias("CITY"),
        F.col("n_name").alias("STATE"),
        F.col("r_name").alias("COUNTRY"),
        F.col("c_mktsegment").alias("CUSTOMER_SEGMENT"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 700).cast("int")).alias("REGISTRATION_DATE"),
        (F.col("c_acctbal") > 0).alias("IS_ACTIVE"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(key % 20 == 0, "Cancelled")
        .when(key % 7 == 0, "  delivered ")
        .when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .when(F.col("o_orderstatus") == "P", "Processing")
    )
    scaled = money(money(F.col("o_totalprice"), "decimal(14,2)") * F.lit("0.02").cast("decimal(3,2)"))
    amount = F.when(key % 97 == 0, F.lit(None).cast(AMOUNT)).when(key % 89 == 0, money(F.lit(0))).otherwise(scaled)
    priority = F.substring("o_orderpriority", 1, 1)
    payment = (
        F.when(priority == "1", "Wire Transfer")
        .when(priority == "2", "PayPal")
        .when(priority == "3", "Debit Card")
        .otherwise("Credit Card")
    )
    ordered_at = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(
        key.alias("ORDER_ID"),
        cust.alias("CUSTOMER_ID"),
        ordered_at.alias("ORDER_DATE"),
        status.alias("ORDER_STATUS"),
        amount.alias("TOTAL_AMOUNT"),
        money(key % 500, PRICE).alias("DISCOUNT_AMOUNT"),
        money(key % 100, PRICE).alias("SHIPPING_AMOUNT"),
        payment.alias("PAYMENT_METHOD"),
        F.lit(None).cast("string").alias("SHIPPING_ADDRESS"),
        pick(cust % 4, "North America", "Europe", "Asia Pacific", "Latin America").alias("REGION"),
        pick(key % 4, "Online", "In-Store", "Partner", "Marketplace").alias("CHANNEL"),
        F.lit("NATIVE").alias("SOURCE_SYSTEM"),
        ordered_at.alias("CREATED_AT"),
        ordered_at.alias("UPDATED_AT"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    price = money(F.col("p_retailprice"), PRICE)
    sku = F.concat(
        F.lit("SKU-"),
        F.upper(F.substring("p_type", 1, 3)),
        F.lit("-"),
        padded(F.col("p_partkey")),
    )
    return p.select(
        F.col("p_partkey").alias("PRODUCT_ID"),
        F.col("p_name").alias("PRODUCT_NAME"),
        F.col("p_type").alias("CATEGORY"),
        (F.col("p_size") % 4).cast("string").alias("SUB_CATEGORY"),
        F.col("p_brand").alias("BRAND"),
        price.alias("UNIT_PRICE"),
        money(price * F.lit("0.60").cast("decimal(3,2)"), PRICE).alias("COST_PRICE"),
        sku.alias("SKU"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items without UNIT_PRICE, the one column that comes from another table."""
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ORDER_ITEM_ID"),
        F.col("l_orderkey").alias("ORDER_ID"),
        F.col("l_partkey").alias("PRODUCT_ID"),
        F.col("l_quantity").cast("bigint").alias("QUANTITY"),
        money(F.col("l_extendedprice")).alias("LINE_TOTAL"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("DISCOUNT_PCT"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PRODUCT_ID"), money(F.col("p_retailprice"), PRICE).alias("UNIT_PRICE")
    )
    return order_lines(spark, sf_dir).join(prices, "PRODUCT_ID", "left").select(
        "ORDER_ITEM_ID", "ORDER_ID", "PRODUCT_ID", "QUANTITY", "UNIT_PRICE", "LINE_TOTAL", "DISCOUNT_PCT"
    )


def product_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    key = F.col("doc_id")
    tenths = (10 + (key * 7) % 41).cast("decimal(4,0)")
    return d.select(
        key.alias("REVIEW_ID"),
        (key % 100).alias("PRODUCT_ID"),
        (key % 100).alias("CUSTOMER_ID"),
        F.col("text").alias("REVIEW_TEXT"),
        (tenths / 10).cast("decimal(2,1)").alias("RATING"),
        F.date_add(F.lit("2001-01-01").cast("date"), (key % 200).cast("int")).alias("REVIEW_DATE"),
        (key % 51).alias("HELPFUL_VOTES"),
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per turn of a conversation, whoever speaks."""
    t = read(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    hours = "(conv_id * 37 + turn)"
    days = f"make_dt_interval(cast({hours} div 24 as int), cast({hours} % 24 as int))"
    created = F.expr(f"timestamp_ntz'2001-01-01 00:00:00' + {days}")
    return t.select(
        (conv * TURNS_PER_CONVERSATION + turn).alias("TICKET_ID"),
        conv.alias("CUSTOMER_ID"),
        F.when(conv % 9 != 0, conv % 200).alias("PRODUCT_ID"),
        F.concat(F.lit("Turn "), turn.cast("string"), F.lit(" by "), F.col("role")).alias("TICKET_SUBJECT"),
        F.col("text").alias("TICKET_DESCRIPTION"),
        pick((conv + turn) % 4, "Low", "Medium", "High", "Critical").alias("PRIORITY"),
        pick((conv * 3 + turn) % 4, "Open", "In Progress", "Resolved", "Closed").alias("STATUS"),
        pick(conv % 5, "Technical", "Billing", "Shipping", "Product Defect", "General Inquiry").alias("CATEGORY"),
        ((conv * 13 + turn * 7) % 240).cast("decimal(10,2)").alias("RESOLUTION_TIME_HOURS"),
        (1 + (conv % 41).cast("decimal(4,0)") / 10).cast("decimal(2,1)").alias("SATISFACTION_SCORE"),
        created.alias("CREATED_AT"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.col("user_id").alias("USER_ID"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("PRODUCT_ID"),
        F.col("ts").cast("timestamp_ntz").alias("EVENT_TIMESTAMP"),
    )


def iot_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "view", "temperature")
        .when(F.col("event_type") == "click", "humidity")
        .when(F.col("event_type") == "purchase", "pressure")
        .when(F.col("event_type") == "signup", "motion")
        .when(F.col("event_type") == "error", "vibration")
    )
    return e.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.concat(F.lit("DEV-"), padded(F.col("user_id"))).alias("DEVICE_ID"),
        kind.alias("DEVICE_TYPE"),
        F.col("value").alias("SENSOR_VALUE"),
        F.col("ts").cast("timestamp_ntz").alias("EVENT_TIMESTAMP"),
    )


CHANGE_CUTOFF = "2001-01-01 00:00:00"


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as they stood before the change batch: nothing placed since the cutoff."""
    return orders(spark, sf_dir).filter(F.col("ORDER_DATE") < F.lit(CHANGE_CUTOFF).cast("timestamp_ntz"))


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after it: new ones are in, cancelled ones purged, pending ones shipped at a fee."""
    pending = F.col("ORDER_STATUS") == "Pending"
    return (
        orders(spark, sf_dir)
        .filter(F.col("ORDER_STATUS") != "Cancelled")
        .withColumns({
            "ORDER_STATUS": F.when(pending, "Shipped").otherwise(F.col("ORDER_STATUS")),
            "TOTAL_AMOUNT": money(F.when(pending, F.col("TOTAL_AMOUNT") + 1).otherwise(F.col("TOTAL_AMOUNT"))),
        })
    )


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "product_reviews": product_reviews,
    "support_tickets": support_tickets,
    "clickstream": clickstream,
    "iot_readings": iot_readings,
}
