from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from orelake.plans import gold, silver

ORDER_DDL = (
    "ORDER_ID long, CUSTOMER_ID long, ORDER_DATE timestamp_ntz, ORDER_STATUS string, TOTAL_AMOUNT decimal(12,2), "
    "DISCOUNT_AMOUNT decimal(10,2), SHIPPING_AMOUNT decimal(10,2), PAYMENT_METHOD string, SHIPPING_ADDRESS string, "
    "REGION string, CHANNEL string, SOURCE_SYSTEM string, CREATED_AT timestamp_ntz, UPDATED_AT timestamp_ntz"
)
CUSTOMER_DDL = (
    "CUSTOMER_ID long, FIRST_NAME string, LAST_NAME string, EMAIL string, CUSTOMER_SEGMENT string, CITY string, "
    "STATE string, COUNTRY string, REGISTRATION_DATE date"
)


def order(i, cust=1, at=datetime(2024, 1, 1), total="100", discount="0", ship="0", status=" pending ", region="Europe", pay="PayPal", channel="Online"):
    def money(v):
        return None if v is None else D(v)

    return (i, cust, at, status, money(total), money(discount), money(ship), pay, None, region, channel, "NATIVE", at, at)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_DDL)


def customers(spark, *ids):
    return spark.createDataFrame(
        [(i, "Ada", f"L{i}", None, "SMB", "Austin", "TX", "US", date(2023, 12, 1)) for i in ids], CUSTOMER_DDL
    )


def test_cleaning_filters_normalises_and_flags(spark):
    df = orders(
        spark,
        order(1),
        order(2, at=None),
        order(3, total=None),
        order(4, total="0"),
        order(5, cust=0),
        order(6, cust=None),
        order(7, discount=None),
    )
    got = {r.ORDER_ID: r for r in silver.orders_cleaned(df).collect()}
    assert sorted(got) == [1, 4, 5, 6, 7]
    assert got[1].ORDER_STATUS == "PENDING" and got[1].REGION == "EUROPE"
    assert got[1].IS_VALID_AMOUNT and got[1].HAS_VALID_CUSTOMER
    assert got[4].IS_VALID_AMOUNT is False
    assert got[5].HAS_VALID_CUSTOMER is False and got[6].HAS_VALID_CUSTOMER is False
    assert got[7].NET_AMOUNT is None


def test_enrichment_keeps_unknown_customers_and_bands_on_net(spark):
    df = orders(
        spark,
        order(1, total="5100", discount="100"),
        order(2, total="5100", discount="101"),
        order(3, total="999.99"),
        order(4, cust=9, at=datetime(2023, 11, 20, 23, 0)),
    )
    got = {r.ORDER_ID: r for r in silver.orders_enriched(silver.orders_cleaned(df), customers(spark, 1)).collect()}
    assert [got[i].ORDER_VALUE_TIER for i in (1, 2, 3)] == ["High Value", "Medium Value", "Standard"]
    assert got[4].FIRST_NAME is None and got[4].CUSTOMER_TENURE_DAYS is None
    assert got[1].CUSTOMER_TENURE_DAYS == 31
    assert got[4].ORDER_MONTH == datetime(2023, 11, 1) and got[4].ORDER_QUARTER == datetime(2023, 10, 1)


def enriched(spark, *rows, ids=(1,)):
    return silver.orders_enriched(silver.orders_cleaned(orders(spark, *rows)), customers(spark, *ids))


def test_customer_360_keeps_customers_without_orders(spark):
    e = enriched(spark, order(1, total="20000", at=datetime(2024, 1, 2)), order(2, total="0.01", at=datetime(2024, 1, 5)))
    got = {r.CUSTOMER_ID: r for r in gold.customer_360(customers(spark, 1, 2), e, date(2024, 2, 4)).collect()}
    assert got[1].LIFETIME_VALUE == D("20000.01") and got[1].CUSTOMER_TIER == "Gold"
    assert got[1].AVG_ORDER_VALUE == D("10000.01")  # 10000.005 rounds half up
    assert got[1].DAYS_SINCE_LAST_ORDER == 30 and got[1].ENGAGEMENT_STATUS == "Active"
    assert got[2].LIFETIME_VALUE == 0 and got[2].TOTAL_ORDERS == 0 and got[2].AVG_ORDER_VALUE is None
    assert got[2].ENGAGEMENT_STATUS == "Lapsed" and got[2].CUSTOMER_TIER == "Bronze"


def test_preferences_break_ties_by_name(spark):
    e = enriched(
        spark,
        order(1, pay="PayPal", channel="Online"),
        order(2, pay="Credit Card", channel="Online"),
        order(3, pay="PayPal", channel="Partner", status="Cancelled"),
        order(4, pay="Credit Card", channel="Partner"),
    )
    r = gold.customer_360_wide(customers(spark, 1), e, date(2024, 2, 1)).first()
    assert (r.PREFERRED_PAYMENT, r.PREFERRED_CHANNEL, r.CANCELLED_ORDERS) == ("CREDIT CARD", "ONLINE", 1)


def test_top_customers_keeps_every_tie(spark):
    c360 = spark.createDataFrame([(1, D(50)), (2, D(40)), (3, D(40)), (4, D(30)), (5, D(0))], "CUSTOMER_ID long, LIFETIME_VALUE decimal(12,2)")
    got = sorted((r.CUSTOMER_ID, r.LTV_RANK) for r in gold.top_customers(c360, 2).collect())
    assert got == [(1, 1), (2, 2), (3, 2)]


def test_monthly_kpi_accumulates_per_region(spark):
    e = enriched(
        spark,
        order(1, channel="Partner", total="10"),
        order(2, channel="Online", total="5", discount="1"),
        order(3, at=datetime(2024, 2, 1), total="1"),
        order(4, region="LatAm", total="7"),
    )
    got = {(r.REGION, r.MONTH.month, r.CHANNEL): r for r in gold.monthly_kpi(gold.sales_summary(e)).collect()}
    assert got["EUROPE", 1, "ONLINE"].CUMULATIVE_REVENUE == 4
    assert got["EUROPE", 1, "PARTNER"].CUMULATIVE_REVENUE == 14
    assert got["EUROPE", 2, "ONLINE"].CUMULATIVE_REVENUE == 15
    assert got["LATAM", 1, "ONLINE"].CUMULATIVE_REVENUE == 7
    assert got["EUROPE", 1, "ONLINE"].DISCOUNT_RATE_PCT == 20


def catalogue(spark):
    products = spark.createDataFrame(
        [(i, f"p{i}", "c", "s", "b", D(1)) for i in (1, 2, 3, 4)],
        "PRODUCT_ID long, PRODUCT_NAME string, CATEGORY string, SUB_CATEGORY string, BRAND string, UNIT_PRICE decimal(10,2)",
    )
    items = spark.createDataFrame(
        [(1, 1, 1, 2, D(5), D(10), D(0)), (2, 2, 1, 3, D(6), D(20), D(1)), (3, 3, 2, 1, D(7), D(7), D(2))],
        "ORDER_ITEM_ID long, ORDER_ID long, PRODUCT_ID long, QUANTITY long, UNIT_PRICE decimal(10,2), LINE_TOTAL decimal(12,2), DISCOUNT_PCT decimal(5,2)",
    )
    reviews = spark.createDataFrame(
        [(1, 1, "great", D("4.5"), 1), (2, 1, "ok", D("4.0"), 2), (3, 1, "slow", D("2.0"), 3), (4, 3, "hate it", D("3.9"), 4)],
        "REVIEW_ID long, PRODUCT_ID long, REVIEW_TEXT string, RATING decimal(2,1), HELPFUL_VOTES long",
    )
    return products, items, reviews.withColumns({"CUSTOMER_ID": F.lit(1), "REVIEW_DATE": F.lit(date(2024, 1, 1))})


def test_product_performance_equals_the_single_join(spark):
    products, items, reviews = catalogue(spark)
    got = {r.PRODUCT_ID: r for r in gold.product_performance(products, items, reviews).collect()}
    naive = (
        products.join(items.select("PRODUCT_ID", "QUANTITY", "LINE_TOTAL"), "PRODUCT_ID", "left")
        .join(reviews.select("PRODUCT_ID", "REVIEW_ID"), "PRODUCT_ID", "left")
        .groupBy("PRODUCT_ID")
        .agg(F.coalesce(F.sum("QUANTITY"), F.lit(0)).alias("u"), F.coalesce(F.sum("LINE_TOTAL"), F.lit(0)).alias("r"))
    )
    for n in naive.collect():
        assert (got[n.PRODUCT_ID].TOTAL_UNITS_SOLD, got[n.PRODUCT_ID].TOTAL_REVENUE) == (n.u, n.r)
    assert got[1].TOTAL_UNITS_SOLD == 15 and got[1].REVIEW_COUNT == 3 and got[1].POSITIVE_REVIEW_PCT == D("66.7")
    assert got[4].AVG_RATING is None and got[4].POSITIVE_REVIEW_PCT is None and got[4].REVIEW_COUNT == 0
    once = {r.PRODUCT_ID: r for r in gold.product_performance(products, items, reviews, dedupe=True).collect()}
    assert once[1].TOTAL_UNITS_SOLD == 5 and once[1].TOTAL_REVENUE == 30


def test_health_falls_through_when_sentiment_is_missing(spark):
    perf = spark.createDataFrame(
        [(1, 4.6), (2, 4.6), (3, 4.2), (4, 2.0), (5, None), (6, None)], "PRODUCT_ID long, AVG_RATING double"
    )
    mood = spark.createDataFrame(
        [(1, 0.4), (3, 0.2), (6, -0.2)], "PRODUCT_ID long, AVG_SENTIMENT double"
    ).withColumns({c: F.lit(0) for c in ("POSITIVE_REVIEWS", "NEGATIVE_REVIEWS", "TOTAL_HELPFUL_VOTES")})
    got = {r.PRODUCT_ID: r.PRODUCT_HEALTH_SCORE for r in gold.product_health(perf, mood).collect()}
    assert got == {1: "Star", 2: "Average", 3: "Strong", 4: "At Risk", 5: "Unrated", 6: "At Risk"}


def test_reviews_of_unknown_products_stay(spark):
    products, _, reviews = catalogue(spark)
    lost = reviews.withColumn("PRODUCT_ID", F.when(F.col("PRODUCT_ID") == 3, 99).otherwise(F.col("PRODUCT_ID")))
    got = {r.PRODUCT_ID: r for r in silver.product_sentiment_summary(silver.processed_reviews(lost), products).collect()}
    assert got[99].PRODUCT_NAME is None and got[99].NEGATIVE_REVIEWS == 1
    assert got[1].POSITIVE_REVIEWS == 1 and got[1].TOTAL_HELPFUL_VOTES == 6


def test_growth_is_null_without_a_usable_previous_month(spark):
    o = orders(spark, *[order(m, at=datetime(2024, m, 1)) for m in (1, 2, 3, 4)])
    products, _, _ = catalogue(spark)
    items = spark.createDataFrame(
        [(m, m, 1, 1, D(1), D(v), D(0)) for m, v in ((1, "0"), (2, "50"), (3, "75"), (4, "60"))],
        "ORDER_ITEM_ID long, ORDER_ID long, PRODUCT_ID long, QUANTITY long, UNIT_PRICE decimal(10,2), LINE_TOTAL decimal(12,2), DISCOUNT_PCT decimal(5,2)",
    )
    got = [r.MOM_GROWTH_PCT for r in silver.monthly_revenue_by_category(o, items, products).orderBy("ORDER_MONTH").collect()]
    assert got == [None, None, D("50.00"), D("-20.00")]


def test_sensor_rules(spark):
    df = spark.createDataFrame(
        [("a", "temperature", 32.0), ("b", "temperature", 15.9), ("c", "humidity", 81.0), ("d", "other", 99.0), ("e", None, 99.0)],
        "DEVICE_ID string, DEVICE_TYPE string, SENSOR_VALUE double",
    ).withColumn("EVENT_TIMESTAMP", F.lit(datetime(2024, 1, 1)))
    got = {r.DEVICE_ID: (r.UNIT, r.ALERT_TRIGGERED) for r in silver.iot_alerts(df).collect()}
    assert got == {
        "a": ("celsius", False), "b": ("celsius", True), "c": ("percent", True), "d": ("unit", False), "e": ("unit", False),
    }
