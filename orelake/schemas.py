"""Declared schemas. Reads never infer types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def struct(*fields: str) -> T.StructType:
    """'NAME type' strings; a trailing '!' marks a column that must not be null."""
    out = T.StructType()
    for f in fields:
        name, kind = f.rstrip("!").split(" ", 1)
        out.add(T.StructField(name, _type(kind), not f.endswith("!")))
    return out


def _type(kind: str) -> T.DataType:
    simple = {
        "long": T.LongType(), "int": T.IntegerType(), "short": T.ShortType(), "string": T.StringType(),
        "date": T.DateType(), "ts": T.TimestampNTZType(), "bool": T.BooleanType(), "double": T.DoubleType(),
    }
    if kind in simple:
        return simple[kind]
    precision, scale = kind.removeprefix("dec(").rstrip(")").split(",")
    return T.DecimalType(int(precision), int(scale))


CUSTOMERS = struct(
    "CUSTOMER_ID long!", "FIRST_NAME string!", "LAST_NAME string!", "EMAIL string", "PHONE string", "ADDRESS string",
    "CITY string", "STATE string", "COUNTRY string", "POSTAL_CODE string", "CUSTOMER_SEGMENT string",
    "REGISTRATION_DATE date", "IS_ACTIVE bool", "CREATED_AT ts", "UPDATED_AT ts",
)
PRODUCTS = struct(
    "PRODUCT_ID long!", "PRODUCT_NAME string!", "CATEGORY string", "SUB_CATEGORY string", "BRAND string",
    "UNIT_PRICE dec(10,2)", "COST_PRICE dec(10,2)", "DESCRIPTION string", "SKU string", "IS_ACTIVE bool", "CREATED_AT ts",
)
ORDERS = struct(
    "ORDER_ID long!", "CUSTOMER_ID long!", "ORDER_DATE ts!", "ORDER_STATUS string", "TOTAL_AMOUNT dec(12,2)",
    "DISCOUNT_AMOUNT dec(10,2)", "SHIPPING_AMOUNT dec(10,2)", "PAYMENT_METHOD string", "SHIPPING_ADDRESS string",
    "REGION string", "CHANNEL string", "SOURCE_SYSTEM string", "CREATED_AT ts", "UPDATED_AT ts",
)
ORDER_ITEMS = struct(
    "ORDER_ITEM_ID long!", "ORDER_ID long!", "PRODUCT_ID long!", "QUANTITY long!", "UNIT_PRICE dec(10,2)!",
    "LINE_TOTAL dec(12,2)!", "DISCOUNT_PCT dec(5,2)",
)
PRODUCT_REVIEWS = struct(
    "REVIEW_ID long!", "PRODUCT_ID long!", "CUSTOMER_ID long!", "REVIEW_TEXT string!", "RATING dec(2,1)",
    "REVIEW_DATE date", "SENTIMENT string", "HELPFUL_VOTES long",
)
SUPPORT_TICKETS = struct(
    "TICKET_ID long!", "CUSTOMER_ID long!", "PRODUCT_ID long", "TICKET_SUBJECT string!", "TICKET_DESCRIPTION string",
    "PRIORITY string", "STATUS string", "CATEGORY string", "RESOLUTION_TIME_HOURS dec(10,2)", "SATISFACTION_SCORE dec(2,1)",
    "CREATED_AT ts", "RESOLVED_AT ts",
)
CLICKSTREAM = struct(
    "EVENT_ID string!", "SESSION_ID string!", "USER_ID long", "PAGE_URL string", "EVENT_TYPE string",
    "REFERRER_SOURCE string", "DEVICE_TYPE string", "BROWSER string", "COUNTRY string", "PRODUCT_ID long",
    "SESSION_DURATION_SEC long", "EVENT_TIMESTAMP ts!",
)
IOT_EVENTS = struct(
    "EVENT_ID string!", "DEVICE_ID string!", "DEVICE_TYPE string", "SENSOR_VALUE double!", "UNIT string",
    "WAREHOUSE_ID string", "LOCATION_ZONE string", "ALERT_TRIGGERED bool", "EVENT_TIMESTAMP ts!",
)
DAILY_ORDER_METRICS = struct(
    "METRIC_DATE date", "REGION string", "CHANNEL string", "ORDER_COUNT long", "TOTAL_REVENUE dec(14,2)",
    "AVG_ORDER_VALUE dec(14,2)", "NEW_CUSTOMERS long", "UPDATED_AT ts",
)
SUPPORT_TICKET_METRICS = struct(
    "METRIC_DATE date", "CATEGORY string", "PRIORITY string", "TICKET_COUNT long", "AVG_RESOLUTION_HRS dec(10,2)",
    "AVG_SATISFACTION dec(4,2)", "OPEN_TICKETS long", "UPDATED_AT ts",
)
PLANNING_TARGETS = struct(
    "REGION string!", "CHANNEL string!", "FISCAL_YEAR short!", "FISCAL_QUARTER short!", "REVENUE_TARGET dec(14,2)!",
    "ORDER_TARGET long!", "CUSTOMER_TARGET long!",
)


@dataclass(frozen=True)
class Feed:
    """A positional CSV feed: its columns in file order."""

    name: str
    schema: T.StructType


TARGETS_FEED = Feed("REGIONAL_SALES_TARGETS", PLANNING_TARGETS)
CAMPAIGNS_FEED = Feed(
    "MARKETING_CAMPAIGNS",
    struct(
        "CAMPAIGN_ID string!", "CAMPAIGN_NAME string!", "CAMPAIGN_TYPE string", "START_DATE date", "END_DATE date",
        "TARGET_SEGMENT string", "BUDGET_USD dec(12,2)", "SPEND_USD dec(12,2)", "IMPRESSIONS long", "CLICKS long",
        "CONVERSIONS long",
    ),
)
STORES_FEED = Feed(
    "STORE_LOCATIONS",
    struct(
        "STORE_ID string!", "STORE_NAME string!", "REGION string", "CITY string", "STATE string", "COUNTRY string",
        "STORE_TYPE string", "OPEN_DATE date", "IS_ACTIVE bool",
    ),
)
FEEDS = [TARGETS_FEED, CAMPAIGNS_FEED, STORES_FEED]
