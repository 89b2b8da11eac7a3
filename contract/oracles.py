"""Reference answers in DuckDB SQL, written independently of the Spark code.

Each statement starts from the raw test tables; the Bronze shapes are inlined
as CTEs. Averages and ratios are rounded half up in integer arithmetic, since
DuckDB divides decimals as doubles.
"""

from __future__ import annotations

from orelake.vocab import NEGATIVE_WORDS, POSITIVE_WORDS

AS_OF = "2001-08-02"


# --- exact rounding --------------------------------------------------------
def ratio(num: str, den: str, digits: int) -> str:
    """round(num / den, digits), half away from zero, for integer expressions; den >= 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    p = 10**digits
    return f"(CAST(SIGN({n}) * ((2 * ABS({n}) * {p} + {d}) // (2 * {d})) AS DOUBLE) / {p})"


def avg(x: str, digits: int, scale: int = 2) -> str:
    s = 10**scale
    return ratio(f"SUM(CAST(({x}) * {s} AS BIGINT))", f"(COUNT({x}) * {s})", digits)


def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


# --- Bronze ------------------------------------------------------------------
CUSTOMERS = """customers_b AS (
  SELECT c_custkey AS CUSTOMER_ID, substr(c_name, 1, 8) AS FIRST_NAME, substr(c_name, 10) AS LAST_NAME,
         lower(c_name) || '@example.com' AS EMAIL, n_name AS CITY, n_name AS STATE, r_name AS COUNTRY,
         c_mktsegment AS CUSTOMER_SEGMENT,
         DATE '1994-01-01' + CAST(c_custkey % 700 AS INTEGER) AS REGISTRATION_DATE, c_acctbal > 0 AS IS_ACTIVE
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

ORDERS = """orders_b AS (
  SELECT o_orderkey AS ORDER_ID, o_custkey AS CUSTOMER_ID, o_orderdate AS ORDER_DATE,
         CASE WHEN o_orderkey % 20 = 0 THEN 'Cancelled' WHEN o_orderkey % 7 = 0 THEN '  delivered '
              WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Pending'
              WHEN o_orderstatus = 'P' THEN 'Processing' END AS ORDER_STATUS,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN CAST(0 AS DECIMAL(12,2))
              ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(12,2)) END AS TOTAL_AMOUNT,
         CAST(o_orderkey % 500 AS DECIMAL(10,2)) AS DISCOUNT_AMOUNT, CAST(o_orderkey % 100 AS DECIMAL(10,2)) AS SHIPPING_AMOUNT,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Wire Transfer' WHEN '2' THEN 'PayPal' WHEN '3' THEN 'Debit Card'
              ELSE 'Credit Card' END AS PAYMENT_METHOD,
         CAST(NULL AS VARCHAR) AS SHIPPING_ADDRESS,
         CASE o_custkey % 4 WHEN 0 THEN 'North America' WHEN 1 THEN 'Europe' WHEN 2 THEN 'Asia Pacific' ELSE 'Latin America' END AS REGION,
         CASE o_orderkey % 4 WHEN 0 THEN 'Online' WHEN 1 THEN 'In-Store' WHEN 2 THEN 'Partner' ELSE 'Marketplace' END AS CHANNEL,
         'NATIVE' AS SOURCE_SYSTEM, o_orderdate AS CREATED_AT, o_orderdate AS UPDATED_AT
  FROM orders)"""

PRODUCTS = """products_b AS (
  SELECT p_partkey AS PRODUCT_ID, p_name AS PRODUCT_NAME, p_type AS CATEGORY, CAST(p_size % 4 AS VARCHAR) AS SUB_CATEGORY,
         p_brand AS BRAND, CAST(p_retailprice AS DECIMAL(10,2)) AS UNIT_PRICE
  FROM part)"""

ITEMS = """items_b AS (
  SELECT l_orderkey * 10 + l_linenumber AS ORDER_ITEM_ID, l_orderkey AS ORDER_ID, l_partkey AS PRODUCT_ID,
         CAST(l_quantity AS BIGINT) AS QUANTITY, CAST(p_retailprice AS DECIMAL(10,2)) AS UNIT_PRICE,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS LINE_TOTAL,
         CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS DISCOUNT_PCT
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

REVIEWS = """reviews_b AS (
  SELECT doc_id AS REVIEW_ID, doc_id % 100 AS PRODUCT_ID, doc_id % 100 AS CUSTOMER_ID, text AS REVIEW_TEXT,
         CAST((10 + (doc_id * 7) % 41) AS DECIMAL(4,1)) * CAST(0.1 AS DECIMAL(2,1)) AS RATING,
         DATE '2001-01-01' + CAST(doc_id % 200 AS INTEGER) AS REVIEW_DATE, doc_id % 51 AS HELPFUL_VOTES
  FROM documents)"""

TICKETS = """tickets_b AS (
  SELECT conv_id * 1000000 + turn AS TICKET_ID, conv_id AS CUSTOMER_ID,
         CASE WHEN conv_id % 9 = 0 THEN NULL ELSE conv_id % 200 END AS PRODUCT_ID,
         'Turn ' || turn || ' by ' || role AS TICKET_SUBJECT, text AS TICKET_DESCRIPTION,
         CASE (conv_id + turn) % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Critical' END AS PRIORITY,
         CASE (conv_id * 3 + turn) % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'In Progress' WHEN 2 THEN 'Resolved' ELSE 'Closed' END AS STATUS,
         CASE conv_id % 5 WHEN 0 THEN 'Technical' WHEN 1 THEN 'Billing' WHEN 2 THEN 'Shipping' WHEN 3 THEN 'Product Defect'
              ELSE 'General Inquiry' END AS CATEGORY,
         CAST((conv_id * 13 + turn * 7) % 240 AS DECIMAL(10,2)) AS RESOLUTION_TIME_HOURS,
         CAST(10 + conv_id % 41 AS DECIMAL(4,1)) * CAST(0.1 AS DECIMAL(2,1)) AS SATISFACTION_SCORE,
         TIMESTAMP '2001-01-01 00:00:00' + to_hours(CAST(conv_id * 37 + turn AS INTEGER)) AS CREATED_AT
  FROM conversations)"""

CLEANED = ORDERS + """, cleaned AS (
  SELECT ORDER_ID, CUSTOMER_ID, ORDER_DATE, upper(trim(ORDER_STATUS)) AS ORDER_STATUS, TOTAL_AMOUNT, DISCOUNT_AMOUNT, SHIPPING_AMOUNT,
         TOTAL_AMOUNT - DISCOUNT_AMOUNT + SHIPPING_AMOUNT AS NET_AMOUNT, upper(trim(PAYMENT_METHOD)) AS PAYMENT_METHOD, SHIPPING_ADDRESS,
         upper(trim(REGION)) AS REGION, upper(trim(CHANNEL)) AS CHANNEL, SOURCE_SYSTEM, CREATED_AT, UPDATED_AT,
         COALESCE(TOTAL_AMOUNT > 0, FALSE) AS IS_VALID_AMOUNT, COALESCE(CUSTOMER_ID > 0, FALSE) AS HAS_VALID_CUSTOMER
  FROM orders_b WHERE ORDER_DATE IS NOT NULL AND TOTAL_AMOUNT IS NOT NULL)"""

ENRICHED = CUSTOMERS + ", " + CLEANED + """, enriched AS (
  SELECT o.ORDER_ID, o.CUSTOMER_ID, c.FIRST_NAME, c.LAST_NAME, c.EMAIL AS CUSTOMER_EMAIL, c.CUSTOMER_SEGMENT, c.CITY AS CUSTOMER_CITY,
         c.STATE AS CUSTOMER_STATE, o.ORDER_DATE, CAST(date_trunc('month', o.ORDER_DATE) AS DATE) AS ORDER_MONTH,
         CAST(date_trunc('quarter', o.ORDER_DATE) AS DATE) AS ORDER_QUARTER, year(o.ORDER_DATE) AS ORDER_YEAR, o.ORDER_STATUS,
         o.TOTAL_AMOUNT, o.DISCOUNT_AMOUNT, o.SHIPPING_AMOUNT, o.NET_AMOUNT, o.PAYMENT_METHOD, o.REGION, o.CHANNEL, o.SOURCE_SYSTEM,
         datediff('day', c.REGISTRATION_DATE, CAST(o.ORDER_DATE AS DATE)) AS CUSTOMER_TENURE_DAYS,
         CASE WHEN o.NET_AMOUNT >= 5000 THEN 'High Value' WHEN o.NET_AMOUNT >= 1000 THEN 'Medium Value' ELSE 'Standard' END AS ORDER_VALUE_TIER
  FROM cleaned o LEFT JOIN customers_b c ON o.CUSTOMER_ID = c.CUSTOMER_ID
  WHERE o.IS_VALID_AMOUNT AND o.HAS_VALID_CUSTOMER)"""

SALES = ENRICHED + f""", sales AS (
  SELECT ORDER_MONTH AS MONTH, REGION, CHANNEL, COUNT(ORDER_ID) AS TOTAL_ORDERS, SUM(NET_AMOUNT) AS TOTAL_REVENUE,
         COUNT(DISTINCT CUSTOMER_ID) AS UNIQUE_CUSTOMERS, {avg('NET_AMOUNT', 2)} AS AVG_ORDER_VALUE, SUM(DISCOUNT_AMOUNT) AS TOTAL_DISCOUNT
  FROM enriched GROUP BY 1, 2, 3)"""

C360 = ENRICHED + f""", c360_raw AS (
  SELECT c.CUSTOMER_ID, c.FIRST_NAME, c.LAST_NAME, c.EMAIL, c.CUSTOMER_SEGMENT, c.CITY, c.STATE, c.COUNTRY,
         COALESCE(SUM(o.NET_AMOUNT), 0) AS LIFETIME_VALUE, COUNT(DISTINCT o.ORDER_ID) AS TOTAL_ORDERS,
         {avg('o.NET_AMOUNT', 2)} AS AVG_ORDER_VALUE, MIN(o.ORDER_DATE) AS FIRST_ORDER_DATE, MAX(o.ORDER_DATE) AS LAST_ORDER_DATE,
         datediff('day', CAST(MAX(o.ORDER_DATE) AS DATE), DATE '{AS_OF}') AS DAYS_SINCE_LAST_ORDER,
         COUNT(*) FILTER (o.ORDER_STATUS = 'CANCELLED') AS CANCELLED_ORDERS
  FROM customers_b c LEFT JOIN enriched o ON c.CUSTOMER_ID = o.CUSTOMER_ID
  GROUP BY ALL), c360 AS (
  SELECT *, FIRST_NAME || ' ' || LAST_NAME AS CUSTOMER_NAME,
         CASE WHEN DAYS_SINCE_LAST_ORDER <= 30 THEN 'Active' WHEN DAYS_SINCE_LAST_ORDER <= 90 THEN 'At Risk' ELSE 'Lapsed' END AS ENGAGEMENT_STATUS,
         CASE WHEN LIFETIME_VALUE >= 50000 THEN 'Platinum' WHEN LIFETIME_VALUE >= 20000 THEN 'Gold' WHEN LIFETIME_VALUE >= 5000 THEN 'Silver'
              ELSE 'Bronze' END AS CUSTOMER_TIER
  FROM c360_raw)"""

C360_COLS = """CUSTOMER_ID, CUSTOMER_NAME, CUSTOMER_SEGMENT, CITY, STATE, COUNTRY, CAST(LIFETIME_VALUE AS DOUBLE) AS LIFETIME_VALUE,
  TOTAL_ORDERS, AVG_ORDER_VALUE, DAYS_SINCE_LAST_ORDER, ENGAGEMENT_STATUS, CUSTOMER_TIER"""


def hits(words: list[str]) -> str:
    return " + ".join(f"CAST(contains(lower(REVIEW_TEXT), '{w}') AS INTEGER)" for w in words)


PROCESSED = REVIEWS + f""", hit AS (
  SELECT *, {hits(POSITIVE_WORDS)} AS p, {hits(NEGATIVE_WORDS)} AS n FROM reviews_b), score AS (
  SELECT *, CASE WHEN REVIEW_TEXT IS NULL OR REVIEW_TEXT = '' OR p + n = 0 THEN 0.0
                 ELSE round_even(CAST(p - n AS DOUBLE) / (p + n), 2) END AS SENTIMENT_SCORE,
         CASE WHEN REVIEW_TEXT IS NULL OR REVIEW_TEXT = '' THEN 0.0 WHEN p + n = 0 THEN 0.3
              ELSE CAST(least(p + n, 5) AS DOUBLE) / 5 END AS SENTIMENT_CONFIDENCE
  FROM hit), processed AS (
  SELECT REVIEW_ID, PRODUCT_ID, CUSTOMER_ID, REVIEW_TEXT, RATING, REVIEW_DATE, HELPFUL_VOTES,
         CAST(SENTIMENT_SCORE AS DOUBLE) AS SENTIMENT_SCORE,
         CASE WHEN SENTIMENT_SCORE > 0.2 THEN 'positive' WHEN SENTIMENT_SCORE < -0.2 THEN 'negative' ELSE 'neutral' END AS SENTIMENT_LABEL,
         CAST(SENTIMENT_CONFIDENCE AS DOUBLE) AS SENTIMENT_CONFIDENCE
  FROM score)"""

PRODUCT_SENTIMENT = PRODUCTS + ", " + PROCESSED + f""", product_sentiment AS (
  SELECT PRODUCT_ID, PRODUCT_NAME, CATEGORY, BRAND, COUNT(*) AS REVIEW_COUNT, {avg('RATING', 6)} AS AVG_RATING,
         {avg('CAST(SENTIMENT_SCORE AS DECIMAL(9,2))', 6)} AS AVG_SENTIMENT,
         COUNT(*) FILTER (SENTIMENT_LABEL = 'positive') AS POSITIVE_REVIEWS,
         COUNT(*) FILTER (SENTIMENT_LABEL = 'negative') AS NEGATIVE_REVIEWS,
         CAST(SUM(HELPFUL_VOTES) AS BIGINT) AS TOTAL_HELPFUL_VOTES
  FROM processed LEFT JOIN products_b USING (PRODUCT_ID) GROUP BY PRODUCT_ID, PRODUCT_NAME, CATEGORY, BRAND)"""

# One join of items and reviews per product, so each item repeats once per review.
FAN_OUT = PRODUCTS + ", " + ITEMS + ", " + REVIEWS + f""", performance AS (
  SELECT p.PRODUCT_ID, p.PRODUCT_NAME, p.CATEGORY, p.SUB_CATEGORY, p.BRAND, p.UNIT_PRICE,
         COALESCE(SUM(i.QUANTITY), 0) AS TOTAL_UNITS_SOLD, COALESCE(SUM(i.LINE_TOTAL), 0) AS TOTAL_REVENUE,
         {avg('r.RATING', 2)} AS AVG_RATING, COUNT(DISTINCT r.REVIEW_ID) AS REVIEW_COUNT,
         {ratio('100 * COUNT(*) FILTER (r.RATING >= 4)', 'COUNT(r.REVIEW_ID)', 1)} AS POSITIVE_REVIEW_PCT
  FROM products_b p LEFT JOIN items_b i ON p.PRODUCT_ID = i.PRODUCT_ID LEFT JOIN reviews_b r ON p.PRODUCT_ID = r.PRODUCT_ID
  GROUP BY p.PRODUCT_ID, p.PRODUCT_NAME, p.CATEGORY, p.SUB_CATEGORY, p.BRAND, p.UNIT_PRICE)"""

PERFORMANCE_COLS = """PRODUCT_ID, PRODUCT_NAME, CATEGORY, SUB_CATEGORY, BRAND, CAST(UNIT_PRICE AS DOUBLE) AS UNIT_PRICE,
  CAST(TOTAL_UNITS_SOLD AS BIGINT) AS TOTAL_UNITS_SOLD, CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE, AVG_RATING, REVIEW_COUNT, POSITIVE_REVIEW_PCT"""

SEPARATE = PRODUCTS + ", " + ITEMS + ", " + REVIEWS + f""", sold AS (
  SELECT PRODUCT_ID, COUNT(DISTINCT ORDER_ID) AS n_orders, SUM(QUANTITY) AS units, SUM(LINE_TOTAL) AS revenue,
         {avg('UNIT_PRICE', 2)} AS AVG_SELLING_PRICE, {avg('DISCOUNT_PCT', 2)} AS AVG_DISCOUNT_PCT
  FROM items_b GROUP BY 1), rated AS (
  SELECT PRODUCT_ID, {avg('RATING', 2)} AS AVG_RATING, COUNT(DISTINCT REVIEW_ID) AS n_reviews,
         {ratio('100 * COUNT(*) FILTER (RATING >= 4)', 'COUNT(REVIEW_ID)', 1)} AS POSITIVE_REVIEW_PCT
  FROM reviews_b GROUP BY 1)"""

CATEGORY_MONTHS = PRODUCTS + ", " + ITEMS + ", " + ORDERS + """, joined AS (
  SELECT CAST(date_trunc('month', ORDER_DATE) AS DATE) AS ORDER_MONTH, p.CATEGORY, i.*, o.CUSTOMER_ID
  FROM orders_b o JOIN items_b i ON o.ORDER_ID = i.ORDER_ID LEFT JOIN products_b p ON i.PRODUCT_ID = p.PRODUCT_ID)"""


def silver_and_gold() -> dict[str, str]:
    q: dict[str, str] = {}
    q["orders_cleaned"] = f"""WITH {CLEANED} SELECT * REPLACE (CAST(TOTAL_AMOUNT AS DOUBLE) AS TOTAL_AMOUNT,
        CAST(DISCOUNT_AMOUNT AS DOUBLE) AS DISCOUNT_AMOUNT, CAST(SHIPPING_AMOUNT AS DOUBLE) AS SHIPPING_AMOUNT,
        CAST(NET_AMOUNT AS DOUBLE) AS NET_AMOUNT) FROM cleaned"""
    q["orders_enriched"] = f"""WITH {ENRICHED} SELECT * REPLACE (CAST(TOTAL_AMOUNT AS DOUBLE) AS TOTAL_AMOUNT,
        CAST(DISCOUNT_AMOUNT AS DOUBLE) AS DISCOUNT_AMOUNT, CAST(SHIPPING_AMOUNT AS DOUBLE) AS SHIPPING_AMOUNT,
        CAST(NET_AMOUNT AS DOUBLE) AS NET_AMOUNT) FROM enriched"""
    q["sales_summary"] = f"""WITH {SALES} SELECT * REPLACE (CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
        CAST(TOTAL_DISCOUNT AS DOUBLE) AS TOTAL_DISCOUNT) FROM sales"""
    q["monthly_kpi"] = f"""WITH {SALES} SELECT * REPLACE (CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
        CAST(TOTAL_DISCOUNT AS DOUBLE) AS TOTAL_DISCOUNT),
        {ratio(f"100 * {cents('TOTAL_DISCOUNT')}", cents('TOTAL_REVENUE + TOTAL_DISCOUNT'), 2)} AS DISCOUNT_RATE_PCT,
        CAST(SUM(TOTAL_REVENUE) OVER (PARTITION BY REGION ORDER BY MONTH, CHANNEL ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS CUMULATIVE_REVENUE
        FROM sales"""
    q["customer_360"] = f"WITH {C360} SELECT {C360_COLS} FROM c360"
    q["top_customers"] = f"""WITH {C360} SELECT {C360_COLS}, DENSE_RANK() OVER (ORDER BY c360.LIFETIME_VALUE DESC) AS LTV_RANK
        FROM c360 WHERE c360.LIFETIME_VALUE > 0 QUALIFY LTV_RANK <= 1000"""
    prefer = "\n".join(
        f", {t} AS (SELECT CUSTOMER_ID, {c} FROM (SELECT CUSTOMER_ID, {c}, ROW_NUMBER() OVER (PARTITION BY CUSTOMER_ID "
        f"ORDER BY COUNT(*) DESC, {c}) AS rn FROM enriched GROUP BY CUSTOMER_ID, {c}) WHERE rn = 1)"
        for t, c in [("pay", "PAYMENT_METHOD"), ("chan", "CHANNEL"), ("reg", "REGION")]
    )
    q["customer_360_wide"] = f"""WITH {C360} {prefer} SELECT c.CUSTOMER_ID, FIRST_NAME, LAST_NAME, EMAIL AS CUSTOMER_EMAIL, CUSTOMER_SEGMENT,
        CITY AS CUSTOMER_CITY, STATE AS CUSTOMER_STATE, TOTAL_ORDERS, CAST(LIFETIME_VALUE AS DOUBLE) AS LIFETIME_VALUE, AVG_ORDER_VALUE,
        FIRST_ORDER_DATE, LAST_ORDER_DATE, DAYS_SINCE_LAST_ORDER, PAYMENT_METHOD AS PREFERRED_PAYMENT, CHANNEL AS PREFERRED_CHANNEL,
        REGION AS PRIMARY_REGION, CANCELLED_ORDERS, ENGAGEMENT_STATUS, CUSTOMER_TIER
        FROM c360 c LEFT JOIN pay USING (CUSTOMER_ID) LEFT JOIN chan USING (CUSTOMER_ID) LEFT JOIN reg USING (CUSTOMER_ID)"""
    q["product_performance"] = f"WITH {FAN_OUT} SELECT {PERFORMANCE_COLS} FROM performance"
    q["product_performance_dedupe"] = f"""WITH {SEPARATE} SELECT p.PRODUCT_ID, PRODUCT_NAME, CATEGORY, SUB_CATEGORY, BRAND,
        CAST(UNIT_PRICE AS DOUBLE) AS UNIT_PRICE, CAST(COALESCE(units, 0) AS BIGINT) AS TOTAL_UNITS_SOLD,
        CAST(COALESCE(revenue, 0) AS DOUBLE) AS TOTAL_REVENUE, AVG_RATING, COALESCE(n_reviews, 0) AS REVIEW_COUNT, POSITIVE_REVIEW_PCT
        FROM products_b p LEFT JOIN sold USING (PRODUCT_ID) LEFT JOIN rated USING (PRODUCT_ID)"""
    q["product_performance_wide"] = f"""WITH {SEPARATE} SELECT p.PRODUCT_ID, PRODUCT_NAME, CATEGORY, SUB_CATEGORY, BRAND,
        CAST(UNIT_PRICE AS DOUBLE) AS LIST_PRICE, COALESCE(n_orders, 0) AS ORDERS_CONTAINING_PRODUCT,
        CAST(COALESCE(units, 0) AS BIGINT) AS TOTAL_UNITS_SOLD, CAST(COALESCE(revenue, 0) AS DOUBLE) AS TOTAL_REVENUE,
        AVG_SELLING_PRICE, AVG_DISCOUNT_PCT, AVG_RATING, COALESCE(n_reviews, 0) AS REVIEW_COUNT, POSITIVE_REVIEW_PCT
        FROM products_b p LEFT JOIN sold USING (PRODUCT_ID) LEFT JOIN rated USING (PRODUCT_ID)"""
    q["sales_summary_wide"] = f"""WITH {ENRICHED} SELECT ORDER_MONTH, ORDER_YEAR, REGION, CHANNEL, CUSTOMER_SEGMENT, ORDER_VALUE_TIER,
        COUNT(ORDER_ID) AS ORDER_COUNT, COUNT(DISTINCT CUSTOMER_ID) AS UNIQUE_CUSTOMERS, {money('SUM(TOTAL_AMOUNT)')} AS GROSS_REVENUE,
        {money('SUM(DISCOUNT_AMOUNT)')} AS TOTAL_DISCOUNTS, {money('SUM(NET_AMOUNT)')} AS NET_REVENUE, {avg('NET_AMOUNT', 2)} AS AVG_ORDER_VALUE,
        MEDIAN(CAST(NET_AMOUNT * 100 AS BIGINT)) / 100.0 AS MEDIAN_ORDER_VALUE, {money('MAX(NET_AMOUNT)')} AS MAX_ORDER_VALUE,
        COUNT(*) FILTER (ORDER_STATUS = 'CANCELLED') AS CANCELLED_ORDERS,
        {ratio("100 * COUNT(*) FILTER (ORDER_STATUS = 'CANCELLED')", 'COUNT(ORDER_ID)', 2)} AS CANCELLATION_RATE_PCT
        FROM enriched GROUP BY 1, 2, 3, 4, 5, 6"""
    q["region_revenue"] = f"WITH {SALES} SELECT REGION, {money('SUM(TOTAL_REVENUE)')} AS TOTAL_REVENUE FROM sales GROUP BY 1"
    q["customer_order_patterns"] = f"""WITH {ORDERS} SELECT ORDER_ID, CUSTOMER_ID, ORDER_DATE, {money('TOTAL_AMOUNT')} AS TOTAL_AMOUNT, REGION, CHANNEL,
        ROW_NUMBER() OVER w AS ORDER_SEQUENCE,
        {money('SUM(TOTAL_AMOUNT) OVER (w ROWS UNBOUNDED PRECEDING)')} AS RUNNING_TOTAL,
        {ratio('SUM(CAST(TOTAL_AMOUNT * 100 AS BIGINT)) OVER c', '(100 * COUNT(TOTAL_AMOUNT) OVER c)', 6)} AS AVG_ORDER_VALUE,
        datediff('day', LAG(ORDER_DATE) OVER w, ORDER_DATE) AS DAYS_SINCE_PREV_ORDER, COUNT(ORDER_ID) OVER c AS TOTAL_CUSTOMER_ORDERS
        FROM orders_b WINDOW w AS (PARTITION BY CUSTOMER_ID ORDER BY ORDER_DATE, ORDER_ID), c AS (PARTITION BY CUSTOMER_ID)"""
    q["processed_reviews"] = f"WITH {PROCESSED} SELECT * REPLACE (CAST(RATING AS DOUBLE) AS RATING) FROM processed"
    q["sentiment_distribution"] = f"""WITH {PROCESSED} SELECT SENTIMENT_LABEL, COUNT(*) AS COUNT, {avg('RATING', 2)} AS AVG_RATING,
        {avg('CAST(SENTIMENT_SCORE AS DECIMAL(9,2))', 2)} AS AVG_SENTIMENT_SCORE FROM processed GROUP BY 1"""
    q["product_sentiment"] = f"WITH {PRODUCT_SENTIMENT} SELECT * FROM product_sentiment"
    q["product_health"] = f"""WITH {FAN_OUT}, {PROCESSED.replace(REVIEWS + ", ", "")}, ps AS (
        SELECT PRODUCT_ID, {avg('CAST(SENTIMENT_SCORE AS DECIMAL(9,2))', 6)} AS AVG_SENTIMENT,
               COUNT(*) FILTER (SENTIMENT_LABEL = 'positive') AS POSITIVE_REVIEWS,
               COUNT(*) FILTER (SENTIMENT_LABEL = 'negative') AS NEGATIVE_REVIEWS,
               CAST(SUM(HELPFUL_VOTES) AS BIGINT) AS TOTAL_HELPFUL_VOTES FROM processed GROUP BY 1)
        SELECT {PERFORMANCE_COLS}, AVG_SENTIMENT, POSITIVE_REVIEWS, NEGATIVE_REVIEWS, TOTAL_HELPFUL_VOTES,
        CASE WHEN AVG_RATING >= 4.5 AND AVG_SENTIMENT > 0.3 THEN 'Star' WHEN AVG_RATING >= 4.0 AND AVG_SENTIMENT > 0.1 THEN 'Strong'
             WHEN AVG_RATING >= 3.0 THEN 'Average' WHEN AVG_RATING < 3.0 OR AVG_SENTIMENT < -0.1 THEN 'At Risk' ELSE 'Unrated' END AS PRODUCT_HEALTH_SCORE
        FROM performance LEFT JOIN ps USING (PRODUCT_ID)"""
    q["monthly_revenue_by_category"] = f"""WITH {CATEGORY_MONTHS}, m AS (
        SELECT ORDER_MONTH, CATEGORY, SUM(LINE_TOTAL) AS r, COUNT(ORDER_ITEM_ID) AS ITEM_COUNT, COUNT(DISTINCT ORDER_ID) AS ORDER_COUNT
        FROM joined GROUP BY 1, 2), l AS (SELECT *, LAG(r) OVER (PARTITION BY CATEGORY ORDER BY ORDER_MONTH) AS prev FROM m)
        SELECT ORDER_MONTH, CATEGORY, {money('r')} AS MONTHLY_REVENUE, ITEM_COUNT, ORDER_COUNT, {money('prev')} AS PREV_MONTH_REVENUE,
        {ratio(f"100 * ({cents('r')} - {cents('prev')})", cents('prev'), 2)} AS MOM_GROWTH_PCT FROM l"""
    return q


# --- change history ----------------------------------------------------------
STATES = ORDERS + """, old_o AS (SELECT * FROM orders_b WHERE ORDER_DATE < TIMESTAMP '2001-01-01 00:00:00'), new_o AS (
  SELECT * REPLACE (CASE WHEN ORDER_STATUS = 'Pending' THEN 'Shipped' ELSE ORDER_STATUS END AS ORDER_STATUS,
                    CAST(CASE WHEN ORDER_STATUS = 'Pending' THEN TOTAL_AMOUNT + 1 ELSE TOTAL_AMOUNT END AS DECIMAL(12,2)) AS TOTAL_AMOUNT)
  FROM orders_b WHERE ORDER_STATUS <> 'Cancelled'), changed AS (
  SELECT o.ORDER_ID FROM old_o o JOIN new_o n USING (ORDER_ID)
  WHERE o.ORDER_STATUS IS DISTINCT FROM n.ORDER_STATUS OR o.TOTAL_AMOUNT IS DISTINCT FROM n.TOTAL_AMOUNT)"""

AMOUNTS_AS_DOUBLE = """CAST(TOTAL_AMOUNT AS DOUBLE) AS TOTAL_AMOUNT, CAST(DISCOUNT_AMOUNT AS DOUBLE) AS DISCOUNT_AMOUNT,
  CAST(SHIPPING_AMOUNT AS DOUBLE) AS SHIPPING_AMOUNT"""

HISTORY = STATES + """, versions AS (
  SELECT o.*, '2001-01-01 00:00:00' AS EFFECTIVE_FROM,
         CASE WHEN n.ORDER_ID IS NULL OR o.ORDER_ID IN (SELECT ORDER_ID FROM changed) THEN '2001-08-02 00:00:00' ELSE '9999-12-31 00:00:00' END AS EFFECTIVE_TO,
         NOT (n.ORDER_ID IS NULL OR o.ORDER_ID IN (SELECT ORDER_ID FROM changed)) AS IS_CURRENT,
         CASE WHEN n.ORDER_ID IS NULL THEN 'DELETE' ELSE 'INSERT' END AS DML_TYPE
  FROM old_o o LEFT JOIN (SELECT ORDER_ID FROM new_o) n USING (ORDER_ID)
  UNION ALL
  SELECT n.*, '2001-08-02 00:00:00', '9999-12-31 00:00:00', TRUE,
         CASE WHEN n.ORDER_ID IN (SELECT ORDER_ID FROM old_o) THEN 'UPDATE' ELSE 'INSERT' END
  FROM new_o n WHERE n.ORDER_ID NOT IN (SELECT ORDER_ID FROM old_o) OR n.ORDER_ID IN (SELECT ORDER_ID FROM changed))"""


def daily(source: str, where: str = "TRUE") -> str:
    net = "TOTAL_AMOUNT - DISCOUNT_AMOUNT + SHIPPING_AMOUNT"
    return f"""SELECT CAST(ORDER_DATE AS DATE) AS METRIC_DATE, REGION, CHANNEL, COUNT(*) AS ORDER_COUNT, {money(f'SUM({net})')} AS TOTAL_REVENUE,
        {avg(net, 2)} AS AVG_ORDER_VALUE, COUNT(DISTINCT CUSTOMER_ID) AS NEW_CUSTOMERS FROM {source} WHERE {where} GROUP BY 1, 2, 3"""


def after_changes(tables: str) -> str:
    """The tables over the orders as they stand after the change batch."""
    return tables.replace(ORDERS, STATES).replace("FROM orders_b WHERE ORDER_DATE IS NOT NULL", "FROM new_o WHERE ORDER_DATE IS NOT NULL")


def change_history() -> dict[str, str]:
    q: dict[str, str] = {}
    q["order_changes"] = f"""WITH {STATES}, feed AS (
        SELECT *, 'DELETE' AS _action, ORDER_ID IN (SELECT ORDER_ID FROM changed) AS _is_update FROM old_o
        WHERE ORDER_ID IN (SELECT ORDER_ID FROM changed) OR ORDER_ID NOT IN (SELECT ORDER_ID FROM new_o)
        UNION ALL
        SELECT *, 'INSERT', ORDER_ID IN (SELECT ORDER_ID FROM changed) FROM new_o
        WHERE ORDER_ID IN (SELECT ORDER_ID FROM changed) OR ORDER_ID NOT IN (SELECT ORDER_ID FROM old_o))
        SELECT * REPLACE ({AMOUNTS_AS_DOUBLE}) FROM feed"""
    versions = f"""WITH {HISTORY} SELECT ORDER_ID, CUSTOMER_ID, ORDER_DATE, ORDER_STATUS, {money('TOTAL_AMOUNT')} AS TOTAL_AMOUNT,
        {money('TOTAL_AMOUNT - DISCOUNT_AMOUNT + SHIPPING_AMOUNT')} AS NET_AMOUNT, REGION, CHANNEL, SOURCE_SYSTEM,
        EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT, DML_TYPE FROM versions"""
    q["orders_scd2"] = q["orders_scd2_from_log"] = q["order_history_stream"] = q["order_history_catch_up"] = versions
    q["orders_history_view"] = f"WITH {HISTORY} SELECT ORDER_ID, ORDER_STATUS, IS_CURRENT, EFFECTIVE_FROM, EFFECTIVE_TO, DML_TYPE FROM versions"
    q["daily_order_metrics"] = f"WITH {HISTORY} {daily('versions', 'IS_CURRENT')}"
    q["upsert_daily"] = f"""WITH {STATES}, a AS ({daily('old_o')}), b AS ({daily('new_o')})
        SELECT *, TIMESTAMP '2001-08-02 00:00:00' AS UPDATED_AT FROM b
        UNION ALL SELECT *, TIMESTAMP '2001-01-01 00:00:00' FROM a
        WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.METRIC_DATE = a.METRIC_DATE AND b.REGION = a.REGION AND b.CHANNEL = a.CHANNEL)"""
    q["orders_scd2_keys"] = f"WITH {HISTORY} SELECT ORDER_ID, EFFECTIVE_FROM, TRUE AS KEY_OK FROM versions"
    q["order_state_history"], q["order_state_daily"] = versions, q["daily_order_metrics"]
    q["sales_summary_incremental"] = f"WITH {after_changes(SALES)} SELECT * REPLACE ({money('TOTAL_REVENUE')} AS TOTAL_REVENUE, {money('TOTAL_DISCOUNT')} AS TOTAL_DISCOUNT) FROM sales"
    q["customer_360_incremental"] = f"WITH {after_changes(C360)} SELECT {C360_COLS} FROM c360"
    quarter = "CAST(date_trunc('quarter', ORDER_MONTH) AS DATE)"
    levels = [("MONTH_REGION", "ORDER_MONTH", "REGION"), ("MONTH", "ORDER_MONTH", "NULL"), ("QUARTER", quarter, "NULL"),
              ("QUARTER_REGION", quarter, "REGION"), ("REGION", "NULL", "REGION"), ("ALL", "NULL", "NULL")]
    q["unique_customers_by_level"] = f"WITH {ENRICHED} " + " UNION ALL ".join(
        f"""SELECT '{name}' AS LEVEL, CAST({period} AS DATE) AS PERIOD, CAST({region} AS VARCHAR) AS REGION,
        COUNT(DISTINCT CUSTOMER_ID) AS UNIQUE_CUSTOMERS FROM enriched GROUP BY 1, 2, 3"""
        for name, period, region in levels
    )
    q["ticket_metrics"] = f"""WITH {TICKETS} SELECT DATE '{AS_OF}' AS METRIC_DATE, CATEGORY, PRIORITY, COUNT(*) AS TICKET_COUNT,
        {avg('RESOLUTION_TIME_HOURS', 2)} AS AVG_RESOLUTION_HRS, {avg('SATISFACTION_SCORE', 2)} AS AVG_SATISFACTION,
        COUNT(*) FILTER (STATUS IN ('Open', 'In Progress')) AS OPEN_TICKETS, TIMESTAMP '{AS_OF} 00:00:00' AS UPDATED_AT
        FROM tickets_b GROUP BY CATEGORY, PRIORITY"""
    return q


# --- events, exchange, semantic layer ------------------------------------------
DEVICE = "CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity' WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'motion' WHEN 'error' THEN 'vibration' END"

def asked() -> dict[str, str]:
    q: dict[str, str] = {}
    q["iot_alerts"] = f"""WITH i AS (SELECT 'DEV-' || CASE WHEN user_id < 100000 THEN right('0000' || CAST(user_id AS VARCHAR), 5) ELSE CAST(user_id AS VARCHAR) END AS DEVICE_ID, {DEVICE} AS DEVICE_TYPE, value AS SENSOR_VALUE,
        ts AS EVENT_TIMESTAMP FROM events)
        SELECT DEVICE_ID, DEVICE_TYPE, SENSOR_VALUE, CASE DEVICE_TYPE WHEN 'temperature' THEN 'celsius' WHEN 'humidity' THEN 'percent'
          WHEN 'pressure' THEN 'hPa' WHEN 'motion' THEN 'boolean' WHEN 'vibration' THEN 'mm/s' ELSE 'unit' END AS UNIT,
        COALESCE((DEVICE_TYPE = 'temperature' AND (SENSOR_VALUE > 32 OR SENSOR_VALUE < 16)) OR (DEVICE_TYPE = 'humidity' AND SENSOR_VALUE > 80)
          OR (DEVICE_TYPE = 'vibration' AND SENSOR_VALUE > 40), FALSE) AS ALERT_TRIGGERED, EVENT_TIMESTAMP FROM i"""
    q["clickstream_json"] = """SELECT CAST(event_id AS VARCHAR) AS EVENT_ID, user_id AS USER_ID, event_type AS EVENT_TYPE,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS PRODUCT_ID, ts AS EVENT_TIMESTAMP FROM events"""
    pairs = [
        ("CUSTOMERS", "customer"), ("PRODUCTS", "part"), ("ORDERS", "orders"), ("ORDER_ITEMS", "lineitem"),
        ("PRODUCT_REVIEWS", "documents"), ("SUPPORT_TICKETS", "conversations"),
        ("CLICKSTREAM", "events"), ("IOT_READINGS", "events"),
    ]
    q["row_counts"] = " UNION ALL ".join(f"SELECT '{n}' AS TABLE_NAME, COUNT(*) AS ROW_COUNT FROM {t}" for n, t in pairs)
    q["target_attainment"] = f"""WITH {SALES}, quarters AS (
        SELECT REGION, CHANNEL, year(MONTH) AS YEAR, quarter(MONTH) AS QUARTER, SUM(TOTAL_REVENUE) AS actual FROM sales GROUP BY 1, 2, 3, 4),
        t AS (SELECT REGION, YEAR + 1 AS YEAR, QUARTER, SUM((2 * 110 * {cents('actual')} + 100) // 200) AS target FROM quarters GROUP BY 1, 2, 3),
        s AS (SELECT REGION, YEAR, QUARTER, SUM(actual) AS actual FROM quarters GROUP BY 1, 2, 3)
        SELECT REGION, CAST(YEAR AS BIGINT) AS YEAR, CAST(QUARTER AS BIGINT) AS QUARTER, CAST(target AS DOUBLE) / 100 AS REVENUE_TARGET,
        {money('actual')} AS ACTUAL_REVENUE, {ratio(f"100 * {cents('actual')}", "target", 2)} AS ATTAINMENT_PCT,
        CASE WHEN {cents('actual')} >= target THEN 'Over' ELSE 'Under' END AS STATUS
        FROM t JOIN s USING (REGION, YEAR, QUARTER)"""
    q["semantic_region"] = f"WITH {ORDERS} SELECT REGION AS region, {money('SUM(TOTAL_AMOUNT)')} AS total_revenue, COUNT(ORDER_ID) AS order_count FROM orders_b GROUP BY 1"
    month = f"""SELECT CAST(date_trunc('month', ORDER_DATE) AS DATE) AS order_month, {avg('TOTAL_AMOUNT', 6)} AS average_order_value"""
    q["semantic_month"] = f"WITH {ORDERS} {month}, {money('SUM(TOTAL_AMOUNT)')} AS total_revenue FROM orders_b GROUP BY 1"
    q["semantic_segment"] = f"""WITH {ORDERS}, {CUSTOMERS} SELECT CUSTOMER_SEGMENT AS customer_segment, {money('SUM(TOTAL_AMOUNT)')} AS total_revenue,
        COUNT(ORDER_ID) AS order_count FROM orders_b LEFT JOIN customers_b USING (CUSTOMER_ID) WHERE year(ORDER_DATE) = 2000 GROUP BY 1"""
    q["semantic_rollup_month"], q["semantic_rollup_segment"] = q["semantic_month"], q["semantic_segment"]
    q["semantic_drill_across"] = f"""WITH {PRODUCTS}, {ITEMS}, {REVIEWS}, a AS (
        SELECT CATEGORY, BRAND, SUM(QUANTITY) AS u, SUM(LINE_TOTAL) AS r FROM items_b LEFT JOIN products_b USING (PRODUCT_ID) GROUP BY 1, 2), b AS (
        SELECT CATEGORY, BRAND, COUNT(REVIEW_ID) AS n, {avg('RATING', 6)} AS m FROM reviews_b LEFT JOIN products_b USING (PRODUCT_ID) GROUP BY 1, 2)
        SELECT COALESCE(a.CATEGORY, b.CATEGORY) AS category, COALESCE(a.BRAND, b.BRAND) AS brand, CAST(u AS BIGINT) AS total_units_sold,
        {money('r')} AS total_line_revenue, n AS review_count, m AS average_rating
        FROM a FULL JOIN b ON a.CATEGORY IS NOT DISTINCT FROM b.CATEGORY AND a.BRAND IS NOT DISTINCT FROM b.BRAND"""
    q["semantic_country"] = f"""WITH {ORDERS}, {CUSTOMERS}, {REVIEWS}, o AS (
        SELECT COUNTRY, CUSTOMER_SEGMENT, SUM(TOTAL_AMOUNT - DISCOUNT_AMOUNT + SHIPPING_AMOUNT) AS r, COUNT(*) FILTER (ORDER_STATUS = 'Cancelled') AS c
        FROM orders_b LEFT JOIN customers_b USING (CUSTOMER_ID) GROUP BY 1, 2), c AS (
        SELECT COUNTRY, CUSTOMER_SEGMENT, COUNT(CUSTOMER_ID) AS n FROM customers_b GROUP BY 1, 2), v AS (
        SELECT COUNTRY, CUSTOMER_SEGMENT, COUNT(REVIEW_ID) AS n FROM reviews_b LEFT JOIN customers_b USING (CUSTOMER_ID) GROUP BY 1, 2), k AS (
        SELECT COUNTRY, CUSTOMER_SEGMENT FROM o UNION SELECT COUNTRY, CUSTOMER_SEGMENT FROM c UNION SELECT COUNTRY, CUSTOMER_SEGMENT FROM v)
        SELECT k.COUNTRY AS customer_country, k.CUSTOMER_SEGMENT AS customer_segment, {money('o.r')} AS net_revenue, o.c AS cancelled_orders,
        c.n AS customer_count, v.n AS review_count FROM k
        LEFT JOIN o ON o.COUNTRY IS NOT DISTINCT FROM k.COUNTRY AND o.CUSTOMER_SEGMENT IS NOT DISTINCT FROM k.CUSTOMER_SEGMENT
        LEFT JOIN c ON c.COUNTRY IS NOT DISTINCT FROM k.COUNTRY AND c.CUSTOMER_SEGMENT IS NOT DISTINCT FROM k.CUSTOMER_SEGMENT
        LEFT JOIN v ON v.COUNTRY IS NOT DISTINCT FROM k.COUNTRY AND v.CUSTOMER_SEGMENT IS NOT DISTINCT FROM k.CUSTOMER_SEGMENT"""
    q["question_aov_last_month"] = f"WITH {ORDERS} {month} FROM orders_b GROUP BY 1 ORDER BY 1 DESC LIMIT 1"
    q["question_channel_customers"] = f"WITH {ORDERS} SELECT CHANNEL AS channel, COUNT(DISTINCT CUSTOMER_ID) AS unique_customers FROM orders_b GROUP BY 1"
    q["question_top_categories"] = f"""WITH {PRODUCTS}, {ITEMS} SELECT CATEGORY AS category, CAST(SUM(QUANTITY) AS BIGINT) AS total_units_sold
        FROM items_b LEFT JOIN products_b USING (PRODUCT_ID) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
    q["question_category_sales"] = f"""WITH {PRODUCTS}, {ITEMS} SELECT CATEGORY AS category, {money('SUM(LINE_TOTAL)')} AS revenue,
        COUNT(DISTINCT ORDER_ID) AS orders, {ratio("SUM(CAST(LINE_TOTAL * 100 AS BIGINT))", "100 * COUNT(DISTINCT ORDER_ID)", 2)} AS average_order_value
        FROM items_b LEFT JOIN products_b USING (PRODUCT_ID) GROUP BY 1"""
    q["question_category_support"] = f"""WITH {PRODUCTS}, {REVIEWS}, {TICKETS} SELECT 'ECONOMY' AS category,
        (SELECT COUNT(*) FROM tickets_b JOIN products_b USING (PRODUCT_ID) WHERE products_b.CATEGORY = 'ECONOMY') AS ticket_count,
        {avg('RATING', 6)} AS average_rating, COUNT(REVIEW_ID) AS review_count
        FROM reviews_b JOIN products_b USING (PRODUCT_ID) WHERE CATEGORY = 'ECONOMY'"""
    q["question_net_revenue"] = f"""WITH {ORDERS} SELECT REGION AS region, {money('SUM(TOTAL_AMOUNT - DISCOUNT_AMOUNT + SHIPPING_AMOUNT)')} AS net_revenue
        FROM orders_b WHERE year(ORDER_DATE) = 2000 GROUP BY 1"""
    return q


# --- search ----------------------------------------------------------------------
def postings(docs: str, doc_id: str, text: str) -> str:
    return rf"""words AS (
  SELECT {doc_id} AS d, list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {docs}), sizes AS (
  SELECT d, COALESCE(len(w), 0) AS dl FROM words), stats AS (SELECT COUNT(*) AS n, AVG(dl) AS al FROM sizes), posts AS (
  SELECT d, t, COUNT(*) AS tf FROM (SELECT d, unnest(w) AS t FROM words) GROUP BY 1, 2), qterms AS (
  SELECT q, t, COUNT(*) AS qtf FROM (SELECT item_id AS q,
    unnest(list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) AS t FROM benchmark) GROUP BY 1, 2), freq AS (
  SELECT t, COUNT(*) AS df FROM posts GROUP BY 1)"""


def bm25(where: str = "TRUE") -> str:
    return f"""bm25 AS (
  SELECT q, posts.d, round(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / al))), 6) AS s
  FROM qterms JOIN freq USING (t) JOIN posts USING (t) JOIN sizes ON sizes.d = posts.d, stats WHERE {where} GROUP BY 1, 2)"""


COSINE = """dnorm AS (SELECT d, sqrt(SUM((1 + ln(tf)) * (1 + ln(tf)))) AS nd FROM posts GROUP BY 1), qw AS (
  SELECT q, t, (1 + ln(qtf)) * ln(n / df) AS wq FROM qterms JOIN freq USING (t), stats), qnorm AS (
  SELECT q, sqrt(SUM(wq * wq)) AS nq FROM qw GROUP BY 1), cosine AS (
  SELECT q, d, round(SUM(wq / nq * (1 + ln(tf)) / nd), 6) AS s, SUM(wq / nq * (1 + ln(tf)) / nd) AS raw
  FROM qw JOIN qnorm USING (q) JOIN posts USING (t) JOIN dnorm USING (d) WHERE nq > 0 GROUP BY 1, 2 HAVING raw > 0)"""


def top(source: str, k: int) -> str:
    return f"""SELECT q, d, s, ROW_NUMBER() OVER (PARTITION BY q ORDER BY s DESC, d) AS r FROM {source} QUALIFY r <= {k}"""


def searched() -> dict[str, str]:
    q: dict[str, str] = {}
    out = "SELECT q AS QUERY_ID, d AS DOC_ID, s AS SCORE, r AS RANK FROM"
    index = postings("documents", "doc_id", "text")
    q["review_search_docs"] = f"""WITH {PRODUCTS}, {PROCESSED} SELECT REVIEW_ID, REVIEW_TEXT, CAST(RATING AS DOUBLE) AS RATING, REVIEW_DATE, HELPFUL_VOTES,
        PRODUCT_NAME, CATEGORY, BRAND, SENTIMENT_LABEL, SENTIMENT_SCORE FROM processed LEFT JOIN products_b USING (PRODUCT_ID)"""
    q["ticket_search_docs"] = f"""WITH {PRODUCTS}, {CUSTOMERS}, {TICKETS} SELECT TICKET_ID, TICKET_SUBJECT || '. ' || COALESCE(TICKET_DESCRIPTION, '') AS TICKET_CONTENT,
        TICKET_SUBJECT, t.CATEGORY, PRIORITY, STATUS, CAST(RESOLUTION_TIME_HOURS AS DOUBLE) AS RESOLUTION_TIME_HOURS,
        CAST(SATISFACTION_SCORE AS DOUBLE) AS SATISFACTION_SCORE, CREATED_AT, CUSTOMER_SEGMENT, STATE AS CUSTOMER_STATE,
        COALESCE(PRODUCT_NAME, 'N/A') AS PRODUCT_NAME, COALESCE(p.CATEGORY, 'N/A') AS PRODUCT_CATEGORY
        FROM tickets_b t LEFT JOIN customers_b c USING (CUSTOMER_ID) LEFT JOIN products_b p USING (PRODUCT_ID)"""
    q["keyword_search"] = f"WITH {index}, {bm25()} {out} ({top('bm25', 5)})"
    rated = bm25("posts.d IN (SELECT REVIEW_ID FROM reviews_b WHERE RATING >= 4)")
    q["keyword_search_filtered"] = f"""WITH {PRODUCTS}, {PROCESSED}, {index}, {rated}, best AS ({top('bm25', 5)})
        SELECT q AS QUERY_ID, d AS REVIEW_ID, s AS SCORE, r AS RANK, PRODUCT_NAME, CAST(RATING AS DOUBLE) AS RATING, SENTIMENT_LABEL
        FROM best JOIN processed ON d = REVIEW_ID LEFT JOIN products_b USING (PRODUCT_ID)"""
    q["search_index_build"] = f"WITH {index} SELECT t AS TERM, COUNT(*) AS DOCUMENTS, CAST(SUM(tf) AS BIGINT) AS OCCURRENCES FROM posts GROUP BY 1"
    q["search_index_blocks"] = f"""WITH {index}, dnorm AS (SELECT d, sqrt(SUM((1 + ln(tf)) * (1 + ln(tf)))) AS nd FROM posts GROUP BY 1), shares AS (
        SELECT t, d, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / al)) AS ks, (1 + ln(tf)) / nd AS vs
        FROM posts JOIN sizes USING (d) JOIN dnorm USING (d), stats), cut AS (
        SELECT *, (ROW_NUMBER() OVER (PARTITION BY t ORDER BY ks DESC, d) - 1) // 128 AS b FROM shares)
        SELECT t AS TERM, b AS BLOCK, COUNT(*) AS POSTINGS, round(MAX(ks), 6) AS KEYWORD_SHARE, round(MAX(vs), 6) AS VECTOR_SHARE
        FROM cut GROUP BY 1, 2"""
    q["text_vector_search"] = f"WITH {index}, {COSINE} {out} ({top('cosine', 5)})"
    q["hybrid_search"] = f"""WITH {index}, {bm25()}, {COSINE}, a AS ({top('bm25', 20)}), b AS ({top('cosine', 20)}), fused AS (
        SELECT q, d, round(SUM(1.0::DOUBLE / (60 + r)), 9) AS s FROM (SELECT q, d, r FROM a UNION ALL SELECT q, d, r FROM b) GROUP BY 1, 2)
        {out} ({top('fused', 10)})"""
    q["vector_topk"] = f"""WITH c AS (SELECT label, list(x ORDER BY pos) AS v FROM (
          SELECT label, pos, AVG(CAST(embedding[pos] AS DOUBLE)) AS x FROM embeddings, generate_series(1, 64) g(pos) GROUP BY 1, 2) GROUP BY 1), sims AS (
        SELECT CAST(c.label AS BIGINT) AS q, vec_id AS d, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 6) AS s FROM embeddings, c)
        SELECT q AS QUERY_ID, d AS VEC_ID, s AS SCORE, r AS RANK FROM ({top('sims', 10)})"""
    q["vector_topk_grouped"] = q["vector_topk"]
    return q


# --- features, splits, model quality ------------------------------------------
TICKET_FEATURES = PRODUCTS + ", " + CUSTOMERS + ", " + ORDERS + ", " + TICKETS + f""", spend AS (
  SELECT CUSTOMER_ID, COUNT(ORDER_ID) AS n, SUM(TOTAL_AMOUNT) AS s, {avg('TOTAL_AMOUNT', 6)} AS a FROM orders_b GROUP BY 1), feats AS (
  SELECT TICKET_ID, PRIORITY, t.CATEGORY, CUSTOMER_SEGMENT, STATUS, length(TICKET_DESCRIPTION) AS TICKET_DESC_LENGTH, length(TICKET_SUBJECT) AS TICKET_SUBJECT_LENGTH,
         len(string_split(TICKET_DESCRIPTION, ' ')) AS TICKET_WORD_COUNT,
         COALESCE(datediff('day', REGISTRATION_DATE, CAST(CREATED_AT AS DATE)), 0) AS DAYS_AS_CUSTOMER, hour(CREATED_AT) AS TICKET_HOUR,
         dayofweek(CREATED_AT) AS TICKET_DAY_OF_WEEK, CASE WHEN t.PRODUCT_ID IS NULL THEN 0 ELSE 1 END AS HAS_PRODUCT,
         COALESCE(CAST(UNIT_PRICE AS DOUBLE), 0.0) AS UNIT_PRICE, COALESCE(n, 0) AS CUSTOMER_ORDER_COUNT,
         COALESCE(CAST(s AS DOUBLE), 0.0) AS CUSTOMER_TOTAL_SPEND, COALESCE(a, 0.0) AS CUSTOMER_AVG_ORDER
  FROM tickets_b t LEFT JOIN customers_b USING (CUSTOMER_ID) LEFT JOIN products_b p ON t.PRODUCT_ID = p.PRODUCT_ID LEFT JOIN spend USING (CUSTOMER_ID))"""

TICKET_NUMERIC = (
    "TICKET_DESC_LENGTH TICKET_SUBJECT_LENGTH TICKET_WORD_COUNT DAYS_AS_CUSTOMER TICKET_HOUR TICKET_DAY_OF_WEEK UNIT_PRICE "
    "CUSTOMER_ORDER_COUNT CUSTOMER_TOTAL_SPEND CUSTOMER_AVG_ORDER"
).split()
REVENUE_NUMERIC = (
    "ORDER_COUNT UNIQUE_CUSTOMERS TOTAL_UNITS AVG_DISCOUNT REVENUE_LAG_1 REVENUE_LAG_2 REVENUE_LAG_3 REVENUE_MA_3 ORDER_COUNT_LAG_1"
).split()
MA3 = ratio(
    "SUM(CAST(r * 100 AS BIGINT)) OVER (PARTITION BY CATEGORY ORDER BY ORDER_MONTH ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)",
    "(100 * COUNT(r) OVER (PARTITION BY CATEGORY ORDER BY ORDER_MONTH ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))",
    6,
)

REVENUE_FEATURES = CATEGORY_MONTHS + f""", m AS (
  SELECT ORDER_MONTH, CATEGORY, SUM(LINE_TOTAL) AS r, COUNT(DISTINCT ORDER_ID) AS ORDER_COUNT, COUNT(DISTINCT CUSTOMER_ID) AS UNIQUE_CUSTOMERS,
         CAST(SUM(QUANTITY) AS BIGINT) AS TOTAL_UNITS, {avg('DISCOUNT_PCT', 6)} AS AVG_DISCOUNT FROM joined GROUP BY 1, 2), lagged AS (
  SELECT *, LAG(r, 1) OVER w AS l1, LAG(r, 2) OVER w AS l2, LAG(r, 3) OVER w AS l3, LAG(ORDER_COUNT) OVER w AS ORDER_COUNT_LAG_1, {MA3} AS REVENUE_MA_3
  FROM m WINDOW w AS (PARTITION BY CATEGORY ORDER BY ORDER_MONTH)), rev AS (
  SELECT ORDER_MONTH, CATEGORY, {money('r')} AS MONTHLY_REVENUE, ORDER_COUNT, UNIQUE_CUSTOMERS, TOTAL_UNITS, AVG_DISCOUNT,
         month(ORDER_MONTH) AS MONTH_NUM, quarter(ORDER_MONTH) AS QUARTER, year(ORDER_MONTH) AS YEAR,
         {money('l1')} AS REVENUE_LAG_1, {money('l2')} AS REVENUE_LAG_2, {money('l3')} AS REVENUE_LAG_3, REVENUE_MA_3, ORDER_COUNT_LAG_1,
         CASE WHEN l1 > 0 THEN {ratio(f"100 * ({cents('r')} - {cents('l1')})", cents('l1'), 2)} END AS REVENUE_GROWTH_PCT
  FROM lagged WHERE l3 IS NOT NULL)"""

RULE = TICKETS + """, rule AS (
  SELECT CASE PRIORITY WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS y,
         CASE WHEN RESOLUTION_TIME_HOURS >= 180 THEN 0 WHEN RESOLUTION_TIME_HOURS >= 120 THEN 1 WHEN RESOLUTION_TIME_HOURS >= 60 THEN 2 ELSE 3 END AS p
  FROM tickets_b)"""

FORECAST = REVENUE_FEATURES + """, forecast AS (
  SELECT ORDER_MONTH, CATEGORY, MONTHLY_REVENUE, REVENUE_MA_3 AS PREDICTED_REVENUE, MONTHLY_REVENUE - REVENUE_MA_3 AS RESIDUAL,
         round(CASE WHEN MONTHLY_REVENUE <> 0 THEN abs(MONTHLY_REVENUE - REVENUE_MA_3) / MONTHLY_REVENUE * 100 END, 2) AS PCT_ERROR FROM rev)"""


def errors(yhat: str) -> str:
    y, e = "MONTHLY_REVENUE", f"(MONTHLY_REVENUE - {yhat})"
    return f"""round(AVG(ABS({e})), 4) AS MAE, round(AVG({e} * {e}), -4) AS MSE, round(sqrt(AVG({e} * {e})), 4) AS RMSE,
        round(1 - SUM({e} * {e}) / (var_pop({y}) * COUNT({y})), 4) AS R2, round(AVG(CASE WHEN {y} <> 0 THEN ABS({e}) / {y} * 100 END), 4) AS MAPE,
        COUNT(*) AS TEST_ROWS"""


def learned() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ticket_features"] = f"WITH {TICKET_FEATURES} SELECT * FROM feats"
    q["revenue_features"] = f"WITH {REVENUE_FEATURES} SELECT * FROM rev"
    scaled = ", ".join(
        f"round((CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()) / COALESCE(NULLIF(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 1), 6) AS {c}_SCALED"
        for c in TICKET_NUMERIC
    )
    coded = ", ".join(
        f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {o}"
        for c, o in [("CATEGORY", "CATEGORY_ENCODED"), ("CUSTOMER_SEGMENT", "SEGMENT_ENCODED"), ("STATUS", "STATUS_ENCODED")]
    )
    q["ticket_model_table"] = f"""WITH {TICKET_FEATURES} SELECT TICKET_ID, PRIORITY,
        CASE PRIORITY WHEN 'Low' THEN 0.0::DOUBLE WHEN 'Medium' THEN 1.0 WHEN 'High' THEN 2.0 WHEN 'Critical' THEN 3.0 END AS PRIORITY_ENCODED,
        {coded}, HAS_PRODUCT, {scaled} FROM feats"""
    ranged = ", ".join(
        f"round((CAST({c} AS DOUBLE) - MIN(CAST({c} AS DOUBLE)) OVER ()) / COALESCE(NULLIF(MAX(CAST({c} AS DOUBLE)) OVER () - MIN(CAST({c} AS DOUBLE)) OVER (), 0), 1), 6) AS {c}_SCALED"
        for c in REVENUE_NUMERIC
    )
    q["revenue_model_table"] = f"""WITH {REVENUE_FEATURES} SELECT ORDER_MONTH, CATEGORY, MONTHLY_REVENUE,
        CAST(DENSE_RANK() OVER (ORDER BY CATEGORY) - 1 AS DOUBLE) AS CATEGORY_ENCODED, MONTH_NUM, QUARTER, YEAR, {ranged}, REVENUE_GROWTH_PCT FROM rev"""
    q["class_distribution"] = f"WITH {TICKETS} SELECT PRIORITY, COUNT(*) AS COUNT FROM tickets_b GROUP BY 1"
    q["ticket_features_describe"] = f"WITH {TICKET_FEATURES} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "COLUMN", COUNT({c}) AS COUNT, round(AVG(CAST({c} AS DOUBLE)), 6) AS MEAN, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS STDDEV,
        round(MIN(CAST({c} AS DOUBLE)), 6) AS MIN, round(MAX(CAST({c} AS DOUBLE)), 6) AS MAX FROM feats"""
        for c in TICKET_NUMERIC
    )
    q["chrono_split"] = f"""WITH {REVENUE_FEATURES}, months AS (SELECT ORDER_MONTH, ROW_NUMBER() OVER (ORDER BY ORDER_MONTH) - 1 AS i, COUNT(*) OVER () AS n
        FROM (SELECT DISTINCT ORDER_MONTH FROM rev)), cut AS (SELECT ORDER_MONTH AS c FROM months WHERE i = CAST(floor(n * 0.8::DOUBLE) AS BIGINT))
        SELECT ORDER_MONTH, CATEGORY, MONTHLY_REVENUE, CASE WHEN ORDER_MONTH < c THEN 'train' ELSE 'test' END AS SPLIT FROM rev, cut"""
    q["hash_split"] = f"""WITH {TICKETS} SELECT TICKET_ID,
        CASE WHEN CAST('0x' || substr(md5('42:' || CAST(TICKET_ID AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS SPLIT FROM tickets_b"""
    cells = ", ".join(f'COUNT(*) FILTER (p = {i}) AS "{i}"' for i in range(4))
    q["confusion_matrix"] = f"WITH {RULE} SELECT CAST(y AS BIGINT) AS TRUE_CLASS, {cells} FROM rule GROUP BY 1"
    q["classification_metrics"] = f"""WITH {RULE}, k AS (SELECT c, (SELECT COUNT(*) FROM rule WHERE y = c) AS s, (SELECT COUNT(*) FROM rule WHERE p = c) AS g,
        (SELECT COUNT(*) FROM rule WHERE y = c AND p = c) AS h FROM (SELECT y AS c FROM rule UNION SELECT p FROM rule)), m AS (
        SELECT s, h, CASE WHEN g > 0 THEN CAST(h AS DOUBLE) / g ELSE 0 END AS pr, CASE WHEN s > 0 THEN CAST(h AS DOUBLE) / s ELSE 0 END AS re FROM k)
        SELECT round(CAST(SUM(h) AS DOUBLE) / SUM(s), 6) AS ACCURACY, round(SUM(pr * s) / SUM(s), 6) AS PRECISION_WEIGHTED,
        round(SUM(re * s) / SUM(s), 6) AS RECALL_WEIGHTED,
        round(SUM(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END * s) / SUM(s), 6) AS F1_WEIGHTED, CAST(SUM(s) AS BIGINT) AS TEST_ROWS FROM m"""
    q["regression_metrics"] = f"WITH {REVENUE_FEATURES} SELECT {errors('REVENUE_MA_3')} FROM rev"
    q["model_comparison"] = f"""WITH {REVENUE_FEATURES}, both_models AS (SELECT 'MovingAverage' AS MODEL, {errors('REVENUE_MA_3')} FROM rev
        UNION ALL SELECT 'LastMonth', {errors('REVENUE_LAG_1')} FROM rev) SELECT *, R2 = MAX(R2) OVER () AS IS_BEST FROM both_models"""
    q["prediction_table"] = f"""WITH {FORECAST} SELECT ORDER_MONTH, CATEGORY, MONTHLY_REVENUE, round(PREDICTED_REVENUE, 4) AS PREDICTED_REVENUE,
        round(RESIDUAL, 4) AS RESIDUAL, PCT_ERROR, 'MovingAverage' AS MODEL_NAME, 'v1' AS MODEL_VERSION FROM forecast"""
    q["residual_summary"] = f"""WITH {FORECAST} SELECT round(AVG(RESIDUAL), 4) AS MEAN_RESIDUAL, round(stddev_samp(RESIDUAL), 4) AS STD_RESIDUAL,
        round(MIN(RESIDUAL), 4) AS MIN_RESIDUAL, round(MAX(RESIDUAL), 4) AS MAX_RESIDUAL, round(AVG(PCT_ERROR), 4) AS AVG_PCT_ERROR FROM forecast"""
    q["residual_by_category"] = f"""WITH {FORECAST} SELECT CATEGORY, round(AVG(PCT_ERROR), 4) AS AVG_PCT_ERROR, round(AVG(RESIDUAL), 4) AS AVG_RESIDUAL,
        COUNT(*) AS COUNT FROM forecast GROUP BY 1"""
    return q


def streamed() -> dict[str, str]:
    good = "s_suppkey % 11 <> 0"
    return {
        "csv_ingest_stream": f"""SELECT 'STORE-' || CAST(s_suppkey AS VARCHAR) AS STORE_ID, s_name || ', main floor' AS STORE_NAME, r_name AS REGION,
            n_name AS CITY, CAST(NULL AS VARCHAR) AS STATE, r_name AS COUNTRY,
            CASE s_suppkey % 4 WHEN 0 THEN 'Flagship' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Outlet' ELSE 'Online' END AS STORE_TYPE,
            CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE DATE '2001-03-04' END AS OPEN_DATE, s_acctbal > 0 AS IS_ACTIVE,
            TIMESTAMP '2001-08-02 00:00:00' AS LOADED_AT
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE {good}""",
        "load_history": f"""SELECT 'STORE_LOCATIONS' AS TABLE_NAME, COUNT(*) FILTER ({good}) AS ROW_COUNT, COUNT(*) FILTER (NOT ({good})) AS ERROR_COUNT,
            TIMESTAMP '2001-08-02 00:00:00' AS LAST_LOAD_TIME FROM supplier""",
        "enrich_stream": silver_and_gold()["orders_enriched"],
        "load_status": f"""WITH f AS (SELECT CASE WHEN s_suppkey % 22 = 0 THEN 'broken' WHEN s_suppkey % 2 = 0 THEN 'clean' ELSE 'mixed' END AS FILE_NAME,
            {good} AS good FROM supplier)
            SELECT 'STORE_LOCATIONS' AS TABLE_NAME, FILE_NAME, CASE WHEN COUNT(*) FILTER (NOT good) = 0 THEN 'LOADED'
            WHEN COUNT(*) FILTER (good) > 0 THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS STATUS, COUNT(*) FILTER (good) AS ROW_COUNT,
            COUNT(*) FILTER (NOT good) AS ERROR_COUNT, TIMESTAMP '2001-08-02 00:00:00' AS LAST_LOAD_TIME FROM f GROUP BY FILE_NAME""",
    }


CUT = """months AS (SELECT ORDER_MONTH, ROW_NUMBER() OVER (ORDER BY ORDER_MONTH) - 1 AS i, COUNT(*) OVER () AS n
  FROM (SELECT DISTINCT ORDER_MONTH FROM rev)), cut AS (SELECT ORDER_MONTH AS c FROM months WHERE i = CAST(floor(n * 0.8::DOUBLE) AS BIGINT))"""


def by_name_and_nested() -> dict[str, str]:
    product = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
    return {
        "nested_elements": f"""SELECT event_id // 20 AS MESSAGE_ID, ROW_NUMBER() OVER (PARTITION BY event_id // 20 ORDER BY event_id) - 1 AS POS,
            event_id AS EVENT_ID, event_type AS EVENT_TYPE, value AS VALUE, {product} AS PRODUCT_ID FROM events""",
        "nested_paths": f"""SELECT event_id // 20 AS MESSAGE_ID, COUNT(*) AS N, MIN(event_id) AS FIRST_ID, arg_min(event_type, event_id) AS FIRST_TYPE,
            arg_min({product}, event_id) AS FIRST_PRODUCT, CAST(NULL AS VARCHAR) AS MISSING FROM events GROUP BY 1""",
        "sentiment_sql": f"WITH {PROCESSED} SELECT REVIEW_ID, SENTIMENT_SCORE, SENTIMENT_LABEL, SENTIMENT_CONFIDENCE FROM processed",
        "linreg_sql": f"""WITH {REVENUE_FEATURES}, line AS (
            SELECT regr_slope(MONTHLY_REVENUE, REVENUE_MA_3) AS b, regr_intercept(MONTHLY_REVENUE, REVENUE_MA_3) AS a FROM rev)
            SELECT ORDER_MONTH, CATEGORY, round(a + b * REVENUE_MA_3, 1) AS PREDICTED_REVENUE FROM rev, line""",
        "semantic_synonyms": f"""WITH {ORDERS} SELECT REGION AS region, CHANNEL AS channel, {money('SUM(TOTAL_AMOUNT)')} AS REVENUE,
            {avg('TOTAL_AMOUNT', 6)} AS AOV, COUNT(ORDER_ID) AS ORDERS FROM orders_b GROUP BY 1, 2""",
        "catalog_listing": f"""WITH {STATES} SELECT 'orders_before' AS TABLE_NAME, 'MANAGED' AS TABLE_TYPE, COUNT(*) AS ROW_COUNT FROM old_o
            UNION ALL SELECT 'customers', 'MANAGED', COUNT(*) FROM customer""",
        "bulk_load_stores": streamed()["csv_ingest_stream"],
        "changes_without_initial": change_history()["order_changes"],
        "model_reload": f"""WITH {REVENUE_FEATURES}, {CUT} SELECT ORDER_MONTH, COUNT(*) AS N, TRUE AS SAME,
            CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS METRIC_ROWS FROM rev, cut WHERE ORDER_MONTH >= c GROUP BY 1""",
        "boosted_facts": f"""WITH {REVENUE_FEATURES}, {CUT} SELECT COUNT(*) AS TEST_ROWS, TRUE AS BETTER_THAN_MEAN,
            TRUE AS FULLY_SHRUNK_IS_MEAN FROM rev, cut WHERE ORDER_MONTH >= c""",
        "random_order_numbers": """SELECT o_orderkey AS ORDER_ID,
            ROW_NUMBER() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS PLACE FROM orders""",
    }


REVENUE_INPUTS = ["CATEGORY_ENCODED", "MONTH_NUM", "QUARTER", "YEAR", *[f"{c}_SCALED" for c in REVENUE_NUMERIC]]


def kept() -> dict[str, str]:
    """Storage operators and facts about models."""
    wide = silver_and_gold()["customer_360_wide"]
    before = "ORDER_DATE < TIMESTAMP '2001-01-01 00:00:00'"
    split = "CAST('0x' || substr(md5('42:' || CAST(TICKET_ID AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80"
    tested = f"""WITH {TICKETS} SELECT CASE PRIORITY WHEN 'Low' THEN 0.0::DOUBLE WHEN 'Medium' THEN 1.0 WHEN 'High' THEN 2.0 ELSE 3.0 END AS PRIORITY_ENCODED,
        COUNT(*) AS N, CAST(SUM(TICKET_ID) AS BIGINT) AS ID_SUM, TRUE AS LABELS_ONLY FROM tickets_b WHERE {split} GROUP BY 1"""
    layers = {**silver_and_gold(), **change_history(), **learned()}
    tables = ["orders_cleaned", "orders_enriched", "processed_reviews", "customer_order_patterns", "monthly_revenue_by_category",
              "sales_summary", "customer_360", "product_performance", "top_customers", "monthly_kpi", "product_health"]
    counted = [(n.upper(), f"({layers[n]}) x") for n in tables] + [
        ("PRODUCT_SENTIMENT_SUMMARY", f"({layers['product_sentiment']}) x"), ("SUPPORT_TICKET_METRICS", f"({layers['ticket_metrics']}) x"),
        ("ORDERS_SCD2", "orders"),
        ("DAILY_ORDER_METRICS", f"(WITH {ORDERS} SELECT DISTINCT CAST(ORDER_DATE AS DATE), REGION, CHANNEL FROM orders_b) x"),
    ]
    return {
        "daily_metrics_stream": change_history()["daily_order_metrics"],
        "layer_refresh_counts": " UNION ALL ".join(f"SELECT '{n}' AS TABLE_NAME, COUNT(*) AS ROW_COUNT FROM {t}" for n, t in counted),
        "json_feed": "SELECT event_id, user_id, event_type, value, props FROM events",
        "append_defaults": f"""WITH {CUSTOMERS} SELECT EMAIL, FIRST_NAME, 'unknown' AS COUNTRY, TIMESTAMP '2001-08-02 00:00:00' AS CREATED_AT,
            CAST(NULL AS VARCHAR) AS PHONE, COUNT(*) AS N, TRUE AS KEY_OK, CAST((SELECT COUNT(*) FROM customers_b) AS BIGINT) AS KEYS
            FROM customers_b GROUP BY EMAIL, FIRST_NAME""",
        "append_reconcile": f"""WITH {ORDERS} SELECT 'BEFORE' AS PHASE, 'ORDERS' AS TABLE_NAME, COUNT(*) FILTER ({before}) AS ROW_COUNT FROM orders_b
            UNION ALL SELECT 'AFTER', 'ORDERS', COUNT(*) FROM orders_b""",
        "snapshot_pinned": f"""WITH {ORDERS} SELECT ORDER_ID, ORDER_STATUS, {money('TOTAL_AMOUNT')} AS TOTAL_AMOUNT,
            COALESCE(ORDER_STATUS <> 'Cancelled', FALSE) AS IN_LATEST FROM orders_b WHERE {before}""",
        "export_gold": f"SELECT *, TIMESTAMP '2001-08-02 00:00:00' AS EXPORTED_AT FROM ({wide}) w",
        "rf_facts": tested,
        "lr_facts": tested,
        "importance_facts": "SELECT CAST(14 AS BIGINT) AS FEATURES, 1.0::DOUBLE AS TOTAL, TRUE AS NOT_NEGATIVE",
        "gbt_facts": f"""WITH {REVENUE_FEATURES}, months AS (SELECT ORDER_MONTH, ROW_NUMBER() OVER (ORDER BY ORDER_MONTH) - 1 AS i, COUNT(*) OVER () AS n
            FROM (SELECT DISTINCT ORDER_MONTH FROM rev)), cut AS (SELECT ORDER_MONTH AS c FROM months WHERE i = CAST(floor(n * 0.8::DOUBLE) AS BIGINT))
            SELECT ORDER_MONTH, COUNT(*) AS N, round(SUM(MONTHLY_REVENUE), 2) AS REVENUE, TRUE AS ALL_PREDICTED FROM rev, cut WHERE ORDER_MONTH >= c GROUP BY 1""",
        "linreg_normal_equations": "SELECT unnest([" + ", ".join(f"'{c}'" for c in REVENUE_INPUTS) + "]) AS FEATURE, TRUE AS ORTHOGONAL",
    }


def oracle_sql() -> dict[str, str]:
    return {**silver_and_gold(), **change_history(), **asked(), **searched(), **learned(), **streamed(), **kept(), **by_name_and_nested()}
