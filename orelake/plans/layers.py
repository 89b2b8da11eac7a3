"""All layers in dependency order, each written once and read back by its consumers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from orelake.operators.history import table_changes
from orelake.plans import gold, metrics, silver


def refresh(bronze: dict[str, DataFrame], out: str, as_of: date, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Build Silver and Gold under ``out`` and return the stored tables by name.

    Writing every layer cuts lineage: a lost executor costs a re-read, not a
    recomputation from Bronze.
    """
    done: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/{name}"
        df.write.format(fmt).mode("overwrite").save(path)
        done[name] = df.sparkSession.read.format(fmt).load(path)
        return done[name]

    cleaned = put("orders_cleaned", silver.orders_cleaned(bronze["orders"]))
    enriched = put("orders_enriched", silver.orders_enriched(cleaned, bronze["customers"]))
    processed = put("processed_reviews", silver.processed_reviews(bronze["product_reviews"]))
    sentiment = put("product_sentiment_summary", silver.product_sentiment_summary(processed, bronze["products"]))
    put("customer_order_patterns", silver.customer_order_patterns(bronze["orders"]))
    put(
        "monthly_revenue_by_category",
        silver.monthly_revenue_by_category(bronze["orders"], bronze["order_items"], bronze["products"]),
    )

    images = table_changes(bronze["orders"].limit(0), bronze["orders"], "ORDER_ID")
    history = put("orders_scd2", metrics.orders_scd2(None, images, as_of))
    put("daily_order_metrics", metrics.daily_order_metrics(history))
    tickets = bronze["support_tickets"]
    put("support_ticket_metrics", metrics.support_ticket_metrics(table_changes(tickets.limit(0), tickets, "TICKET_ID"), as_of))

    sales = put("sales_summary", gold.sales_summary(enriched))
    c360 = put("customer_360", gold.customer_360(bronze["customers"], enriched, as_of))
    performance = put(
        "product_performance",
        gold.product_performance(bronze["products"], bronze["order_items"], bronze["product_reviews"]),
    )
    put("top_customers", gold.top_customers(c360))
    put("monthly_kpi", gold.monthly_kpi(sales))
    put("product_health", gold.product_health(performance, sentiment))
    return done
