"""Exchange with planning tools: export shapes and targets against actuals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.functions.columns import percent
from orelake.plans import gold
from orelake.schemas import PLANNING_TARGETS
from orelake.sources.sinks import export


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """A table of rows given inline."""
    return spark.createDataFrame(rows, schema)


def targets_from_sales(sales: DataFrame, growth: str = "1.10") -> DataFrame:
    """Quarterly targets per region and channel: ``growth`` times what the same quarter
    of the year before brought, in revenue and in orders. Customers are not additive
    over months, so their target is left open."""
    quarters = sales.groupBy(
        "REGION", "CHANNEL", (F.year("MONTH") + 1).alias("FISCAL_YEAR"), F.quarter("MONTH").alias("FISCAL_QUARTER")
    ).agg(F.sum("TOTAL_REVENUE").alias("revenue"), F.sum("TOTAL_ORDERS").alias("orders"))
    factor = F.lit(growth).cast("decimal(6,2)")
    targets = quarters.withColumns({
        "REVENUE_TARGET": F.round(F.col("revenue").cast("decimal(28,2)") * factor, 2),
        "ORDER_TARGET": F.ceil(F.col("orders") * factor),
        "CUSTOMER_TARGET": F.lit(None),
    })
    kinds = {f.name: f.dataType for f in PLANNING_TARGETS.fields} | {"REVENUE_TARGET": "decimal(28,2)"}
    return targets.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def region_key(region: Column, region_map: Mapping[str, str] | None = None) -> Column:
    """Regions compared without case or padding, after renaming planning regions."""
    key = F.upper(F.trim(region))
    cases = [F.when(key == k.strip().upper(), F.lit(v.strip().upper())) for k, v in (region_map or {}).items()]
    return F.coalesce(*cases, key)


def _attainment(actual: Column, target: Column) -> list[Column]:
    pct = percent(actual, target, 2)
    return [pct.alias("ATTAINMENT_PCT"), F.when(actual >= target, "Over").otherwise("Under").alias("STATUS")]


def target_attainment(
    targets: DataFrame,
    sales: DataFrame,
    region_map: Mapping[str, str] | None = None,
    grain: Sequence[str] = ("region", "year", "quarter"),
    literal: bool = False,
    year: int | None = None,
) -> DataFrame:
    """Revenue targets against actual revenue.

    Both sides are summed to ``grain`` (region, optionally year, quarter and
    channel) before they meet, so one target row faces one actual row.
    ``literal=True`` instead pairs every target with every monthly sales row of
    the same region.
    """
    if year is not None:
        targets = targets.filter(F.col("FISCAL_YEAR") == year)
    t_keys = {
        "region": region_key(F.col("REGION"), region_map),
        "year": F.col("FISCAL_YEAR").cast("int"),
        "quarter": F.col("FISCAL_QUARTER").cast("int"),
        "channel": region_key(F.col("CHANNEL")),
    }
    s_keys = {
        "region": region_key(F.col("REGION")),
        "year": F.year("MONTH"),
        "quarter": F.quarter("MONTH"),
        "channel": region_key(F.col("CHANNEL")),
    }
    actual, target = F.col("ACTUAL_REVENUE"), F.col("REVENUE_TARGET")
    if literal:
        t = targets.select(t_keys["region"].alias("REGION"), F.col("FISCAL_QUARTER").alias("QUARTER"), "REVENUE_TARGET")
        s = sales.select(s_keys["region"].alias("REGION"), F.col("TOTAL_REVENUE").alias("ACTUAL_REVENUE"))
        return t.join(s, "REGION").select("*", *_attainment(actual, target))

    names = [g.upper() for g in grain]
    t = targets.groupBy(*[t_keys[g].alias(g.upper()) for g in grain]).agg(F.sum("REVENUE_TARGET").alias("REVENUE_TARGET"))
    s = sales.groupBy(*[s_keys[g].alias(g.upper()) for g in grain]).agg(F.sum("TOTAL_REVENUE").alias("ACTUAL_REVENUE"))
    return t.join(s, names).select(*names, "REVENUE_TARGET", "ACTUAL_REVENUE", *_attainment(actual, target))


def export_gold(tables: Mapping[str, DataFrame], out: str, as_of: date, exported_at=None) -> dict[str, DataFrame]:
    """Customer 360, sales summary and product performance in their export shapes.

    ``tables`` holds customers, orders_enriched, products, order_items and product_reviews.
    """
    enriched = tables["orders_enriched"]
    wide = {
        "customer_360": gold.customer_360_wide(tables["customers"], enriched, as_of),
        "sales_summary": gold.sales_summary_wide(enriched),
        "product_performance": gold.product_performance_wide(
            tables["products"], tables["order_items"], tables["product_reviews"]
        ),
    }
    return {name: export(df, f"{out}/{name}", df.columns, exported_at) for name, df in wide.items()}


def export_predictions(predictions: DataFrame, path: str, exported_at: datetime | date | None = None) -> DataFrame:
    columns = [
        "ORDER_MONTH", "CATEGORY", F.col("MONTHLY_REVENUE").alias("ACTUAL_REVENUE"), "PREDICTED_REVENUE",
        "RESIDUAL", "PCT_ERROR", "MODEL_NAME", "MODEL_VERSION",
    ]
    return export(predictions, path, columns, exported_at)
