"""Named queries over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contract.present import present, rounded
from orelake.operators import bitmaps, boosting, evaluate, models, search, search_index, vector_index
from orelake.operators.encode import chrono_split, hash_split
from orelake.functions import by_name
from orelake.operators.history import scd2_from_log, table_changes, upsert
from orelake.operators.ranking import random_numbers
from orelake.plans import exchange, features, gold, incremental, layers, metrics, questions, search_docs, silver
from orelake.plans.retail_model import RETAIL_MODEL
from orelake.operators.semantic import build_rollup, coarser_rollup, semantic_query
from orelake.session import adapt, scratch_dir
from orelake.sources import bronze, nested
from orelake.sources.sinks import (
    append_and_reconcile, append_with_defaults, list_tables, publish_snapshot, read_snapshot, row_counts, save,
)
from orelake.streaming import jobs
from orelake.streaming import order_state as order_states
from orelake.schemas import CUSTOMERS, STORES_FEED
from orelake.sources.files import load_history, load_stores, read_json_feed
from orelake.vocab import PLANNING_REGION_MAP

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 8, 2)
FIRST_LOAD = "2001-01-01 00:00:00"
CHANGED_AT = "2001-08-02 00:00:00"
LAST_YEAR = 2000


class Tables:
    """Bronze tables and the layers most queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        adapt(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in bronze.TABLES:
            return bronze.TABLES[name](self.spark, self.sf_dir)
        raise AttributeError(name)

    @property
    def cleaned(self) -> DataFrame:
        return silver.orders_cleaned(self.orders)

    @property
    def valid(self) -> DataFrame:
        return silver.valid_orders(self.cleaned)

    @property
    def order_lines(self) -> DataFrame:
        return bronze.order_lines(self.spark, self.sf_dir)

    @property
    def enriched(self) -> DataFrame:
        return silver.orders_enriched(self.cleaned, self.customers)

    @property
    def sales(self) -> DataFrame:
        return gold.sales_summary(self.valid)

    @property
    def c360(self) -> DataFrame:
        return gold.customer_360(self.customers, self.valid, AS_OF)

    @property
    def performance(self) -> DataFrame:
        return gold.product_performance(self.products, self.order_lines, self.product_reviews)

    @property
    def processed(self) -> DataFrame:
        return silver.processed_reviews(self.product_reviews)

    @property
    def orders_before(self) -> DataFrame:
        return bronze.orders_before(self.spark, self.sf_dir)

    @property
    def orders_after(self) -> DataFrame:
        return bronze.orders_after(self.spark, self.sf_dir)

    @property
    def initial_load(self) -> DataFrame:
        return table_changes(self.orders_before.limit(0), self.orders_before, "ORDER_ID")

    @property
    def order_changes(self) -> DataFrame:
        return table_changes(self.orders_before, self.orders_after, "ORDER_ID")

    @property
    def order_history(self) -> DataFrame:
        # History and change feed are tables: written by one step, read by the next.
        first = stored(self, metrics.orders_scd2(None, self.initial_load, FIRST_LOAD), "history")
        return metrics.orders_scd2(first, stored(self, self.order_changes, "changes"), CHANGED_AT)

    @property
    def retail(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "orders": self.orders,
            "order_items": self.order_lines,
            "reviews": self.product_reviews,
        }

    @property
    def ticket_features(self) -> DataFrame:
        return features.ticket_features(self.support_tickets, self.customers, self.products, self.orders)

    @property
    def ticket_model_table(self) -> DataFrame:
        return features.ticket_model_table(self.ticket_features)

    @property
    def revenue_features(self) -> DataFrame:
        return features.revenue_features(self.orders, self.order_lines, self.products)

    @property
    def revenue_model_table(self) -> DataFrame:
        return features.revenue_model_table(self.revenue_features)

    @property
    def documents(self) -> DataFrame:
        return bronze.read(self.spark, self.sf_dir, "documents").withColumnRenamed("doc_id", "DOC_ID")

    @property
    def search_queries(self) -> DataFrame:
        b = bronze.read(self.spark, self.sf_dir, "benchmark")
        return b.select(F.col("item_id").alias("QUERY_ID"), F.col("text").alias("QUERY_TEXT"))

    @property
    def product_sentiment(self) -> DataFrame:
        return silver.product_sentiment_summary(self.processed, self.products)


def stored(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """The frame written to shared storage and read back, for tables read many times."""
    path = f"{scratch_dir(t.spark, 'tables')}/{name}"
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


def over_tables(fn: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(fn(Tables(spark, sf_dir)))


# What the wide sales summary reads of the enriched orders; it reads them twice.
WIDE_SALES = [
    "ORDER_ID", "CUSTOMER_ID", "ORDER_MONTH", "ORDER_YEAR", "REGION", "CHANNEL", "CUSTOMER_SEGMENT", "ORDER_VALUE_TIER",
    "ORDER_STATUS", "TOTAL_AMOUNT", "DISCOUNT_AMOUNT", "NET_AMOUNT",
]

SILVER_GOLD: dict[str, Callable[[Tables], DataFrame]] = {
    "orders_cleaned": lambda t: t.cleaned,
    "orders_enriched": lambda t: t.enriched,
    "sales_summary": lambda t: t.sales,
    "monthly_kpi": lambda t: gold.monthly_kpi(t.sales),
    "customer_360": lambda t: t.c360,
    "customer_360_wide": lambda t: gold.customer_360_wide(t.customers, t.valid, AS_OF),
    "top_customers": lambda t: gold.top_customers(t.c360),
    "product_performance": lambda t: t.performance,
    "product_performance_dedupe": lambda t: gold.product_performance(
        t.products, t.order_lines, t.product_reviews, dedupe=True
    ),
    "product_performance_wide": lambda t: gold.product_performance_wide(t.products, t.order_items, t.product_reviews),
    "sales_summary_wide": lambda t: gold.sales_summary_wide(stored(t, t.enriched.select(*WIDE_SALES), "enriched")),
    "region_revenue": lambda t: gold.region_revenue(t.sales),
    "customer_order_patterns": lambda t: silver.customer_order_patterns(t.orders),
    "processed_reviews": lambda t: t.processed,
    "sentiment_distribution": lambda t: silver.sentiment_distribution(t.processed),
    "product_sentiment": lambda t: t.product_sentiment,
    "product_health": lambda t: gold.product_health(t.performance, t.product_sentiment),
    "monthly_revenue_by_category": lambda t: silver.monthly_revenue_by_category(t.orders, t.order_lines, t.products),
}


# --- change history ----------------------------------------------------------


def text_times(history: DataFrame) -> DataFrame:
    """Version times as text: the open end lies outside many clients' date range."""
    times = {c: F.col(c).cast("string") for c in ("EFFECTIVE_FROM", "EFFECTIVE_TO")}
    return history.withColumns(times).drop("SURROGATE_KEY")


def checked_keys(history: DataFrame) -> DataFrame:
    """History with, for its surrogate keys, that each is set, above 0 and used once."""
    once = F.count(F.lit(1)).over(W.partitionBy("SURROGATE_KEY")) == 1
    fine = F.col("SURROGATE_KEY").isNotNull() & (F.col("SURROGATE_KEY") > 0) & once
    return text_times(history.withColumn("KEY_OK", fine))


def committed(changes: DataFrame, number: int, at: str) -> DataFrame:
    return changes.withColumns({"_commit": F.lit(number).cast("bigint"), "_committed_at": F.lit(at).cast("timestamp_ntz")})


def commits(t: Tables) -> list[DataFrame]:
    return [committed(t.initial_load, 0, FIRST_LOAD), committed(t.order_changes, 1, CHANGED_AT)]


def history_from_log(t: Tables) -> DataFrame:
    first, second = map(metrics.order_images, commits(t))
    return scd2_from_log(first.unionByName(second), "ORDER_ID")


def upserted_daily(t: Tables) -> DataFrame:
    def daily(orders: DataFrame) -> DataFrame:
        current = orders.withColumns({"NET_AMOUNT": silver.net_amount(), "IS_CURRENT": F.lit(True)})
        return metrics.daily_order_metrics(current)

    target = daily(t.orders_before).withColumn("UPDATED_AT", F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    return upsert(target, daily(t.orders_after), metrics.DAILY_KEYS, CHANGED_AT)


def refreshed_lake(t: Tables) -> incremental.Lake:
    """Layers filled by a first load and brought up to date by a batch of changes."""
    lake = incremental.Lake(t.spark, scratch_dir(t.spark, "lake"), t.orders, t.customers)
    for step, changes in enumerate((t.initial_load, t.order_changes)):
        lake.refresh(changes, t.customers, step)
    return lake


def unique_customers(t: Tables) -> DataFrame:
    """Distinct customers by month, quarter and region, all from one stored summary."""
    months = bitmaps.id_bitmaps(t.valid, ["ORDER_MONTH", "REGION"], "CUSTOMER_ID")
    held = stored(t, months, "customer_bitmaps")
    month, region, any_region = F.col("ORDER_MONTH").cast("date"), F.col("REGION"), F.lit(None).cast("string")
    any_time = F.lit(None).cast("date")
    levels = {
        "MONTH_REGION": [month, region], "MONTH": [month, any_region], "QUARTER": [F.trunc(month, "quarter"), any_region],
        "QUARTER_REGION": [F.trunc(month, "quarter"), region], "REGION": [any_time, region], "ALL": [any_time, any_region],
    }
    return bitmaps.counts_by_level(held, levels, ["PERIOD", "REGION"], "UNIQUE_CUSTOMERS")


CHANGES: dict[str, Callable[[Tables], DataFrame]] = {
    "order_changes": lambda t: t.order_changes,
    "orders_scd2": lambda t: text_times(t.order_history),
    "orders_scd2_keys": lambda t: checked_keys(t.order_history).select("ORDER_ID", "EFFECTIVE_FROM", "KEY_OK"),
    "orders_scd2_from_log": lambda t: text_times(history_from_log(t)),
    "orders_history_view": lambda t: text_times(metrics.history_view(t.order_history)),
    "daily_order_metrics": lambda t: metrics.daily_order_metrics(t.order_history),
    "upsert_daily": upserted_daily,
    "sales_summary_incremental": lambda t: refreshed_lake(t).table("sales_summary"),
    "customer_360_incremental": lambda t: refreshed_lake(t).customer_360(t.customers, AS_OF),
    "unique_customers_by_level": unique_customers,
    "ticket_metrics": lambda t: metrics.support_ticket_metrics(
        table_changes(t.support_tickets.limit(0), t.support_tickets, "TICKET_ID"), AS_OF
    ),
}

# --- events, exchange, semantic layer ------------------------------------------


def semantic(names, dims, where=None, where_dims=()) -> Callable[[Tables], DataFrame]:
    return lambda t: semantic_query(RETAIL_MODEL, t.retail, names, dims, where() if where else None, where_dims)


def from_rollups(names, dims, where=None, where_dims=()) -> Callable[[Tables], DataFrame]:
    """A semantic query answered from stored rollups of the orders, a fine and a coarse one."""

    def ask(t: Tables) -> DataFrame:
        base = scratch_dir(t.spark, "rollups")
        fine = build_rollup(RETAIL_MODEL, t.retail, "orders", ["order_month", "order_year", "region", "segment", "customer_country"], f"{base}/fine")
        coarse = coarser_rollup(RETAIL_MODEL, fine, ["order_month", "order_year", "customer_segment"], f"{base}/coarse")
        no_tables = {n: df.limit(0) for n, df in t.retail.items()}
        return semantic_query(RETAIL_MODEL, no_tables, names, dims, where() if where else None, where_dims, [fine, coarse])

    return ask


ASKED: dict[str, Callable[[Tables], DataFrame]] = {
    "iot_alerts": lambda t: silver.iot_alerts(t.iot_readings),
    "clickstream_json": lambda t: t.clickstream,
    "row_counts": lambda t: row_counts({n.upper(): getattr(t, n) for n in bronze.TABLES}),
    "target_attainment": lambda t: exchange.target_attainment(
        exchange.targets_from_sales(t.sales), t.sales, PLANNING_REGION_MAP
    ),
    "semantic_region": lambda t: questions.revenue_by_region(t.retail),
    "semantic_month": lambda t: questions.monthly_trend(t.retail),
    "semantic_segment": lambda t: questions.revenue_by_segment(t.retail, LAST_YEAR),
    "semantic_drill_across": semantic(
        ["total_units_sold", "total_line_revenue", "review_count", "average_rating"], ["category", "brand"]
    ),
    "semantic_country": semantic(
        ["net_revenue", "cancelled_orders", "customer_count", "review_count"], ["customer_country", "segment"]
    ),
    "semantic_rollup_month": from_rollups(["total_revenue", "average_order_value"], ["order_month"]),
    "semantic_rollup_segment": from_rollups(
        ["total_revenue", "order_count"], ["customer_segment"], lambda: F.col("order_year") == LAST_YEAR, ["order_year"]
    ),
    "question_aov_last_month": lambda t: questions.average_order_value_last_month(t.retail),
    "question_channel_customers": lambda t: questions.unique_customers_per_channel(t.retail),
    "question_top_categories": lambda t: questions.top_categories_by_units(t.retail),
    "question_category_sales": lambda t: questions.category_sales(t.retail),
    "question_category_support": lambda t: questions.category_support(t.support_tickets, t.retail, "ECONOMY"),
    "question_net_revenue": lambda t: questions.net_revenue_by_region(t.retail, LAST_YEAR),
}

# --- search ----------------------------------------------------------------------


_INDEXES: dict[tuple, search_index.Index] = {}


def kept_index(t: Tables, name: str, docs: DataFrame, id_col: str, text_col: str) -> search_index.Index:
    """The stored index of some documents: written by the first search of an application
    that needs it, opened by the others as long as the documents' files are the same."""
    key = (t.spark.sparkContext.applicationId, name, t.sf_dir, *sorted(docs.inputFiles()))
    if key not in _INDEXES:
        _INDEXES[key] = search_index.build_index(docs, id_col, text_col, scratch_dir(t.spark, f"index-{name}"))
    return _INDEXES[key]


def document_index(t: Tables) -> search_index.Index:
    return kept_index(t, "documents", t.documents, "DOC_ID", "text")


def built_index(t: Tables) -> DataFrame:
    """The terms of an index made anew, with the documents and occurrences that its
    postings hold."""
    index = search_index.build_index(t.documents, "DOC_ID", "text", scratch_dir(t.spark, "index"))
    return index.postings.groupBy(F.col("term").alias("TERM")).agg(
        F.count(F.lit(1)).alias("DOCUMENTS"), F.sum("tf").alias("OCCURRENCES")
    )


def index_blocks(t: Tables) -> DataFrame:
    """Every block of the index: its postings and the greatest share of a score in it."""
    index = document_index(t)
    return index.blocks.select(
        F.col("term").alias("TERM"), F.col("block").cast("long").alias("BLOCK"), F.col("n").alias("POSTINGS"),
        F.round(search_index.KEYWORD, 6).alias("KEYWORD_SHARE"), F.round(search_index.VECTOR, 6).alias("VECTOR_SHARE"),
    )


def keyword_hits(t: Tables, k: int) -> DataFrame:
    return search.keyword_search(document_index(t), t.search_queries, k)


def hybrid_hits(t: Tables) -> DataFrame:
    index = document_index(t)
    by_word = search.keyword_search(index, t.search_queries, 20)
    by_vector = search.text_vector_search(index, t.search_queries, 20)
    return search.hybrid_search(by_word, by_vector, 10)


def filtered_reviews(t: Tables) -> DataFrame:
    """Keyword search among well-rated reviews, with display columns."""
    reviews = t.product_reviews.select("REVIEW_ID", "REVIEW_TEXT")
    index = kept_index(t, "reviews", reviews, "REVIEW_ID", "REVIEW_TEXT")
    docs = search_docs.review_search_docs(t.product_reviews, t.products, t.processed)
    hits = search.keyword_search(index, t.search_queries, 5, attrs=t.product_reviews, where=F.col("RATING") >= 4)
    return search.with_attributes(hits, docs, "REVIEW_ID", ["PRODUCT_NAME", "RATING", "SENTIMENT_LABEL"])


def label_centroids(t: Tables) -> DataFrame:
    e = bronze.read(t.spark, t.sf_dir, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vectors = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return vectors.select(F.col("label").cast("bigint").alias("QUERY_ID"), F.col("v.x").alias("QUERY_VEC"))


def nearest_to_centroid(t: Tables) -> DataFrame:
    e = bronze.read(t.spark, t.sf_dir, "embeddings").withColumnRenamed("vec_id", "VEC_ID")
    return search.vector_topk(e, label_centroids(t), 10, "VEC_ID", "embedding")


def nearest_by_groups(t: Tables) -> DataFrame:
    """The same from a stored index, through the groups that may matter."""
    e = bronze.read(t.spark, t.sf_dir, "embeddings").withColumnRenamed("vec_id", "VEC_ID")
    index = vector_index.build(e, "VEC_ID", "embedding", scratch_dir(t.spark, "vectors"))
    return vector_index.search(index, label_centroids(t), 10, lambda df, name: stored(t, df, name))


SEARCH: dict[str, Callable[[Tables], DataFrame]] = {
    "review_search_docs": lambda t: search_docs.review_search_docs(t.product_reviews, t.products, t.processed),
    "ticket_search_docs": lambda t: search_docs.ticket_search_docs(t.support_tickets, t.customers, t.products),
    "keyword_search": lambda t: keyword_hits(t, 5),
    "keyword_search_filtered": filtered_reviews,
    "text_vector_search": lambda t: search.text_vector_search(document_index(t), t.search_queries, 5),
    "hybrid_search": hybrid_hits,
    "search_index_build": built_index,
    "search_index_blocks": index_blocks,
    "vector_topk": nearest_to_centroid,
    "vector_topk_grouped": nearest_by_groups,
}

# --- features, splits, model quality ------------------------------------------


def labelled_split(train: DataFrame, test: DataFrame, *columns: str) -> DataFrame:
    return train.select(*columns, F.lit("train").alias("SPLIT")).unionByName(
        test.select(*columns, F.lit("test").alias("SPLIT"))
    )


def rule_predictions(t: Tables) -> DataFrame:
    """Priorities guessed from the resolution time, as something to evaluate."""
    hours = F.col("RESOLUTION_TIME_HOURS")
    guess = F.when(hours >= 180, 0).when(hours >= 120, 1).when(hours >= 60, 2).otherwise(3)
    rank = F.array_position(F.array(*[F.lit(p) for p in ("Low", "Medium", "High", "Critical")]), F.col("PRIORITY")) - 1
    return t.support_tickets.select("TICKET_ID", rank.alias("PRIORITY_ENCODED"), guess.alias("PREDICTED"))


def moving_average_predictions(t: Tables) -> DataFrame:
    pred = t.revenue_features.withColumn("P", F.col("REVENUE_MA_3").cast("double"))
    keep = ["ORDER_MONTH", "CATEGORY", "MONTHLY_REVENUE"]
    return evaluate.prediction_table(pred, "MovingAverage", "v1", keep, "P", "PREDICTED_REVENUE", "MONTHLY_REVENUE")


def ticket_predictions(t: Tables, kind: str) -> DataFrame:
    train, test = hash_split(stored(t, t.ticket_model_table, "tickets"), "TICKET_ID")
    model = models.train_ticket_classifier(train, features.TICKET_INPUTS, kind)
    pred = models.predict(model, test, features.TICKET_INPUTS)
    name = {"rf": "RandomForestClassifier", "lr": "LogisticRegression"}[kind]
    keep = ["TICKET_ID", "PRIORITY", "PRIORITY_ENCODED"]
    return evaluate.prediction_table(pred, name, "v1", keep, "PREDICTED", "PREDICTED_PRIORITY")


def ticket_importance(t: Tables) -> DataFrame:
    train, _ = hash_split(stored(t, t.ticket_model_table, "tickets"), "TICKET_ID")
    model = models.train_ticket_classifier(train, features.TICKET_INPUTS, "rf")
    return models.feature_importance(t.spark, model, features.TICKET_INPUTS)


def revenue_predictions(t: Tables, kind: str) -> DataFrame:
    # One row per month and category, however large the orders are: one file will do.
    train, test = chrono_split(stored(t, t.revenue_model_table.coalesce(1), "revenue"), "ORDER_MONTH")
    model = models.train_revenue_model(train, features.REVENUE_INPUTS, kind)
    pred = models.predict(model, test, features.REVENUE_INPUTS)
    name = {"gbt": "GBTRegressor", "linear": "LinearRegression"}[kind]
    keep = ["ORDER_MONTH", "CATEGORY", "MONTHLY_REVENUE"]
    return evaluate.prediction_table(pred, name, "v1", keep, "PREDICTED", "PREDICTED_REVENUE", "MONTHLY_REVENUE")


def compared_rules(t: Tables) -> DataFrame:
    f = t.revenue_features
    y = "MONTHLY_REVENUE"
    return evaluate.compare_models(
        {
            "MovingAverage": evaluate.regression_metrics(f, y, "REVENUE_MA_3"),
            "LastMonth": evaluate.regression_metrics(f, y, "REVENUE_LAG_1"),
        },
        "R2",
    )


LEARNING: dict[str, Callable[[Tables], DataFrame]] = {
    "ticket_features": lambda t: t.ticket_features,
    "revenue_features": lambda t: t.revenue_features,
    "ticket_model_table": lambda t: rounded(t.ticket_model_table, 6),
    "revenue_model_table": lambda t: rounded(t.revenue_model_table, 6),
    "class_distribution": lambda t: evaluate.class_distribution(t.support_tickets, "PRIORITY"),
    "ticket_features_describe": lambda t: rounded(evaluate.describe(t.ticket_features, features.TICKET_NUMERIC), 6),
    "chrono_split": lambda t: labelled_split(
        *chrono_split(t.revenue_features, "ORDER_MONTH"), "ORDER_MONTH", "CATEGORY", "MONTHLY_REVENUE"
    ),
    "hash_split": lambda t: labelled_split(*hash_split(t.support_tickets, "TICKET_ID"), "TICKET_ID"),
    "confusion_matrix": lambda t: evaluate.confusion_matrix(
        rule_predictions(t), "PRIORITY_ENCODED", "PREDICTED", [0, 1, 2, 3]
    ),
    "classification_metrics": lambda t: rounded(
        evaluate.classification_metrics(rule_predictions(t), "PRIORITY_ENCODED", "PREDICTED"), 6
    ),
    "regression_metrics": lambda t: rounded(
        evaluate.regression_metrics(t.revenue_features, "MONTHLY_REVENUE", "REVENUE_MA_3"), 4
    ).withColumn("MSE", F.round("MSE", -4)),
    "model_comparison": lambda t: rounded(compared_rules(t), 4).withColumn("MSE", F.round("MSE", -4)),
    "prediction_table": lambda t: rounded(moving_average_predictions(t), 4),
    "residual_summary": lambda t: rounded(evaluate.residual_summary(moving_average_predictions(t)), 4),
    "residual_by_category": lambda t: rounded(evaluate.residual_summary(moving_average_predictions(t), "CATEGORY"), 4),
    "feature_importance": ticket_importance,
    "rf_predict": lambda t: ticket_predictions(t, "rf"),
    "lr_predict": lambda t: ticket_predictions(t, "lr"),
    "gbt_predict": lambda t: revenue_predictions(t, "gbt"),
    "linreg_predict": lambda t: revenue_predictions(t, "linear"),
}

# --- streams --------------------------------------------------------------------


def stores_csv(t: Tables) -> DataFrame:
    """Store feed rows made from the suppliers."""
    place = bronze.read(t.spark, t.sf_dir, "nation").join(
        bronze.read(t.spark, t.sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    s = bronze.read(t.spark, t.sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("STORE-"), key.cast("string")).alias("STORE_ID"),
        F.concat(F.col("s_name"), F.lit(", main floor")).alias("STORE_NAME"),
        F.col("r_name").alias("REGION"),
        F.col("n_name").alias("CITY"),
        F.lit("NULL").alias("STATE"),
        F.col("r_name").alias("COUNTRY"),
        bronze.pick(key % 4, "Flagship", "Standard", "Outlet", "Online").alias("STORE_TYPE"),
        F.when(key % 7 == 0, "unknown").otherwise(F.lit("2001-03-04")).alias("OPEN_DATE"),
        F.when(key % 11 == 0, "maybe").when(F.col("s_acctbal") > 0, "TRUE").otherwise("FALSE").alias("IS_ACTIVE"),
    )


def ingested_stores(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = scratch_dir(t.spark, "ingest")
    stores_csv(t).write.option("header", True).csv(f"{base}/landing")
    jobs.ingest_stream(t.spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", STORES_FEED, CHANGED_AT)
    data = t.spark.read.parquet(f"{base}/out/data").drop("batch_id", "SOURCE_FILE")
    return data, load_history(t.spark.read.parquet(f"{base}/out/log"))


def load_totals(t: Tables) -> DataFrame:
    """Load history summed over files, whose names differ from run to run."""
    _, log = ingested_stores(t)
    return log.groupBy("TABLE_NAME").agg(
        F.sum("ROW_COUNT").alias("ROW_COUNT"),
        F.sum("ERROR_COUNT").alias("ERROR_COUNT"),
        F.max("LAST_LOAD_TIME").alias("LAST_LOAD_TIME"),
    )


def streamed_history(t: Tables, runs: int) -> DataFrame:
    """Order history from the change stream, run after each commit or, to catch up,
    once for both."""
    base = scratch_dir(t.spark, "changes")
    for n, changes in enumerate(commits(t)):
        changes.write.mode("append").parquet(f"{base}/landing")
        if runs > 1 or n == 1:
            source = jobs.change_source(t.spark, f"{base}/landing", changes.schema)
            jobs.order_history_stream(source, f"{base}/log", f"{base}/checkpoint")
    return scd2_from_log(jobs.read_change_log(t.spark, f"{base}/log"), "ORDER_ID")


def streamed_daily(t: Tables) -> DataFrame:
    """Daily metrics kept by the change stream, run after each commit."""
    base = scratch_dir(t.spark, "daily")
    for changes in commits(t):
        changes.write.mode("append").parquet(f"{base}/landing")
        source = jobs.change_source(t.spark, f"{base}/landing", changes.schema)
        jobs.daily_metrics_stream(source, f"{base}/log", f"{base}/daily", f"{base}/checkpoint")
    return jobs.read_daily(t.spark, f"{base}/daily")


def order_state(t: Tables) -> str:
    """The folder of an order state stream run after each commit, the second of which
    arrives together with a repetition of the first."""
    base = scratch_dir(t.spark, "state")
    first, second = commits(t)
    for arriving in ([first], [second, first]):
        for changes in arriving:
            changes.write.mode("append").parquet(f"{base}/landing")
        source = jobs.change_source(t.spark, f"{base}/landing", first.schema)
        order_states.order_state_stream(source, f"{base}/out", f"{base}/checkpoint", "400 days")
    return f"{base}/out"


def refreshed_counts(t: Tables) -> DataFrame:
    """Row counts of all layers after one refresh."""
    names = ("customers", "products", "orders", "order_items", "product_reviews", "support_tickets")
    done = layers.refresh({n: getattr(t, n) for n in names}, scratch_dir(t.spark, "layers"), AS_OF)
    return row_counts({n.upper(): df for n, df in done.items()})


def streamed_enrichment(t: Tables) -> DataFrame:
    base = scratch_dir(t.spark, "enrich")
    t.orders.write.parquet(f"{base}/landing")
    source = jobs.change_source(t.spark, f"{base}/landing", t.orders.schema)
    jobs.enrich_stream(source, t.customers, f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out")


def files_by_quality(t: Tables) -> DataFrame:
    """Store rows with the file they land in: one without errors, one with some, one with
    nothing else."""
    key = F.regexp_extract("STORE_ID", "[0-9]+", 0).cast("long")
    spoilt = key % 11 == 0
    name = F.when(spoilt & (key % 2 == 0), "broken").when(key % 2 == 0, "clean").otherwise("mixed")
    return stores_csv(t).withColumn("FILE", name)


def load_status(t: Tables) -> DataFrame:
    """What became of each landed file, by the name of its folder."""
    base = scratch_dir(t.spark, "status")
    rows = files_by_quality(t)
    rows.repartition("FILE").write.option("header", True).partitionBy("FILE").csv(f"{base}/landing")
    jobs.ingest_stream(t.spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", STORES_FEED, CHANGED_AT)
    found = load_history(t.spark.read.parquet(f"{base}/out/log"))
    return found.withColumn("FILE_NAME", F.regexp_extract("FILE_NAME", "FILE=([^/]+)/", 1))


STREAMS: dict[str, Callable[[Tables], DataFrame]] = {
    "csv_ingest_stream": lambda t: ingested_stores(t)[0],
    "load_history": load_totals,
    "load_status": load_status,
    "order_history_stream": lambda t: text_times(streamed_history(t, 2)),
    "order_history_catch_up": lambda t: text_times(streamed_history(t, 1)),
    "enrich_stream": streamed_enrichment,
    "daily_metrics_stream": streamed_daily,
    "order_state_history": lambda t: text_times(order_states.read_history(t.spark, order_state(t))),
    "order_state_daily": lambda t: order_states.read_daily_state(t.spark, order_state(t)),
    "layer_refresh_counts": refreshed_counts,
}


# --- storage ----------------------------------------------------------------------


def json_arrays(t: Tables) -> DataFrame:
    """Events written as files of one JSON array each, and read as a feed."""
    path = f"{scratch_dir(t.spark, 'json')}/events"
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    e = bronze.read(t.spark, t.sf_dir, "events").select(*columns)
    arrays = e.groupBy(F.floor(F.col("event_id") / 1000)).agg(F.to_json(F.collect_list(F.struct(*columns))).alias("value"))
    # A file may hold one array only.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json_feed(t.spark, path, e.schema)


def nested_events(t: Tables) -> DataFrame:
    """Events as messages, each with the list of what happened; one JSON text a message."""
    e = bronze.read(t.spark, t.sf_dir, "events")
    item = F.struct("event_id", F.col("event_type").alias("type"), F.struct("value", F.from_json("props", "k long").alias("props")).alias("data"))
    batch = e.groupBy(F.floor(F.col("event_id") / 20).cast("long").alias("MESSAGE_ID")).agg(
        F.sort_array(F.collect_list(item)).alias("content"), F.count(F.lit(1)).alias("n")
    )
    return batch.select("MESSAGE_ID", F.to_json(F.struct("content", F.struct("n").alias("meta"))).alias("MESSAGE"))


def message_elements(t: Tables) -> DataFrame:
    """One row per element of the messages' lists."""
    rows = nested.as_variant(nested_events(t), "MESSAGE")
    fields = {
        "EVENT_ID": ("$.event_id", "bigint"), "EVENT_TYPE": ("$.type", "string"),
        "VALUE": ("$.data.value", "double"), "PRODUCT_ID": ("$.data.props.k", "bigint"),
    }
    return nested.elements(rows, "v", "$.content", fields, ["MESSAGE_ID"])


def message_heads(t: Tables) -> DataFrame:
    """The first element of each message, and its length, by path."""
    fields = {
        "N": ("$.meta.n", "bigint"), "FIRST_ID": ("$.content[0].event_id", "bigint"), "FIRST_TYPE": ("$.content[0].type", "string"),
        "FIRST_PRODUCT": ("$.content[0].data.props.k", "bigint"), "MISSING": ("$.content[999].type", "string"),
    }
    return nested.at_path(nested.as_variant(nested_events(t), "MESSAGE"), "v", fields).select("MESSAGE_ID", *fields)


def by_synonyms(t: Tables) -> DataFrame:
    """A semantic query put in the users' own words."""
    found = semantic_query(RETAIL_MODEL, t.retail, ["gross revenue", "AOV", "number of orders"], ["geography", "sales channel"])
    return found.withColumnsRenamed({"total_revenue": "REVENUE", "average_order_value": "AOV", "order_count": "ORDERS"})


def catalog_rows(t: Tables) -> DataFrame:
    """The catalog's list of tables saved from two frames, with the rows each holds."""
    database = f"orelake_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database}")
    for name, df in {"orders_before": t.orders_before, "customers": t.customers}.items():
        save(df, f"{database}.{name}")
    listed = list_tables(t.spark, [database])
    counts = row_counts({n: t.spark.table(f"{database}.{n}") for n in ("orders_before", "customers")})
    return listed.join(counts, "TABLE_NAME").select("TABLE_NAME", "TABLE_TYPE", "ROW_COUNT")


def bulk_stores(t: Tables) -> DataFrame:
    """The store feed loaded in one go."""
    path = f"{scratch_dir(t.spark, 'bulk')}/stores"
    stores_csv(t).write.option("header", True).csv(path)
    return load_stores(t.spark, path, CHANGED_AT).drop("SOURCE_FILE")


def changes_without_initial(t: Tables) -> DataFrame:
    """A feed that starts at the present: the rows already there are not replayed."""
    first = table_changes(t.orders_before.limit(0), t.orders_before, "ORDER_ID", initial_rows=False)
    return first.unionByName(table_changes(t.orders_before, t.orders_after, "ORDER_ID", initial_rows=False))


def reloaded_model(t: Tables) -> DataFrame:
    """Predictions of a linear model before it is stored and after it is loaded by name,
    over the held-out months: all rows, and whether the two agree and the kept
    metric is the one that was stored."""
    train, test = chrono_split(stored(t, t.revenue_model_table, "revenue"), "ORDER_MONTH")
    model = models.train_revenue_model(train, features.REVENUE_INPUTS, "linear")
    root = scratch_dir(t.spark, "models")
    models.save_model(t.spark, model, root, "REVENUE", "v1", {"ROWS": train.count()}, default=False)
    models.save_model(t.spark, model, root, "REVENUE", "v2", {"ROWS": test.count()})
    again = models.load_model(t.spark, root, "REVENUE")
    before = models.predict(model, test, features.REVENUE_INPUTS).withColumnRenamed("PREDICTED", "_before")
    both = models.predict(again, before, features.REVENUE_INPUTS)
    metric = models.model_metrics(t.spark, root, "REVENUE").filter("METRIC = 'ROWS'").agg(F.max("VALUE")).scalar()
    return both.groupBy("ORDER_MONTH").agg(F.count(F.lit(1)).alias("N"), F.bool_and(F.col("PREDICTED") == F.col("_before")).alias("SAME")).withColumn(
        "METRIC_ROWS", metric.cast("long")
    )


def boosted_facts(t: Tables) -> DataFrame:
    """Held-out error of boosted trees with both penalties against that of the mean of
    the training rows, and of trees whose leaves are shrunk to nothing."""
    keyed = t.revenue_model_table.withColumn("KEY", F.concat_ws("/", F.col("ORDER_MONTH").cast("string"), "CATEGORY"))
    train, test = chrono_split(stored(t, keyed, "revenue"), "ORDER_MONTH")
    keep = lambda df, name: stored(t, df, name)
    fit = lambda **s: boosting.fit(train, features.REVENUE_INPUTS, "MONTHLY_REVENUE", "KEY", keep, boosting.Settings(**s))
    good, flat = fit(trees=8, depth=3, rate=0.3), fit(trees=1, depth=2, l1=1e12)
    y = F.col("MONTHLY_REVENUE").cast("double")
    mean = train.agg(F.avg(y)).scalar()
    rows = boosting.predict(flat, boosting.predict(good, test, "_good"), "_flat")
    error = lambda p: F.avg((y - p) * (y - p))
    return rows.withColumn("_mean", mean).agg(
        F.count(F.lit(1)).alias("TEST_ROWS"), (error(F.col("_good")) < error(F.col("_mean"))).alias("BETTER_THAN_MEAN"),
        (F.max(F.abs(F.col("_flat") - F.col("_mean"))) < 1e-6 * F.max(F.col("_mean"))).alias("FULLY_SHRUNK_IS_MEAN"),
    )


def sentiment_in_sql(t: Tables) -> DataFrame:
    by_name.create_sentiment(t.spark, "review_sentiment")
    return t.spark.sql(
        "SELECT REVIEW_ID, s.score AS SENTIMENT_SCORE, s.label AS SENTIMENT_LABEL, s.confidence AS SENTIMENT_CONFIDENCE "
        "FROM (SELECT REVIEW_ID, review_sentiment(REVIEW_TEXT) AS s FROM {reviews})",
        reviews=t.product_reviews,
    )


def line_in_sql(t: Tables) -> DataFrame:
    """Monthly revenue predicted from its moving average by a line, from SQL by name."""
    rows = stored(t, t.revenue_features.select("ORDER_MONTH", "CATEGORY", "MONTHLY_REVENUE", "REVENUE_MA_3"), "revenue")
    inputs = ["REVENUE_MA_3"]
    model = models.train_revenue_model(rows, inputs, "linear")
    held = stored(t, by_name.linear_coefficients(t.spark, model, inputs), "coefficients")
    by_name.create_linear(t.spark, held, "revenue_line")
    return t.spark.sql(
        "SELECT ORDER_MONTH, CATEGORY, round(revenue_line(REVENUE_MA_3), 1) AS PREDICTED_REVENUE FROM {rows}", rows=rows
    )


def appended_customers(t: Tables) -> DataFrame:
    """Customers in the declared shape, with new surrogate keys and defaults."""
    given = t.customers.drop("CUSTOMER_ID", "COUNTRY")
    defaults = {"COUNTRY": F.lit("unknown"), "CREATED_AT": F.lit(CHANGED_AT).cast("timestamp_ntz")}
    return append_with_defaults(given, CUSTOMERS, defaults, key="CUSTOMER_ID", start=1_000)


def append_defaults_facts(t: Tables) -> DataFrame:
    """The rows by their mail address; for the keys, that they are unique and not below the start."""
    rows = appended_customers(t).groupBy("EMAIL", "FIRST_NAME", "COUNTRY", "CREATED_AT", "PHONE")
    per_mail = rows.agg(F.count(F.lit(1)).alias("N"), F.min("CUSTOMER_ID").alias("_least"))
    keys = appended_customers(t).agg(F.count_distinct("CUSTOMER_ID")).scalar()
    return per_mail.select("EMAIL", "FIRST_NAME", "COUNTRY", "CREATED_AT", "PHONE", "N", (F.col("_least") >= 1_000).alias("KEY_OK"), keys.alias("KEYS"))


def reconciled(t: Tables) -> DataFrame:
    path = f"{scratch_dir(t.spark, 'append')}/orders"
    t.orders_before.write.parquet(path)
    later = t.orders.filter(F.col("ORDER_DATE") >= F.lit(bronze.CHANGE_CUTOFF).cast("timestamp_ntz"))
    return append_and_reconcile(later, path, "ORDERS")


def pinned(t: Tables) -> DataFrame:
    """The first of two published versions of the orders."""
    path = scratch_dir(t.spark, "snapshots")
    publish_snapshot(t.orders_before, path, 1, FIRST_LOAD)
    publish_snapshot(t.orders_after, path, 2, CHANGED_AT)
    latest = read_snapshot(t.spark, path).select("ORDER_ID", F.lit(True).alias("IN_LATEST"))
    first = read_snapshot(t.spark, path, 1).select("ORDER_ID", "ORDER_STATUS", "TOTAL_AMOUNT")
    return first.join(latest, "ORDER_ID", "left").withColumn("IN_LATEST", F.coalesce("IN_LATEST", F.lit(False)))


def exported_customers(t: Tables) -> DataFrame:
    tables = {
        "customers": t.customers, "orders_enriched": t.enriched, "products": t.products,
        "order_items": t.order_items, "product_reviews": t.product_reviews,
    }
    return exchange.export_gold(tables, scratch_dir(t.spark, "export"), AS_OF, CHANGED_AT)["customer_360"]


STORAGE: dict[str, Callable[[Tables], DataFrame]] = {
    "json_feed": json_arrays,
    "append_defaults": append_defaults_facts,
    "append_reconcile": reconciled,
    "snapshot_pinned": pinned,
    "export_gold": exported_customers,
}

# --- facts about fitted models ------------------------------------------------------


def ticket_facts(t: Tables, kind: str) -> DataFrame:
    """What can be said of the predictions without knowing the fit: which rows, which
    labels, and that predictions are labels."""
    labels = F.col("PREDICTED_PRIORITY")
    return ticket_predictions(t, kind).groupBy("PRIORITY_ENCODED").agg(
        F.count(F.lit(1)).alias("N"), F.sum("TICKET_ID").alias("ID_SUM"),
        F.bool_and((labels == F.round(labels)) & labels.between(0, 3)).alias("LABELS_ONLY"),
    )


def importance_facts(t: Tables) -> DataFrame:
    parts = ticket_importance(t)
    return parts.agg(
        F.count(F.lit(1)).alias("FEATURES"), F.round(F.sum("IMPORTANCE"), 6).alias("TOTAL"), F.bool_and(F.col("IMPORTANCE") >= 0).alias("NOT_NEGATIVE")
    )


def revenue_facts(t: Tables, kind: str) -> DataFrame:
    return revenue_predictions(t, kind).groupBy("ORDER_MONTH").agg(
        F.count(F.lit(1)).alias("N"), F.round(F.sum("MONTHLY_REVENUE"), 2).alias("REVENUE"),
        F.bool_and(F.col("PREDICTED_REVENUE").isNotNull() & ~F.isnan("PREDICTED_REVENUE")).alias("ALL_PREDICTED"),
    )


def normal_equations(t: Tables) -> DataFrame:
    """Least squares leaves residuals of the training rows that are orthogonal to every input."""
    train, _ = chrono_split(stored(t, t.revenue_model_table.coalesce(1), "revenue"), "ORDER_MONTH")
    model = models.train_revenue_model(train, features.REVENUE_INPUTS, "linear")
    y = F.col("MONTHLY_REVENUE").cast("double")
    rows = models.predict(model, train, features.REVENUE_INPUTS).withColumn("_res", y - F.col("PREDICTED"))
    sums = [F.sum(F.col("_res") * F.col(c)).alias(c) for c in features.REVENUE_INPUTS]
    sizes = [F.sum(F.abs(y * F.col(c))).alias(f"{c}_size") for c in features.REVENUE_INPUTS]
    one = rows.agg(*sums, *sizes)
    each = [
        F.struct(F.lit(c).alias("FEATURE"), (F.abs(F.col(c)) <= 1e-6 * F.col(f"{c}_size") + 1e-6).alias("ORTHOGONAL"))
        for c in features.REVENUE_INPUTS
    ]
    return one.select(F.inline(F.array(*each)))


FACTS: dict[str, Callable[[Tables], DataFrame]] = {
    "rf_facts": lambda t: ticket_facts(t, "rf"),
    "lr_facts": lambda t: ticket_facts(t, "lr"),
    "importance_facts": importance_facts,
    "gbt_facts": lambda t: revenue_facts(t, "gbt"),
    "linreg_normal_equations": normal_equations,
}


SQL_AND_NESTED: dict[str, Callable[[Tables], DataFrame]] = {
    "nested_elements": message_elements,
    "nested_paths": message_heads,
    "sentiment_sql": sentiment_in_sql,
    "semantic_synonyms": by_synonyms,
    "catalog_listing": catalog_rows,
    "bulk_load_stores": bulk_stores,
    "changes_without_initial": changes_without_initial,
    "model_reload": reloaded_model,
    "boosted_facts": boosted_facts,
    "linreg_sql": line_in_sql,
    "random_order_numbers": lambda t: random_numbers(t.orders.select("ORDER_ID"), ["ORDER_ID"], "PLACE"),
}


def queries() -> dict[str, Query]:
    groups = (SILVER_GOLD, CHANGES, ASKED, SEARCH, LEARNING, STREAMS, STORAGE, FACTS, SQL_AND_NESTED)
    return {name: over_tables(fn) for group in groups for name, fn in group.items()}
