from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orelake.operators.semantic import (
    Entity,
    Expression,
    Relationship,
    SemanticError,
    SemanticModel,
    build_rollup,
    coarser_rollup,
    semantic_query,
)
from orelake.plans import questions
from orelake.plans.retail_model import RETAIL_MODEL
from orelake.sources import bronze


@pytest.fixture(scope="module")
def retail(spark, small):
    made = {n: bronze.TABLES[n](spark, small) for n in ("customers", "products", "orders", "order_items")}
    return {**made, "reviews": bronze.product_reviews(spark, small)}


def test_names_and_synonyms():
    assert RETAIL_MODEL.resolve("Revenue") == "total_revenue"
    assert RETAIL_MODEL.resolve("orders.region") == "region"
    assert RETAIL_MODEL.resolve("AOV") == "average_order_value"
    with pytest.raises(SemanticError, match="ambiguous"):
        RETAIL_MODEL.resolve("type")
    with pytest.raises(SemanticError, match="unknown"):
        RETAIL_MODEL.resolve("weather")


def test_description_lists_everything(spark):
    counts = {r.KIND: r["count"] for r in RETAIL_MODEL.describe(spark).groupBy("KIND").count().collect()}
    assert counts == {"FACT": 4, "DIMENSION": 19, "METRIC": 12}


def test_unreachable_dimension_is_an_error(retail):
    with pytest.raises(SemanticError):
        semantic_query(RETAIL_MODEL, retail, ["total_revenue"], ["category"])


def test_two_paths_are_an_error(spark):
    model = SemanticModel(
        [Entity("a", "id"), Entity("b", "id")],
        [Relationship("a", "x", "b"), Relationship("a", "y", "b")],
        dimensions=[Expression("b", "name", lambda: F.col("n"))],
        metrics=[Expression("a", "rows", lambda: F.count(F.lit(1)))],
    )
    a, b = spark.createDataFrame([(1, 1, 1)], "id long, x long, y long"), spark.createDataFrame([(1, "n")], "id long, n string")
    with pytest.raises(SemanticError, match="2 ways"):
        semantic_query(model, {"a": a, "b": b}, ["rows"], ["name"])


def test_each_metric_keeps_its_grain(retail):
    """Items reach the customer through the order, reviews directly; neither multiplies the other."""
    got = semantic_query(RETAIL_MODEL, retail, ["total_units_sold", "review_count", "order_count"], ["customer_segment"])
    total = got.agg(F.sum("total_units_sold"), F.sum("review_count"), F.sum("order_count")).first()
    assert tuple(total) == (
        retail["order_items"].agg(F.sum("QUANTITY")).first()[0],
        retail["reviews"].count(),
        retail["orders"].count(),
    )


def test_without_dimensions(retail):
    got = semantic_query(RETAIL_MODEL, retail, ["order_count", "customer_count"]).collect()
    assert [tuple(r) for r in got] == [(retail["orders"].count(), retail["customers"].count())]


def test_filter_on_a_dimension_that_is_not_shown(retail):
    by_year = questions.net_revenue_by_region(retail, 2000)
    assert by_year.columns == ["region", "net_revenue"]
    assert by_year.count() == 4


def as_rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


def without_parts(model):
    """The same model, whose metrics are always aggregated from joined rows."""
    return replace(model, metrics=[replace(m, parts=None) for m in model.metrics])


METRICS = [m.name for m in RETAIL_MODEL.metrics if m.entity == "orders"]


@pytest.mark.parametrize("dims", [["customer_country"], ["customer_segment", "region"], ["customer_state", "order_month"]])
def test_parts_added_up_before_the_join_equal_joined_rows(retail, dims):
    got = semantic_query(RETAIL_MODEL, retail, METRICS, dims)
    want = semantic_query(without_parts(RETAIL_MODEL), retail, METRICS, dims)
    doubles = [F.col(m).cast("double") for m in METRICS]
    assert as_rows(got.select(*dims, *doubles)) == as_rows(want.select(*dims, *doubles))


def test_facts_are_aggregated_before_they_meet_a_parent(retail):
    plan = semantic_query(RETAIL_MODEL, retail, ["net_revenue"], ["customer_country"])._jdf.queryExecution().optimizedPlan().toString()
    before_join = plan[plan.index("Join"):]
    side = before_join[: before_join.index("orders.parquet")] if "orders.parquet" in before_join else before_join
    assert plan.count("Aggregate") == 2 and "Aggregate" in side


@pytest.fixture(scope="module")
def rollups(retail, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("rollups"))
    fine = build_rollup(RETAIL_MODEL, retail, "orders", ["order_month", "order_year", "region", "segment", "customer_country"], f"{base}/fine")
    coarse = coarser_rollup(RETAIL_MODEL, fine, ["order_year", "region"], f"{base}/coarse")
    return fine, coarse


def test_the_smallest_rollup_that_covers_is_read(retail, rollups):
    fine, coarse = rollups
    assert coarse.size < fine.size and "unique_customers" not in fine.metrics
    names = ["total_revenue", "net_revenue", "average_order_value", "order_count", "cancelled_orders"]
    cases = [(["region"], coarse), (["order_year", "region"], coarse), (["order_month"], fine), (["customer_country", "region"], fine), ([], coarse)]
    for dims, used in cases:
        got = semantic_query(RETAIL_MODEL, retail, names, dims, rollups=rollups)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan
        assert ("order_month" in plan or "customer_country" in plan) == (used is fine)
        want = semantic_query(without_parts(RETAIL_MODEL), retail, names, dims)
        doubles = [F.col(m).cast("double") for m in names]
        assert as_rows(got.select(*dims, *doubles)) == as_rows(want.select(*dims, *doubles))


def test_what_no_rollup_has_comes_from_the_table(retail, rollups):
    got = semantic_query(RETAIL_MODEL, retail, ["unique_customers", "order_count"], ["region"], rollups=rollups)
    want = semantic_query(without_parts(RETAIL_MODEL), retail, ["unique_customers", "order_count"], ["region"])
    assert as_rows(got) == as_rows(want)
    where = F.col("order_year") == 2000
    got = semantic_query(RETAIL_MODEL, retail, ["net_revenue"], ["region"], where, ["order_year"], rollups)
    assert as_rows(got) == as_rows(semantic_query(without_parts(RETAIL_MODEL), retail, ["net_revenue"], ["region"], where, ["order_year"]))
    with pytest.raises(SemanticError):
        coarser_rollup(RETAIL_MODEL, rollups[1], ["customer_country"], "unused")
