"""Plans, not results: what the executed plan of a query must and must not hold."""

import re

import pytest

from contract import queries as registry

LAZY = {**registry.SILVER_GOLD, **registry.ASKED, **registry.SEARCH, **registry.LEARNING, **registry.CHANGES}
# These run jobs while they are built (training, tables written between steps).
EAGER = {
    "feature_importance", "rf_predict", "lr_predict", "gbt_predict", "linreg_predict", "orders_scd2", "orders_history_view",
    "daily_order_metrics", "chrono_split", "orders_scd2_keys", "sales_summary_incremental", "customer_360_incremental",
    "search_index_build", "vector_topk_grouped", "semantic_rollup_month", "semantic_rollup_segment",
}


def plan(spark, small, name):
    df = registry.queries()[name](spark, small)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(LAZY) - EAGER))
def test_no_cross_join_and_no_python_in_the_row_path(spark, small, name):
    text = plan(spark, small, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text
    assert ("MapInPandas" in text) == (name == "vector_topk")


def test_summaries_read_and_shuffle_only_what_they_need(spark, small):
    text = plan(spark, small, "sales_summary")
    assert "customer.parquet" not in text  # no customer attribute is used
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(o_orderdate\)", text)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_items_reach_the_orders_in_one_shuffle(spark, small):
    text = plan(spark, small, "monthly_revenue_by_category")
    assert "part.parquet" in text and text.count("lineitem.parquet") == 1
    assert "l_discount" not in text


@pytest.mark.parametrize("name", ["keyword_search", "keyword_search_filtered", "text_vector_search", "hybrid_search"])
def test_search_reads_no_text(spark, small, name):
    text = plan(spark, small, name)
    if name != "keyword_search_filtered":  # whose display columns are found from the texts
        assert "documents.parquet" not in text
    assert not re.search(r"Exchange[^\n]*\b(text|REVIEW_TEXT)#", text)
    assert re.search(r"(keyword|vector)_share", text)


def test_search_limits_every_task_before_the_last_shuffle(spark, small):
    text = plan(spark, small, "keyword_search")
    assert "WindowGroupLimit" in text and "Partial" in text
