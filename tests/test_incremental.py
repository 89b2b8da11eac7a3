import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from orelake.operators.history import apply_changes, table_changes
from orelake.plans import gold, incremental, silver
from orelake.sources import bronze, versions

AS_OF = date(2001, 8, 2)


@pytest.fixture(scope="module")
def tables(spark, small):
    names = ("orders", "customers")
    return {n: bronze.TABLES[n](spark, small).cache() for n in names}


def random_state(orders, seed):
    """The orders as some later day might find them: some gone, some new, some changed."""
    draw = F.pmod(F.xxhash64("ORDER_ID", F.lit(seed)), F.lit(10))
    there = orders.filter(draw >= 3)
    moved = F.pmod(F.xxhash64("ORDER_ID", F.lit(seed + 100)), F.lit(5))
    return there.withColumns({
        "TOTAL_AMOUNT": F.when(moved == 0, F.lit(None)).when(moved == 1, F.col("TOTAL_AMOUNT") + 7).otherwise(F.col("TOTAL_AMOUNT")).cast("decimal(12,2)"),
        "DISCOUNT_AMOUNT": F.when(moved == 2, F.lit(None)).otherwise(F.col("DISCOUNT_AMOUNT")).cast("decimal(10,2)"),
        "CUSTOMER_ID": F.when(moved == 3, F.lit(seed).cast("long")).otherwise(F.col("CUSTOMER_ID")),
        "ORDER_DATE": F.when((moved == 4) & (draw == 5), F.lit("1999-05-05 01:00:00").cast("timestamp_ntz")).otherwise(F.col("ORDER_DATE")),
    })


def same(a, b):
    assert a.schema.simpleString() == b.schema.simpleString()
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def assert_current(lake, orders, customers):
    cleaned = silver.orders_cleaned(orders)
    enriched = silver.orders_enriched(cleaned, customers)
    same(lake.table("orders_cleaned"), cleaned)
    same(lake.table("orders_enriched"), enriched)
    same(lake.table("sales_summary"), gold.sales_summary(enriched))
    same(lake.customer_360(customers, AS_OF), gold.customer_360(customers, enriched, AS_OF))


def test_equals_a_rebuild_after_random_batches(spark, tables, tmp_path):
    orders, customers = tables["orders"], tables["customers"]
    lake = incremental.Lake(spark, str(tmp_path / "lake"), orders, customers, buckets=4)
    states = [orders.limit(0), orders, *[random_state(orders, s) for s in (1, 2, 3)]]
    for step, (old, new) in enumerate(zip(states, states[1:])):
        lake.refresh(table_changes(old, new, "ORDER_ID"), customers, step)
        assert_current(lake, new, customers)


def test_only_touched_partitions_are_written_and_a_step_may_be_repeated(spark, tables, tmp_path):
    orders, customers = tables["orders"], tables["customers"]
    lake = incremental.Lake(spark, str(tmp_path / "lake"), orders, customers, buckets=16)
    lake.refresh(table_changes(orders.limit(0), orders, "ORDER_ID"), customers, 0)
    one = orders.filter("TOTAL_AMOUNT > 0").orderBy("ORDER_ID").limit(1).collect()[0]
    new = orders.withColumn("TOTAL_AMOUNT", F.when(F.col("ORDER_ID") == one.ORDER_ID, F.lit(9)).otherwise(F.col("TOTAL_AMOUNT")).cast("decimal(12,2)"))
    changes = table_changes(orders, new, "ORDER_ID")
    for _ in range(2):  # the second time as after a failure
        touched = lake.refresh(changes, customers, 1)
        assert touched == {"month_part": {one.ORDER_DATE.strftime("%Y-%m")}, "bucket_part": touched["bucket_part"]}
        assert len(touched["bucket_part"]) == 1
        assert_current(lake, new, customers)
    parts = versions.current_parts(spark, f"{tmp_path}/lake/sales_cells")
    assert sorted(p for p, v in parts.items() if v == 1) == sorted(touched["month_part"]) and len(parts) > 10


def test_several_commits_in_a_batch_act_as_their_net_change(spark, tables, tmp_path):
    orders, customers = tables["orders"], tables["customers"]
    middle, last = random_state(orders, 5), random_state(orders, 6)
    lake = incremental.Lake(spark, str(tmp_path / "lake"), orders, customers, buckets=4)
    lake.refresh(table_changes(orders.limit(0), orders, "ORDER_ID"), customers, 0)
    commits = [table_changes(a, b, "ORDER_ID").withColumn("_commit", F.lit(i)) for i, (a, b) in enumerate([(orders, middle), (middle, last)])]
    lake.refresh(commits[0].unionByName(commits[1]), customers, 1)
    assert_current(lake, last, customers)
    net = incremental.collapse_net(commits[0].unionByName(commits[1]), "ORDER_ID")
    same(apply_changes(orders, net, "ORDER_ID"), last)


def test_partitions_of_a_versioned_table(spark, tmp_path):
    path, like = str(tmp_path / "t"), spark.createDataFrame([], "k long, p string")
    assert versions.read_parts(spark, path, like, "p").count() == 0
    versions.replace_parts(spark.createDataFrame([(1, "a"), (2, "b")], like.schema), path, "p", {"a", "b", "c"}, 0)
    versions.replace_parts(spark.createDataFrame([(3, "b")], like.schema), path, "p", {"b"}, 1)
    assert versions.current_parts(spark, path) == {"a": 0, "b": 1, "c": None}
    assert sorted(r.k for r in versions.read_parts(spark, path, like, "p").collect()) == [1, 3]
    assert [r.k for r in versions.read_parts(spark, path, like, "p", {"a"}).collect()] == [1]
    assert sorted(r.k for r in versions.read_parts(spark, path, like, "p", before=1).collect()) == [1, 2]
    versions.replace_parts(spark.createDataFrame([], like.schema), path, "p", {"a", "b"}, 2)
    assert versions.read_parts(spark, path, like, "p").count() == 0
    versions.replace_parts(spark.createDataFrame([(9, "c")], like.schema), path, "p", {"c"}, 3)
    assert versions.drop_unused(spark, path) == [0, 1, 2]
    assert [r.k for r in versions.read_parts(spark, path, like, "p").collect()] == [9]
