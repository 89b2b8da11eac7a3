import random
import statistics
from datetime import datetime, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from orelake.operators.ranking import exact_median, ordinal_cut, sequence_ids, top_by_dense_rank
from orelake.operators.sequences import purchase_sequence


def test_heavy_and_light_keys_give_the_same_rows(spark):
    rnd = random.Random(5)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(600):
        key = rnd.choice([1, 1, 1, 2, None])
        at = start + timedelta(days=rnd.randrange(4), hours=rnd.choice([0, 0, 5]))
        data.append((i * 700_000, key, at, None if rnd.random() < 0.2 else D(rnd.randrange(1000)) / 100))
    data.append((10**9, 3, start, None))  # a key whose only amount is missing
    df = spark.createDataFrame(data, "ID long, KEY long, AT timestamp_ntz, AMOUNT decimal(12,2)")

    def result(limit):
        out = purchase_sequence(df, "KEY", "AT", "ID", "AMOUNT", heavy_rows=limit)
        return sorted(map(str, out.collect()))

    plain = result(10**9)
    assert len(plain) == len(data)
    assert result(150) == plain  # only key 1 is heavy
    assert result(0) == plain  # every key is


def test_sequence_values(spark):
    day = datetime(2024, 3, 1)
    df = spark.createDataFrame(
        [(2, 1, day, D(5)), (1, 1, day, D(3)), (3, 1, day + timedelta(days=4), None), (4, 2, day, D(1))],
        "ID long, KEY long, AT timestamp_ntz, AMOUNT decimal(12,2)",
    )
    got = {r.ID: r for r in purchase_sequence(df, "KEY", "AT", "ID", "AMOUNT").collect()}
    assert [got[i].ORDER_SEQUENCE for i in (1, 2, 3, 4)] == [1, 2, 3, 1]
    assert [got[i].RUNNING_TOTAL for i in (1, 2, 3, 4)] == [3, 8, 8, 1]
    assert [got[i].DAYS_SINCE_PREV_ORDER for i in (1, 2, 3, 4)] == [None, 0, 4, None]
    assert got[3].AVG_ORDER_VALUE == 4 and got[3].TOTAL_CUSTOMER_ORDERS == 3


def test_no_window_without_a_partition_sees_all_rows(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("V"), "id")
    got = top_by_dense_rank(df, "V", 3, "R")
    assert sorted({(r.V, r.R) for r in got.collect()}) == [(4, 3), (5, 2), (6, 1)]
    assert got.count() == 7 * 3


def test_median_matches_a_plain_one(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), D(rnd.randrange(-50000, 90000)) / 100) for _ in range(500)]
    data += [("one", D("7.25")), ("two", D("-1")), ("two", D("2.01")), ("none", None), ("same", D(4)), ("same", D(4))]
    df = spark.createDataFrame(data, "G string, V decimal(12,2)")
    got = {r.G: r.M for r in exact_median(df, ["G"], "V", "M", bucket_width=10).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_ids_are_unique_and_repeatable(spark):
    df = spark.range(200).withColumn("name", F.concat(F.lit("k"), "id"))
    first = {r.name: r.i for r in sequence_ids(df, ["name"], "i", start=11, per_bucket=1).collect()}
    again = {r.name: r.i for r in sequence_ids(df.repartition(7), ["name"], "i", start=11, per_bucket=1).collect()}
    assert first == again and len(set(first.values())) == 200
    assert min(first.values()) >= 11 and max(first.values()) < 11 + 201 * 8


def test_ordinal_cut(spark):
    df = spark.createDataFrame([(v,) for v in (5, 1, 1, 3, 2, 4)], "m long")
    assert df.filter(F.col("m") < ordinal_cut(df, "m", 0.8)).distinct().count() == 4
