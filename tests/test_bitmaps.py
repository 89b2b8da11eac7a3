import random

from pyspark.sql import functions as F

from orelake.operators import bitmaps


def rows_of(n, seed):
    draw = random.Random(seed)
    ids = [None, 0, -1, -40_000, 32_768, 32_769, 2**40, *range(1, 200)]
    return [(draw.choice("abc"), draw.choice(["x", "y", None]), draw.choice(ids)) for _ in range(n)]


def distinct(rows, *at):
    held = {}
    for r in rows:
        held.setdefault(tuple(r[i] for i in at), set()).add(r[2])
    return {k: len(v - {None}) for k, v in held.items() if v - {None}}


def counts(df, *names):
    return {tuple(r[n] for n in names): r.N for r in df.collect()}


def test_one_summary_answers_at_every_level(spark):
    rows = rows_of(900, 1)
    df = spark.createDataFrame(rows, "g string, h string, id long").repartition(4)
    held = bitmaps.id_bitmaps(df, ["g", "h"], "id")
    assert counts(bitmaps.distinct_counts(held, ["g", "h"], "N"), "g", "h") == distinct(rows, 0, 1)
    assert counts(bitmaps.distinct_counts(held, ["g"], "N"), "g") == distinct(rows, 0)
    assert counts(bitmaps.distinct_counts(held, ["h"], "N"), "h") == distinct(rows, 1)
    assert counts(bitmaps.distinct_counts(held, [], "N")) == distinct(rows)
    everything = bitmaps.counts_by_level(
        held, {"G": [F.col("g"), F.lit(None).cast("string")], "ALL": [F.lit(None).cast("string")] * 2}, ["g", "h"], "N"
    )
    got = counts(everything, "LEVEL", "g", "h")
    assert got == {("G", k, None): n for (k,), n in distinct(rows, 0).items()} | {("ALL", None, None): distinct(rows)[()]}


def test_summaries_are_merged_not_recounted(spark):
    first, second = rows_of(300, 2), rows_of(300, 3)
    held = [bitmaps.id_bitmaps(spark.createDataFrame(r, "g string, h string, id long"), ["g"], "id") for r in (first, second)]
    both = bitmaps.added(*held, ["g"])
    assert counts(bitmaps.distinct_counts(both, ["g"], "N"), "g") == distinct(first + second, 0)


def test_no_ids_and_no_expand(spark):
    df = spark.createDataFrame([("a", None, None)], "g string, h string, id long")
    held = bitmaps.id_bitmaps(df, ["g"], "id")
    assert bitmaps.distinct_counts(held, ["g"], "N").count() == 0
    assert [r.N for r in bitmaps.distinct_counts(held, [], "N").collect()] == [0]
    assert "Expand" not in bitmaps.distinct_counts(held, ["g"], "N")._jdf.queryExecution().executedPlan().toString()
