import re

from contract.queries import Tables


def test_the_first_cut_of_a_shuffle_does_not_follow_the_session(spark):
    Tables(spark, "none")  # the fixture's session names 4 partitions
    grouped = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    text = grouped._jdf.queryExecution().executedPlan().toString()
    assert int(re.search(r"hashpartitioning\(k[^,]*, (\d+)\)", text)[1]) > 200
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert sorted(r["count"] for r in grouped.collect()) == [100] * 10


def test_a_task_reads_a_small_split_of_a_large_file(spark, tmp_path):
    path = f"{tmp_path}/large"
    spark.range(6_000_000).selectExpr("xxhash64(id) AS k").coalesce(1).write.parquet(path)  # random longs: 48 MB
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set(names[0], "1")  # as if the input were far larger than the cluster
        spark.conf.unset(names[1])
        Tables(spark, "none")
        assert spark.read.parquet(path).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset(names[0])
