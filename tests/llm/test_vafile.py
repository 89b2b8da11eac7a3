import duckdb
import pytest

from orelake.llm import vafile
from tests.llm.helpers import by

COLUMNS = ("query_id", "rank", "vec_id", "score")


@pytest.mark.parametrize("bits", [2, 6, 8])
def test_matches_sql_over_several_blocks(spark, small, monkeypatch, bits):
    monkeypatch.setattr(vafile, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(vafile, "BLOCK_QUERIES", 4)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    want = con.execute(vafile.ORACLE).fetchall()
    got = by(vafile.topk(spark.read.parquet(f"{small}/embeddings.parquet"), bits=bits), *COLUMNS)
    assert got == sorted(want, key=str)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "q") for i in range(1, 40)]  # equal vectors: ties go to smaller ids
    rows += [(50, [1.0, 0.0], "q"), (50, [0.5, 0.0], "q"), (100, None, "q"), (150, [nan, 1.0], "q"), (200, [1.0, None], "q")]
    rows += [(250, [inf, 0.0], "q"), (300, [], "q"), (350, [1.0], "q"), (None, [9.0, 9.0], "q"), (41, [3.0, 0.0], "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = by(vafile.topk(df, k=3), *COLUMNS)
    # 300 and 350 have no other vector of their length; each row of 50 asks for itself.
    one = 256 * 256
    assert [r for r in got if r[0] == 50] == sorted(
        [(50, 1, 41, 3 * one), (50, 2, 1, one), (50, 3, 2, one)] + [(50, 1, 41, 3 * one // 2), (50, 2, 1, one // 2), (50, 3, 2, one // 2)], key=str
    ) and len(got) == 6


def test_repeated_ids_are_rows(spark):
    df = spark.createDataFrame([(50, [1.0]), (50, [3.0]), (7, [2.0])], "vec_id long, embedding array<double>")
    one = 256 * 256
    assert by(vafile.topk(df), *COLUMNS) == sorted(
        [(50, 1, 50, 3 * one), (50, 2, 7, 2 * one), (50, 1, 7, 6 * one), (50, 2, 50, 3 * one)], key=str
    )


def test_large_components_against_sql(spark, tmp_path):
    import random

    draw = random.Random(3)
    rows = [(50, [70_000.0, 1.0]), (1, [70_000.0, -2.0]), (2, [70_000.5, 3.0]), (3, [-1e7, 1e-3]), (100, [1.0, 1e7]), (150, [0.0, 0.0])]
    rows += [(200 + i, [draw.choice([-1, 1]) * 10 ** draw.uniform(0, 4), draw.choice([-1, 1]) * 10 ** draw.uniform(0, 4)]) for i in range(120)]
    rows += [(400, []), (401, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    got = by(vafile.topk(spark.read.parquet(str(tmp_path / "e"))), *COLUMNS)
    assert got == sorted(con.execute(vafile.ORACLE).fetchall(), key=str)


def test_sums_that_cancel_keep_the_true_best(spark):
    big = 1e9
    rows = [(0, [big, big, 1.0]), (1, [big, -big, 0.0]), (2, [-big, big, 1.0]), (3, [big, -big, 2.0])]
    got = by(vafile.topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2), *COLUMNS)
    assert got == [(0, 1, 3, 2 * 256 * 256), (0, 2, 2, 256 * 256)]


def test_scores_beyond_64_bits_are_cut(spark):
    df = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert by(vafile.topk(df), *COLUMNS) == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63))]


def test_fewer_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<float>")
    assert by(vafile.topk(df), *COLUMNS) == [(0, 1, 1, -65536)]
    assert vafile.topk(df.limit(0)).collect() == []
