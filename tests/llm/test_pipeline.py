import __spark_entry__
import corpus_pipeline
from orelake.llm import decontaminate, language, mixing, simhash
from orelake.llm.queries import queries
from tests.llm.helpers import docs


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names and set(queries()) < set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_stages_take_effect(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    b = spark.read.parquet(f"{small}/benchmark.parquet")
    model = language.fit(d)
    known = language.keep_known(d, model, language.limits(d, model))
    assert 0.98 * d.count() <= known.count() <= d.count()
    one = simhash.keep_one(known)
    clean = decontaminate.keep_clean(one, b)
    assert one.count() == simhash.near_groups(known).select("component_id").distinct().count()
    bad = decontaminate.contamination(one, b).filter("contaminated").count()
    assert bad > 0 and clean.count() == one.count() - bad
    out = corpus_pipeline.run(spark, small).orderBy("start")
    ids = [r["doc_id"] for r in out.collect()]
    assert set(ids) == {r["doc_id"] for r in clean.collect()} and len(ids) >= len(set(ids))


def test_noise_with_letters_goes_and_clean_texts_stay(spark, small):
    import random

    draw = random.Random(2)
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(d)
    least = language.limits(d, model)
    noise = [" ".join("".join(draw.choices("bcdfghjklmnpqrstvwxz", k=draw.randint(2, 9))) for _ in range(200)) for _ in range(40)]
    kept = language.keep_known(docs(spark, noise), model, least).count()
    assert kept <= 4
    clean = spark.read.parquet(f"{small}/documents.parquet").filter("lang IS NOT NULL AND length(text) > 200")
    assert language.keep_known(clean, model, least).count() >= 0.98 * clean.count()


def test_ids_are_written_in_the_order_of_the_mixture(spark, small, tmp_path):
    d = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    corpus_pipeline.mixing_stage(spark, d, small).write.parquet(str(tmp_path / "m"))
    places = mixing.mixed(d).orderBy("place", "epoch", "doc_id").collect()
    out = corpus_pipeline.token_stage(spark, spark.read.parquet(str(tmp_path / "m")), small).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [r["doc_id"] for r in places]
    assert [r["doc_id"] for r in out] != sorted(r["doc_id"] for r in out)


def test_stages_on_awkward_and_empty_documents(spark, small):
    # No language is learned, so all texts are rejected; the other stages take what is given.
    rows = docs(spark, [None, "", "some words", "some words", "12"], ids=[None, 1, 2, 3, 3])
    for d in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, small)
            assert out.columns == (d.columns if name != "token_ids" else ["doc_id", "start", "n_tokens", "ids_crc32"])
            out.collect()


def test_repeated_ids_keep_one_row_that_no_task_chooses(spark):
    rows = docs(spark, ["b text", "a text", "b text", "other words here", None], ids=[1, 1, 1, 2, None])
    for turn in (rows, rows.orderBy("text"), rows.repartition(4)):
        found = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(turn).collect())
        assert len(found) == 3 and found == sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(rows).collect())
