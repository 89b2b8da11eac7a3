import zlib

from orelake.llm import language
from tests.llm.helpers import AWKWARD, by, docs

EN = "the cat and the dog went to the house with that other friend of mine"
DE = "der hund und die katze gingen nicht mit dem anderen freund in das haus"
FR = "le chien et le chat sont venus dans la maison avec une autre amie pour les voir"


def corpus(spark, copies=12):
    texts, langs = [], []
    for i in range(copies):
        for lang, text in (("en", EN), ("de", DE), ("fr", FR)):
            words = text.split()
            texts.append(" ".join(words[i % 5 :] + words[: i % 5]))
            langs.append(lang)
    return docs(spark, texts, langs=langs)


def test_held_out_accuracy(spark, small):
    d = spark.read.parquet(f"{small}/documents.parquet")
    rows = language.predict(d, language.fit(d)).join(d.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == d.count() and 30 < len(held) < 80
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_texts_and_sample_bound(spark):
    model = language.fit(corpus(spark), per_language=3)
    assert model.members == {"germanic": ["de", "en"], "romance": ["fr"]}
    found = language.predict(docs(spark, [*AWKWARD, "123 $$ !", EN, DE, FR, FR]), model).collect()
    said = [r["lang_pred"] for r in sorted(found, key=lambda r: r["doc_id"])]
    assert said[:3] == ["und"] * 3 and said[9] == "und"
    assert said[10:] == ["en", "de", "fr", "fr"]
    sample = language.labelled_sample(corpus(spark).unionByName(corpus(spark)), 3).groupBy("lang").count()
    assert all(r["count"] <= 3 for r in sample.collect())


def test_few_languages_and_empty_tables(spark):
    one = docs(spark, [EN, EN, None], langs=["en", "en", "en"], ids=[0, 1, 3])
    model = language.fit(one)
    assert by(language.predict(one, model), "doc_id", "lang_pred") == [(0, "en"), (1, "en"), (3, "und")]
    none = language.fit(docs(spark, [EN, DE], langs=[None, None]))
    assert by(language.predict(one, none), "lang_pred", "score") == [("und", 0.0)] * 3
    assert language.predict(one.limit(0), language.fit(one.limit(0))).collect() == []
    nameless = docs(spark, [EN], langs=["en"], ids=[None])
    assert language.fit(nameless).members == {}
    assert by(language.predict(nameless, model), "doc_id", "held_out", "lang_pred") == [(None, False, "en")]


def test_filter_keeps_columns_and_rows(spark):
    d = docs(spark, [EN, None, "", "12", DE, DE], ids=[0, 1, 2, 3, 4, 4])
    kept = language.keep_known(d, language.fit(corpus(spark)))
    assert kept.columns == d.columns
    assert by(kept, "doc_id", "text") == [(0, EN), (4, DE), (4, DE)]


def test_every_labelled_text_is_learned_from(spark, monkeypatch):
    d, seen = corpus(spark, copies=2200), []
    monkeypatch.setattr(language, "_machines", lambda rows, *a: seen.append(rows.groupBy("lang").count().collect()) or [])
    language.fit(d)
    want = d.filter("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2").groupBy("lang").count().collect()
    assert sorted(seen[0]) == sorted(want) and all(r["count"] > 1500 for r in want)


def test_limits_come_from_every_held_out_text(spark, monkeypatch):
    import random

    draw = random.Random(3)
    rows = [(s, draw.choice([draw.random(), 0.25, 1.0, 0.0])) for s in (3, 4, 5) for _ in range(draw.randint(60, 900))]
    rows += [(6, 0.5)] * 10
    df = spark.createDataFrame(rows, "size int, score double")
    for share in (0.0, 0.001, 0.3, 0.5, 1.0):
        got = language.lowest(df, share, 50)
        want = df.groupBy("size").agg({"*": "count"}).filter("size < 6").select("size").collect()
        exact = dict(df.filter("size < 6").selectExpr("size", "score").groupBy("size").agg(_percentile(share)).collect())
        assert set(got) == {r["size"] for r in want}
        assert all(abs(got[k] - exact[k]) < 1e-12 for k in got)
    many = docs(spark, [EN] * 12_000 + ["the x"] * 8000, langs=["en"] * 20_000)
    model, counted = language.Model({"germanic": ["en"]}, [], {"germanic": []}, language.DIMENSIONS), []
    monkeypatch.setattr(language, "lowest", lambda scores, *a: counted.append(scores.count()) or {})
    language.limits(many, model)
    held = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert counted == [len(held)] and len(held) > 1500


def _percentile(share):
    from pyspark.sql import functions as F

    return F.percentile("score", share)
