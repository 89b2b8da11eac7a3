import duckdb

from orelake.llm import url_templates as urls
from tests.llm.helpers import by


def pages(spark, urls_, ids=None):
    rows = [(i, u, "t", "h") for i, u in zip(ids or range(len(urls_)), urls_)]
    return spark.createDataFrame(rows, "page_id long, url string, template string, host string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "page long, seen long, good long")


def test_matches_sql(spark, small):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    columns = ("page_id", "host", "path", "rule", "verdict", "template", "purity")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({urls.ORACLE})").fetchall()
    read = lambda t: spark.read.parquet(f"{small}/{t}.parquet")
    got = by(urls.judged(read("pages"), urls.page_labels(read("pages"), read("labels"))), *columns)
    assert got == sorted(want, key=str)


def test_rules_hosts_and_awkward_urls(spark):
    found = pages(
        spark,
        ["HTTP://WWW.Example.COM/en/1?x#y", "https://a.example.com/en/2", "x://b.net/fr/", "x://net/es/1", "x://bnet/es/1",
         None, "", "nothing", "://", "a://H#f", "a://Äb/p/*/q", "x://y/" + "s/" * 5000],
    )
    got = {r["page_id"]: r for r in urls.judged(found, labels(spark, [])).collect()}
    said = {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()}
    assert said[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert said[1] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert said[2] == ("b.net", "/fr/", "net/fr/", "block")
    assert said[3] == ("net", "/es/1", "net/es/", "block")
    assert said[4] == ("bnet", "/es/1", None, "allow")
    assert [said[i] for i in (5, 6, 7, 8)] == [("", "", None, "allow")] * 4
    assert said[9] == ("h", "", None, "allow") and said[10][0] == "Äb"
    assert len(got) == 12 and got[5]["purity"] == 1.0


def test_templates_are_generalised_merged_and_rejected(spark):
    rows = [f"x://h.org/{a}/{i}" for a in ("good", "fine", "junk") for i in range(100)]
    marks = [(i, 1, 0 if i >= 200 else 1) for i in range(300)]
    got = urls.judged(pages(spark, rows), labels(spark, marks)).collect()
    assert {(r["path"].split("/")[1], r["verdict"]) for r in got} == {("good", "allow"), ("fine", "allow"), ("junk", "block")}
    # Numbers are wildcards; the two branches of good pages differ from the pool of all three alike.
    assert {r["template"] for r in got if "junk" in r["path"]} == {"/junk/*"}
    even = [(i, 1, i % 2) for i in range(300)]
    assert {r["template"] for r in urls.judged(pages(spark, rows), labels(spark, even)).collect()} == {"/*/*"}


def test_repeated_rows_and_empty_table(spark):
    twice = pages(spark, ["x://h/a", "x://h/a"], ids=[1, 1])
    assert len(urls.judged(twice, labels(spark, [(1, 1, 1)])).collect()) == 2
    assert urls.judged(twice.limit(0), labels(spark, [])).collect() == []


def test_small_sections_of_large_hosts_and_deep_paths(spark):
    rows = [f"x://h.org/s{a}/{i}" for a in range(100) for i in range(20)]
    rows += [f"x://deep.org/a/b/c/d/{e}/{i}" for e in ("fine", "junk") for i in range(40)]
    junk = [u.startswith("x://h.org/s7/") or "/junk/" in u for u in rows]
    marks = [(i, 1, 0 if j else 1) for i, j in enumerate(junk)]
    got = urls.judged(pages(spark, rows), labels(spark, marks)).collect()
    assert [(r["page_id"], r["verdict"]) for r in sorted(got, key=lambda r: r["page_id"])] == [
        (i, "block" if j else "allow") for i, j in enumerate(junk)
    ]
    templates = {r["template"] for r in got if r["verdict"] == "block"}
    assert templates == {"/s7/*", "/a/b/c/d/junk/*"}


def against_sql(spark, tmp_path, urls_, marks):
    pages(spark, urls_).write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels"))
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}/*.parquet'")
    columns = ("page_id", "template", "verdict", "purity")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({urls.ORACLE})").fetchall()
    read = lambda t: spark.read.parquet(str(tmp_path / t))
    got = by(urls.judged(read("pages"), urls.page_labels(read("pages"), read("labels"))), *columns)
    assert got == sorted(want, key=str)
    return got


def test_deep_and_branching_paths_match_sql(spark, tmp_path):
    import random

    draw = random.Random(8)
    found = []
    for i in range(400):
        depth = draw.randrange(0, 9)
        found.append("x://h" + str(draw.randrange(2)) + "".join("/" + draw.choice("aab") for _ in range(depth)) + (f"/{i}" if draw.random() < 0.7 else ""))
    found += [f"x://deep/a/b/c/d/e/f/g/h/{i % 3}/z/{i}" for i in range(60)] + ["x://deep/a/b/c/d"] * 9
    marks = [(i, draw.randrange(2), draw.randrange(2)) for i in range(0, 460, 2)]
    assert len({r[1] for r in against_sql(spark, tmp_path, found, marks)}) > 10


def test_a_thousand_segments_take_few_steps(spark, monkeypatch):
    trap = "x://trap" + "/s" * 1000
    rows = [trap] * 9 + [trap + f"/t/{i}" for i in range(20)] + [trap + "/end"] * 8
    written = []
    real = urls.stored
    monkeypatch.setattr(urls, "stored", lambda df, name: written.append(name) or real(df, name))
    got = urls.judged(pages(spark, rows), labels(spark, [])).collect()
    assert {r["template"].removeprefix("/s" * 1000) for r in got} == {"", "/t/*", "/end"}
    assert len(written) < 20
