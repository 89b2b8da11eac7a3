"""Small tables with awkward rows, for all operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, block long, fp string"


def docs(spark, texts, ids=None, langs=None, sources=None):
    """Documents with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = langs or [None] * len(texts)
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, g, s, None, "k", 7, "x") for i, t, g, s in zip(ids, texts, langs, sources)]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", " \n\t ", "one", "one", "x" * 100_000, "word " * 30_000, "Ünïcode 中文 😀", "a\x00b \x1c c"]


def by(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
