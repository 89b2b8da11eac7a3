"""URL filtering by a tree of path templates, learned from labelled pages.

Per host, the paths form a tree of segments. Level by level, a segment that holds
fewer than ``MIN_PAGES`` pages of its node is generalised into a wildcard, however
large the node is; below nodes of fewer pages all segments are. What all paths below a
node have in common is taken in one step, so the steps are as many as a path has
branches, not segments. From the deepest level up, branches that differ in one literal segment and whose labels are statistically
alike are then merged into a wildcard as well. A template is rejected if the
share of good pages among its labelled ones, drawn towards the share of all
labelled pages by ``STRENGTH`` further pages, is below ``MIN_PURITY``. Listed
rules come before the templates.

Pages are first counted per distinct path; everything that follows is a grouping
or a join with tables of literal segments or templates.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import bounded, stored

MIN_PAGES = 8
MERGE_Z = 2.0
STRENGTH = 10.0
MIN_PURITY = 0.5

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_END = "[/?#]"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.substring(u, F.locate("://", u) + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def ruled(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _segments() -> Column:
    all_of = F.filter(F.split("path", "/"), lambda s: s != "")
    return F.transform(all_of, lambda s: F.when(s == "*", "%2A").otherwise(s))


def _shared(least: str, most: str) -> Column:
    """How many segments two arrays begin with in common. Between the least and the
    greatest of some arrays these are common to all."""
    n = F.least(F.size(least), F.size(most))
    differ = F.filter(F.sequence(F.lit(1), n), lambda i: F.get(least, i - 1) != F.get(most, i - 1))
    return F.when(n == 0, 0).otherwise(F.coalesce(F.get(differ, F.lit(0)) - 1, n))


def generalised(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n, seen, good) with ``template``: an array of segments."""
    found = paths.withColumn("segs", _segments()).withColumn("template", F.array().cast("array<string>"))
    level = 0
    while True:
        deep = found.filter(F.size("segs") > F.size("template")).withColumn("rest", F.slice("segs", F.size("template") + 1, F.size("segs")))
        nodes = deep.groupBy("host", "template").agg(F.sum("n").alias("of"), F.min("rest").alias("least"), F.max("rest").alias("most"))
        nodes = nodes.filter(F.col("of") >= MIN_PAGES).select("host", "template", _shared("least", "most").alias("shared"))
        nodes = stored(nodes, f"nodes{level}")
        if nodes.isEmpty():
            break
        held = deep.join(bounded(nodes), ["host", "template"])
        held = held.withColumn("seg", F.get("rest", F.col("shared"))).filter(F.col("seg").isNotNull())
        branches = held.groupBy("host", "template", "seg").agg(F.sum("n").alias("n"))
        large = branches.filter(F.col("n") >= MIN_PAGES).select("host", "template", "seg")
        literal = stored(large, f"literal{level}").withColumn("literal", F.lit(True))
        at = found.join(bounded(nodes), ["host", "template"], "left").withColumn("shared", F.when(F.size("segs") > F.size("template"), F.col("shared")))
        at = at.withColumn("seg", F.get("segs", F.size("template") + F.col("shared")))
        at = at.join(bounded(literal), ["host", "template", "seg"], "left")
        common = F.slice("segs", F.size("template") + 1, F.coalesce("shared", F.lit(0)))
        step = F.when(F.col("seg").isNull(), F.array()).otherwise(F.array(F.when(F.col("literal"), F.col("seg")).otherwise("*")))
        grown = F.when(F.col("shared").isNull(), F.col("template")).otherwise(F.concat("template", common, step))
        found = at.withColumn("template", grown).drop("seg", "literal", "shared")
        found = stored(found, f"level{level}")
        level += 1
    rest = F.array_repeat(F.lit("*"), F.size("segs") - F.size("template"))
    return found.withColumn("template", F.concat("template", rest)).drop("segs")


def _alike() -> Column:
    p = F.col("pool_good") / F.col("pool_seen")
    spread = F.sqrt(F.col("seen") * p * (1 - p))
    z = (F.col("good") - F.col("seen") * p) / spread
    return F.coalesce((F.col("pool_seen") == 0) | (F.col("seen") == 0) | (spread == 0) | (F.abs(z) <= MERGE_Z), F.lit(True))


def merged(templates: DataFrame) -> DataFrame:
    """(host, template, merged): each template with the one it became part of.
    ``templates`` has (host, template, seen, good)."""
    found = templates.withColumn("merged", F.col("template"))
    # Only where templates of one length differ can branches meet; a merge above or below
    # makes no new difference.
    each = templates.select("host", F.size("template").alias("size"), F.posexplode("template").alias("level", "seg"))
    differ = each.groupBy("host", "size", "level").agg((F.min("seg") != F.max("seg")).alias("differ")).filter("differ")
    levels = sorted(r["level"] for r in differ.select("level").distinct().collect())  # no more than a path has segments
    for level in reversed(levels):
        here = F.size("merged") > level
        star = F.concat(F.slice("merged", 1, level), F.array(F.lit("*")), F.slice("merged", level + 2, 1 << 30))
        branches = found.groupBy("host", "merged").agg(F.sum("seen").alias("seen"), F.sum("good").alias("good"))
        branches = branches.filter(here).withColumn("pool", star)
        pools = branches.groupBy("host", "pool").agg(
            F.sum("seen").alias("pool_seen"), F.sum("good").alias("pool_good"), F.count(F.lit(1)).alias("members")
        )
        moves = branches.join(pools, ["host", "pool"]).filter((F.col("members") > 1) & _alike())
        moves = moves.select("host", "merged", F.col("pool").alias("to"))
        found = found.join(moves, ["host", "merged"], "left").withColumn("merged", F.coalesce("to", "merged")).drop("to")
        found = stored(found, f"merge{level}")
    return found.select("host", "template", "merged")


def judged(pages: DataFrame, labels: DataFrame, page_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every page.

    ``labels`` (page, seen, good) counts the labelled and the good ones of a page;
    pages without a row are unlabelled. Without any labels every purity is 1.
    A null url, one without ``://`` and an empty path have the empty template of
    their host. Repeated rows each keep a row and count each.
    """
    host, path = host_and_path(url_col)
    rows = pages.select(F.col(page_col).alias("page_id"), host.alias("host"), path.alias("path"))
    known = labels.groupBy(F.col("page").alias("page_id")).agg(F.sum("seen").alias("seen"), F.sum("good").alias("good"))
    counted = rows.join(known, "page_id", "left").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
    )
    paths = generalised(counted)
    leaves = stored(paths.groupBy("host", "template").agg(F.sum("seen").alias("seen"), F.sum("good").alias("good")), "leaves")
    parts = leaves.join(merged(leaves), ["host", "template"])
    groups = parts.groupBy("host", "merged").agg(F.sum("seen").alias("seen"), F.sum("good").alias("good"))
    every = leaves.agg(F.sum("seen").alias("seen"), F.sum("good").alias("good")).first()
    prior = every["good"] / every["seen"] if every["seen"] else 1.0
    purity = (F.col("good") + F.lit(STRENGTH) * F.lit(prior)) / (F.col("seen") + F.lit(STRENGTH))
    groups = groups.select("host", "merged", purity.alias("purity"))
    verdicts = parts.select("host", "template", "merged").join(groups, ["host", "merged"])
    verdicts = stored(verdicts.select("host", "template", F.array_join("merged", "/").alias("merged"), "purity"), "verdicts")
    per_path = paths.select("host", "path", "template").join(bounded(verdicts), ["host", "template"])
    per_path = per_path.select("host", "path", F.concat(F.lit("/"), F.col("merged")).alias("template"), "purity")
    rule, said = ruled(rules)
    method = F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")
    return rows.join(per_path, ["host", "path"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"),
        "template", F.round("purity", 6).alias("purity"),
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of the documents whose number ends a page's path, as (page, seen, good):
    good is quality 1 and not toxic. Label rows without a quality are passed over."""
    _, path = host_and_path("url")
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)([.][A-Za-z]+)?/?$', 1) AS BIGINT)")
    numbered = pages.select("page_id", path.alias("path")).select("page_id", number.alias("doc_id"))
    fine = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("seen"), F.sum(fine.cast("long")).alias("good")
    )
    once = numbered.filter(F.col("doc_id").isNotNull()).distinct()
    return once.join(known, "doc_id").select(F.col("page_id").alias("page"), "seen", "good")


def _oracle() -> str:
    ctes = [
        r"""
rest AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
rows_ AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
known AS (SELECT doc_id, count(*) AS seen, sum(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
    FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
numbered AS (SELECT DISTINCT page_id, try_cast(regexp_extract(path, '([0-9]+)([.][A-Za-z]+)?/?$', 1) AS BIGINT) AS doc_id FROM rows_),
page_known AS (SELECT page_id, sum(seen) AS seen, sum(good) AS good FROM numbered JOIN known USING (doc_id) GROUP BY page_id),
paths AS (SELECT host, path, count(*) AS n, coalesce(sum(seen), 0) AS seen, coalesce(sum(good), 0) AS good
    FROM rows_ LEFT JOIN page_known USING (page_id) GROUP BY host, path),
cut AS (SELECT *, [CASE WHEN s = '*' THEN '%2A' ELSE s END FOR s IN string_split(path, '/') IF s <> ''] AS every FROM paths)"""
    ]
    ctes.append(
        f"""
g(level, host, path, n, seen, good, segs, template) AS (
    SELECT 0, host, path, n, seen, good, every, CAST([] AS VARCHAR[]) FROM cut
    UNION ALL
    SELECT level + 1, host, path, n, seen, good, segs, list_append(template, CASE WHEN sum(n) OVER (PARTITION BY host, template, segs[level + 1])
        >= {MIN_PAGES} THEN segs[level + 1] ELSE '*' END) FROM g WHERE len(segs) > level),
made AS (SELECT host, path, template, seen, good FROM g WHERE level = len(segs)),
leaves AS (SELECT host, template, CAST(sum(seen) AS DOUBLE) AS seen, CAST(sum(good) AS DOUBLE) AS good FROM made GROUP BY ALL),
m(level, host, template, seen, good, merged) AS (
    SELECT (SELECT max(len(template)) FROM leaves), host, template, seen, good, template FROM leaves
    UNION ALL
    SELECT level - 1, host, template, seen, good, CASE WHEN len(merged) >= level AND least_ <> most_ AND CASE
        WHEN ps = 0 OR bs = 0 OR pg = 0 OR pg = ps THEN TRUE
        ELSE abs((bg - bs * (pg / ps)) / sqrt(bs * (pg / ps) * (1 - pg / ps))) <= {MERGE_Z} END THEN pool ELSE merged END
    FROM (SELECT *, sum(seen) OVER b AS bs, sum(good) OVER b AS bg, sum(seen) OVER p AS ps, sum(good) OVER p AS pg,
        min(merged) OVER p AS least_, max(merged) OVER p AS most_
        FROM (SELECT *, CASE WHEN len(merged) >= level THEN list_concat(list_append(merged[1:level - 1], '*'), merged[level + 1:]) END AS pool
            FROM m WHERE level > 0)
        WINDOW b AS (PARTITION BY host, merged), p AS (PARTITION BY host, pool))),
m0 AS (SELECT host, template, seen, good, merged FROM m WHERE level = 0)"""
    )
    rule = reduce(
        lambda rest, r: f"CASE WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') "
        f"THEN '{r[0]}{r[1]}' ELSE {rest} END",
        sorted(RULES, key=lambda r: len(r[0] + r[1])),
        "NULL",
    )
    said = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    return f"""WITH RECURSIVE {",".join(ctes)},
groups_ AS (SELECT host, merged, sum(seen) AS seen, sum(good) AS good FROM m0 GROUP BY ALL),
prior AS (SELECT CASE WHEN sum(seen) > 0 THEN CAST(sum(good) AS DOUBLE) / CAST(sum(seen) AS DOUBLE) ELSE 1.0 END AS prior FROM leaves),
pure AS (SELECT host, merged, (good + {STRENGTH} * prior) / (seen + {STRENGTH}) AS purity FROM groups_, prior),
judged AS (SELECT r.page_id, r.host, r.path, {rule.replace("host", "r.host").replace("path", "r.path")} AS rule,
    '/' || array_to_string(m.merged, '/') AS template, purity
    FROM rows_ r JOIN made g ON r.host = g.host AND r.path = g.path
    JOIN m0 m ON g.host = m.host AND g.template = m.template JOIN pure u ON u.host = m.host AND u.merged = m.merged)
SELECT page_id, host, path, rule,
    CASE rule {said} ELSE CASE WHEN purity < {MIN_PURITY} THEN 'block' ELSE 'allow' END END AS verdict,
    template, round(purity, 6) AS purity FROM judged"""


ORACLE = _oracle()
