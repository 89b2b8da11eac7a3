"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent,
normalised. The exponent is bisected until the weights reach a target entropy,
or until no source has to be repeated more than a limit times what the least
repeated one is.

The weights are realised in blocks: every row falls by a hash of its id into a block
of its source, one of ``BLOCKS`` or of as many as hold ``BLOCK_ROWS`` rows each. A source whose budget is r times its tokens
passes floor(r) times over all its blocks and once more over those that fit into
the rest, each pass in another permutation of the blocks. Without a budget, the
smallest one is taken that holds every source once, so that no row is dropped.

Sources are aggregated, never collected: each bisection round is one aggregate
over the table of source totals that evaluates four halvings at once.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import bounded, stored

BLOCKS = 1024
BLOCK_ROWS = 4096  # a block is the smallest unit of order and budget
MAX_REPEATS = 1.5
SEED = 17
_ROUNDS, _POINTS = 8, 15  # 8 rounds of 4 halvings

_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """Either a share (0 to 1) of the largest possible entropy, or a repetition limit."""

    entropy: float | None = None
    max_repeats: float | None = MAX_REPEATS


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def _source_key(source: str) -> Column:
    """The source as text; a null source is a source of its own."""
    return F.concat(F.when(F.col(source).isNull(), "-").otherwise("+"), F.coalesce(F.col(source).cast("string"), F.lit("")))


def _block(id_col: str, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED)), F.lit(blocks))


def exponent(totals: DataFrame, target: Target) -> float:
    """The exponent in 0..16 at which the weights meet the target; ``totals`` has
    a column ``total`` of positive token counts. Entropy falls as it grows, and
    so does the repetition of small sources up to 1."""
    whole = totals.agg(F.sum("total"), F.count(F.lit(1)), F.min("total"), F.max("total")).first()
    total, n, least, most = whole
    if not n or least == most:
        return 1.0
    ln = F.log(F.col("total") / F.lit(total))

    def measures(points: list[float]) -> list[float]:
        if target.entropy is None:
            return [(1 - a) * (log(most) - log(least)) for a in points]  # log of the largest repetition
        sums = [F.sum(f(F.exp(ln * a))) for a in points for f in (lambda x: x, lambda x: x * ln)]
        row = totals.agg(*sums).first()
        return [log(row[2 * i]) - a * row[2 * i + 1] / row[2 * i] for i, a in enumerate(points)]

    goal = log(target.max_repeats) if target.entropy is None else target.entropy * log(n)
    low, high = 0.0, 1.0 if target.entropy is None else 16.0
    for _ in range(_ROUNDS):  # the measure falls from low to high
        step = (high - low) / (_POINTS + 1)
        points = [low + step * (i + 1) for i in range(_POINTS)]
        above = sum(m > goal for m in measures(points))
        low, high = low + step * above, low + step * (above + 1)
    return high if target.entropy is None else (low + high) / 2


def weights(blocks: DataFrame, target: Target, budget: int | None = None) -> DataFrame:
    """(key, total, share, weight, repeats) per source with tokens."""
    totals = stored(blocks.groupBy("key").agg(F.sum("tokens").alias("total")).filter("total > 0"), "totals")
    a = exponent(totals, target)
    sums = totals.agg(F.sum("total").alias("t")).first()["t"] or 1
    raw = totals.withColumn("share", F.col("total") / F.lit(sums)).withColumn("raw", F.pow("share", F.lit(a)))
    z = raw.agg(F.sum("raw").alias("z"), F.max(F.col("total") / F.col("raw")).alias("hold")).first()
    norm = z["z"] or 1.0
    size = budget if budget is not None else (z["hold"] or 0.0) * norm
    out = raw.withColumn("weight", F.col("raw") / F.lit(norm))
    return out.select("key", "total", "share", "weight", (F.col("weight") * F.lit(float(size)) / F.col("total")).alias("repeats"))


def schedule(blocks: DataFrame, by_source: DataFrame) -> DataFrame:
    """(key, block, epoch, place): the passes in which a block is used; ``place``
    in 0..1 orders the mixture so that every stretch of it has the target weights.
    Blocks of sources without tokens are used once."""
    # A rounding error must not open a pass for nothing.
    repeats = F.round(F.coalesce("repeats", F.lit(1.0)), 9)
    passes = F.sequence(F.lit(0), F.greatest(F.ceil("r") - 1, F.lit(0)).cast("int"))
    used = blocks.join(by_source, "key", "left").withColumn("r", repeats).filter("r > 0")
    rows = used.withColumn("epoch", F.explode(passes)).withColumn("turn", F.xxhash64("key", "block", "epoch", F.lit(SEED)))
    order = W.partitionBy("key", "epoch").orderBy("turn", "block")
    rows = rows.select(
        "key", "block", "epoch", "r", "tokens", F.coalesce("total", F.lit(0)).alias("total"),
        F.row_number().over(order).alias("at"),
        F.count(F.lit(1)).over(W.partitionBy("key", "epoch")).alias("of"),
        (F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("tokens")).alias("before"),
    )
    rest = (F.col("r") - F.col("epoch")) * F.col("total")
    fits = (F.col("r") - F.col("epoch") >= 1) | (F.col("before") + F.col("tokens") / 2 <= rest)
    place = (F.col("epoch") + (F.col("at") - 0.5) / F.col("of")) / F.greatest("r", F.lit(1.0))
    return rows.filter(fits).select("key", "block", F.col("epoch").cast("long").alias("epoch"), place.alias("place"))


def mixed(
    docs: DataFrame,
    target: Target = Target(),
    budget: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with the columns epoch and place, in the stead of any of these names:
    a row for each use of a document.

    Tokens are words between ASCII blanks. Null texts have none; a null source is a
    source of its own; null ids fall into one block of their source. Repeated rows
    are used alike. A source without any tokens has no weight and is used once.
    """
    number = max(BLOCKS, docs.count() // BLOCK_ROWS)
    keyed = docs.withColumn("__llm_key", _source_key(source_col)).withColumn("__llm_block", _block(id_col, number))
    blocks = keyed.groupBy(F.col("__llm_key").alias("key"), F.col("__llm_block").alias("block"))
    blocks = stored(blocks.agg(F.sum(tokens(text_col)).alias("tokens")), "blocks")
    plan = stored(schedule(blocks, weights(blocks, target, budget)), "schedule")
    plan = plan.select(
        F.col("key").alias("__llm_key"), F.col("block").alias("__llm_block"),
        F.col("epoch").alias("__llm_epoch"), F.col("place").alias("__llm_place"),
    )
    rows = keyed.join(bounded(plan), ["__llm_key", "__llm_block"])
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("epoch", "place")]
    return rows.select(*columns, F.col("__llm_epoch").alias("epoch"), F.col("__llm_place").alias("place"))


def in_order(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A mixture sorted by ``place`` in ranges: written, its files hold it in order."""
    return rows.repartitionByRange("place", "epoch").sortWithinPartitions("place", "epoch", id_col)
