"""Ordered per-key running values that survive a key holding most of the rows.

A window partitioned by key sorts each key in one task. That is the right plan
for ordinary keys; a key with more than ``heavy_rows`` rows is instead cut into
cells that follow each other in the order (day, then timestamp, then block of
tie-break ids). Rows are numbered inside their cell, and the cell totals, which
are aggregated before they are shuffled, supply what came before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TIE_BLOCK = 1 << 20


def purchase_sequence(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    value: str,
    heavy_rows: int = 2_000_000,
) -> DataFrame:
    """Add ORDER_SEQUENCE, RUNNING_TOTAL, AVG_ORDER_VALUE, DAYS_SINCE_PREV_ORDER
    and TOTAL_CUSTOMER_ORDERS per ``key``, ordered by (``ts``, ``tie``)."""
    # At most rows / heavy_rows keys pass this filter, which bounds the broadcast.
    heavy = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > heavy_rows)
        .select(F.col(key).alias("_heavy_key"))
    )
    match = F.col(key).eqNullSafe(F.col("_heavy_key"))
    light_part = df.join(F.broadcast(heavy), match, "left_anti")
    heavy_part = df.join(F.broadcast(heavy), match, "left_semi")
    return _by_window(light_part, key, ts, tie, value).unionByName(
        _by_cells(heavy_part, key, ts, tie, value)
    )


def _with_results(df: DataFrame, base: list[str], seq, running, avg, gap, total) -> DataFrame:
    return df.select(
        *base,
        seq.cast("bigint").alias("ORDER_SEQUENCE"),
        running.alias("RUNNING_TOTAL"),
        avg.alias("AVG_ORDER_VALUE"),
        gap.alias("DAYS_SINCE_PREV_ORDER"),
        total.cast("bigint").alias("TOTAL_CUSTOMER_ORDERS"),
    )


def _by_window(df: DataFrame, key: str, ts: str, tie: str, value: str) -> DataFrame:
    ordered = W.partitionBy(key).orderBy(ts, tie)
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Whole-key values over the same ordering need no second sort.
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return _with_results(
        df,
        df.columns,
        F.row_number().over(ordered),
        F.sum(value).over(so_far).cast("decimal(38,2)"),
        _average(F.sum(value).over(whole), F.count(value).over(whole)),
        F.datediff(F.col(ts).cast("date"), F.lag(F.col(ts)).over(ordered).cast("date")),
        F.count(tie).over(whole),
    )


def _average(total: Column, n: Column) -> Column:
    return F.round(total.cast("decimal(38,2)") / F.nullif(n, F.lit(0)), 6)


def _by_cells(df: DataFrame, key: str, ts: str, tie: str, value: str) -> DataFrame:
    base = df.columns
    levels = ["_day", "_ts", "_block"]
    rows = df.withColumns({
        "_key": F.col(key),
        "_day": F.col(ts).cast("date"),
        "_ts": F.col(ts),
        "_block": F.floor(F.col(tie) / TIE_BLOCK),
    })

    # Totals per cell, then per timestamp, per day and per key, each from the finer one.
    measures = {"_n": F.count(F.lit(1)), "_ids": F.count(tie), "_v": F.sum(value), "_nv": F.count(value)}
    totals = {3: rows.groupBy("_key", *levels).agg(*[m.alias(n) for n, m in measures.items()])}
    for depth in (2, 1, 0):
        totals[depth] = totals[depth + 1].groupBy("_key", *levels[:depth]).agg(
            *[F.sum(n).alias(n) for n in measures]
        )

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    # What precedes each cell: within its parent, plus what precedes the parent.
    offsets = None
    for depth in (1, 2, 3):
        parent, own = ["_key", *levels[: depth - 1]], levels[depth - 1]
        earlier = W.partitionBy(*parent).orderBy(own)
        upto = earlier.rowsBetween(W.unboundedPreceding, -1)
        step = totals[depth].select(
            *parent,
            own,
            before("_n", upto).alias("_n0"),
            before("_v", upto).alias("_v0"),
            before("_nv", upto).alias("_nv0"),
            (F.lag("_day").over(earlier) if depth == 1 else F.lit(None).cast("date")).alias("_last_day"),
        )
        if offsets is None:
            offsets = step.withColumn("_in_day0", F.lit(0))
        else:
            outer = offsets.select(
                *parent,
                *[F.col(c).alias(f"_o{c}") for c in ("_n0", "_v0", "_nv0", "_in_day0", "_last_day")],
            )
            same = reduce(lambda a, b: a & b, [step[c].eqNullSafe(outer[c]) for c in parent])
            offsets = step.join(outer, same).select(
                *[step[c] for c in parent],
                own,
                (F.col("_n0") + F.col("_o_n0")).alias("_n0"),
                (F.col("_v0") + F.col("_o_v0")).alias("_v0"),
                (F.col("_nv0") + F.col("_o_nv0")).alias("_nv0"),
                (F.col("_n0") + F.col("_o_in_day0")).alias("_in_day0"),
                F.col("_o_last_day").alias("_last_day"),
            )

    cell = W.partitionBy("_key", *levels).orderBy(tie)
    run = cell.rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = rows.withColumns({
        "_rn": F.row_number().over(cell),
        "_run": F.sum(value).over(run),
        "_nrun": F.count(value).over(run),
    })
    cells = ["_key", *levels]
    offs = offsets.select(*[F.col(c).alias(f"_c{c}") for c in cells], "_n0", "_v0", "_nv0", "_in_day0", "_last_day")
    whole = totals[0].select(
        F.col("_key").alias("_w_key"), F.col("_ids").alias("_w_ids"), F.col("_v").alias("_w_v"), F.col("_nv").alias("_w_nv")
    )
    same_cell = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in cells])
    joined = numbered.join(offs, same_cell).join(
        F.broadcast(whole), F.col("_key").eqNullSafe(F.col("_w_key"))  # one row per heavy key
    )
    running = F.when(
        F.col("_nv0") + F.col("_nrun") > 0,
        F.coalesce(F.col("_v0"), F.lit(0)) + F.coalesce(F.col("_run"), F.lit(0)),
    )
    gap = F.when(F.col("_in_day0") + F.col("_rn") > 1, F.lit(0)).otherwise(
        F.datediff(F.col("_day"), F.col("_last_day"))
    )
    return _with_results(
        joined,
        base,
        F.col("_n0") + F.col("_rn"),
        running.cast("decimal(38,2)"),
        _average(F.col("_w_v"), F.col("_w_nv")),
        gap,
        F.col("_w_ids"),
    )
