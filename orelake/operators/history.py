"""Change feeds, slowly changing dimensions (type 2) and keyed upserts.

A change feed is a DataFrame of row images with two extra columns: ``_action``
('INSERT' or 'DELETE') and ``_is_update``. An update is a DELETE image of the
old row plus an INSERT image of the new one, both with ``_is_update`` set. A feed
that holds several commits numbers them in a column ``_commit``; without it, all
images belong to one commit, which changes a key at most once. ``_committed_at``
may tell when a commit was made.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.operators.ranking import sequence_ids
from orelake.vocab import OPEN_ENDED

CHANGE_COLUMNS = ["_action", "_is_update"]
COMMIT, COMMITTED_AT = "_commit", "_committed_at"
VERSION_COLUMNS = ["EFFECTIVE_FROM", "EFFECTIVE_TO", "IS_CURRENT", "DML_TYPE"]


def as_ntz(moment: datetime | str | Column) -> Column:
    return (moment if isinstance(moment, Column) else F.lit(moment)).cast("timestamp_ntz")


def keys_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> Column:
    pairs = [(left[k], right[k]) for k in keys]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])


def table_changes(old: DataFrame, new: DataFrame, key: str, initial_rows: bool = True) -> DataFrame:
    """Change feed leading from ``old`` to ``new``, two states of one keyed table.

    With ``initial_rows=False`` an empty ``old`` means the feed has just been
    created, and the rows already there are not replayed.
    """
    columns = new.columns

    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(name))

    before, after = image(old, "before"), image(new, "after")
    paired = before.join(after, F.col("_before_key") == F.col("_after_key"), "full_outer")
    gone, came = F.col("before").isNotNull(), F.col("after").isNotNull()
    moved = paired.filter(~F.col("before").eqNullSafe(F.col("after")))
    if not initial_rows:
        moved = moved.filter(old.select(key).limit(1).agg(F.count(F.lit(1)) > 0).scalar())
    images = F.array(
        F.when(gone, F.struct(F.col("before").alias("row"), F.lit("DELETE").alias("action"))),
        F.when(came, F.struct(F.col("after").alias("row"), F.lit("INSERT").alias("action"))),
    )
    return (
        moved.select(F.explode(F.filter(images, lambda i: i.isNotNull())).alias("c"), (gone & came).alias("_is_update"))
        .select("c.row.*", F.col("c.action").alias("_action"), "_is_update")
    )


def apply_changes(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table state a change feed leads to."""
    kept = old.join(changes.select(key).distinct(), key, "left_anti")
    return kept.unionByName(changes.filter(F.col("_action") == "INSERT").drop(*CHANGE_COLUMNS))


def collapse_changes(changes: DataFrame, key: str, by_commit: bool = False) -> DataFrame:
    """The net change of each key over all commits in ``changes``, or of each key and
    commit with ``by_commit``.

    A commit changes a key at most once, so the image an update deletes says nothing
    that the one it inserts does not, and the other images are the net change of
    their commit as they stand: nothing is shuffled. Over several commits a key whose
    first image deletes or updates it was there before, one whose last image inserts
    is there after: there both times is an update, after only an insertion, before
    only a deletion, and neither is no change at all.
    """
    about = [c for c in (COMMIT, COMMITTED_AT) if c in changes.columns] if by_commit else []
    columns = [c for c in changes.columns if c not in (key, *CHANGE_COLUMNS, COMMIT, COMMITTED_AT)]
    updates = F.coalesce("_is_update", F.lit(False))
    stays = F.col("_action") == "INSERT"
    net = changes.filter(stays | ~updates)
    if by_commit or COMMIT not in changes.columns:
        return net.select(key, *columns, "_action", (stays & updates).alias("_is_update"), *about)
    order = W.partitionBy(key).orderBy(COMMIT)
    ends = net.withColumns({"_was": F.first(~stays | updates).over(order), "_next": F.lead(COMMIT).over(order)})
    last = ends.filter(F.col("_next").isNull() & (stays | F.col("_was")))
    return last.select(key, *columns, "_action", (stays & F.col("_was")).alias("_is_update"))


def scd2_apply(
    history: DataFrame,
    changes: DataFrame,
    key: str,
    as_of: datetime | str | Column,
    surrogate: str = "SURROGATE_KEY",
) -> DataFrame:
    """History after one batch of changes.

    Deleted keys are closed and marked; updated keys are closed and get a new
    current version; new keys get their first version. A change that leaves
    the current version as it is does nothing, so replaying a batch is safe. Several
    changes of a key in the batch act as their net change.
    Closed versions never enter a join: only current rows meet the batch, once.
    """
    payload = [c for c in history.columns if c not in (surrogate, *VERSION_COLUMNS)]
    closed = history.filter(~F.col("IS_CURRENT"))
    current = history.filter(F.col("IS_CURRENT")).select(F.col(key).alias("_cur_key"), F.struct(*history.columns).alias("_cur"))
    when = as_ntz(as_of)
    carried = [c for c in (COMMIT, COMMITTED_AT) if c in changes.columns]
    batch = collapse_changes(changes.select(*payload, *CHANGE_COLUMNS, *carried), key).select(
        F.struct(*payload).alias("_new"), F.col(key).alias("_key"), "_action", "_is_update"
    )
    met = current.join(batch, F.col("_cur_key") == F.col("_key"), "full_outer")

    standing = F.struct(*[F.col(f"_cur.{c}").alias(c) for c in payload])
    is_new, is_gone = F.col("_cur").isNull(), F.col("_action") == "DELETE"
    deleted = F.coalesce(is_gone, F.lit(False))
    replaced = F.coalesce(~is_gone & F.col("_is_update"), F.lit(False)) & ~standing.eqNullSafe(F.col("_new"))
    ends = deleted | replaced
    kinds = {f.name: f.dataType for f in history.schema.fields}

    def version(source: str, **stated: Column) -> Column:
        """A row of the history: payload from a struct, the other columns as stated."""
        values = {c: F.col(f"{source}.{c}") for c in payload} | stated
        return F.struct(*[values[c].cast(kinds[c]).alias(c) for c in history.columns])

    old = version(
        "_cur",
        **{surrogate: F.col(f"_cur.{surrogate}")},
        EFFECTIVE_FROM=F.col("_cur.EFFECTIVE_FROM"),
        EFFECTIVE_TO=F.when(ends, when).otherwise(F.col("_cur.EFFECTIVE_TO")),
        IS_CURRENT=~ends,
        DML_TYPE=F.when(deleted, "DELETE").otherwise(F.col("_cur.DML_TYPE")),
    )
    fresh = version(
        "_new",
        **{surrogate: F.lit(None)},
        EFFECTIVE_FROM=when,
        EFFECTIVE_TO=as_ntz(OPEN_ENDED),
        IS_CURRENT=F.lit(True),
        DML_TYPE=F.when(F.col("_is_update"), "UPDATE").otherwise("INSERT"),
    )
    pair = F.array(F.when(~is_new, old), F.when((is_new & ~deleted) | replaced, fresh))
    versions = met.select(F.explode(F.filter(pair, lambda v: v.isNotNull())).alias("v")).select("v.*")
    kept = versions.filter(F.col(surrogate).isNotNull())
    next_id = history.agg(F.coalesce(F.max(surrogate), F.lit(0)) + 1).scalar()
    added = sequence_ids(versions.filter(F.col(surrogate).isNull()).drop(surrogate), [key], surrogate, start=next_id)
    return closed.unionByName(kept).unionByName(added.select(*history.columns))


def empty_history(like: DataFrame, surrogate: str = "SURROGATE_KEY") -> DataFrame:
    """A history with no versions for rows shaped like ``like``."""
    # limit(0) is folded to an empty relation, and the joins with it disappear.
    return like.limit(0).select(
        F.lit(0).cast("bigint").alias(surrogate),
        "*",
        as_ntz(OPEN_ENDED).alias("EFFECTIVE_FROM"),
        as_ntz(OPEN_ENDED).alias("EFFECTIVE_TO"),
        F.lit(True).alias("IS_CURRENT"),
        F.lit("INSERT").alias("DML_TYPE"),
    )


def scd2_from_log(log: DataFrame, key: str) -> DataFrame:
    """The same history read from an append-only log of change images, one or more
    rows per key and commit, with ``_commit`` and ``_committed_at``.

    A key's window is as long as the number of commits that changed it. How a
    writer cut the feed into batches does not matter: what belongs to one commit is
    put together here. Writers only ever append; nothing is copied forward.
    """
    log = collapse_changes(log, key, by_commit=True)
    batch, at = COMMIT, COMMITTED_AT
    payload = [c for c in log.columns if c not in (*CHANGE_COLUMNS, batch, at)]
    order = W.partitionBy(key).orderBy(batch)
    deleted = F.col("_action") == "DELETE"

    # A key is live after any INSERT image; that decides which events take effect.
    live = F.coalesce(F.lag("_action").over(order) == "INSERT", F.lit(False))
    acting = log.withColumn("_live", live).filter(
        F.when(deleted, F.col("_live")).otherwise(~F.col("_live") | F.col("_is_update"))
    )
    same = F.struct(*payload).eqNullSafe(F.lag(F.struct(*payload)).over(order))
    effective = acting.withColumn("_same", F.col("_live") & ~deleted & same).filter(~F.col("_same"))

    ends = F.lead(at).over(order)
    ended_by = F.lead("_action").over(order)
    versions = effective.withColumns({"_to": ends, "_by": ended_by}).filter(~deleted)
    return versions.select(
        *payload,
        F.col(at).alias("EFFECTIVE_FROM"),
        F.coalesce(F.col("_to"), as_ntz(OPEN_ENDED)).alias("EFFECTIVE_TO"),
        F.col("_to").isNull().alias("IS_CURRENT"),
        F.when(F.col("_by") == "DELETE", "DELETE")
        .when(F.col("_is_update"), "UPDATE")
        .otherwise("INSERT")
        .alias("DML_TYPE"),
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: datetime | str | Column,
    stamp: str = "UPDATED_AT",
    null_safe: bool = False,
) -> DataFrame:
    """``target`` with the rows of ``source`` written over it by key.

    Rows of either kind get ``as_of`` in the ``stamp`` column. With plain
    equality a NULL key never matches: such source rows are added every time.
    """
    arriving = source.select(*keys)
    kept = target.join(arriving, keys_equal(target, arriving, keys, null_safe), "left_anti")
    return kept.unionByName(source.withColumn(stamp, as_ntz(as_of)).select(*target.columns))
