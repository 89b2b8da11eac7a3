"""Order history and daily metrics from keyed state.

The state of an order is its current version and the commits that are not yet older
than the watermark; the orders of ``1 << BLOCK_BITS`` neighbouring ids share one entry of
the state store, since an entry costs more to visit than an order to bring up to date. A commit that arrives is put in its place among these, late or
not, and what the order's versions are now is compared with what they were before:
versions that are no longer so go out with -1, new ones with +1. A commit that is
known already changes nothing. So a batch reads its own images and the state of their
orders, never the log, and the signed versions add up to the same history in
whatever order and however often commits arrive within the delay.

State lies in RocksDB, on the disks of the executors, whose memory it does not fill however
many orders there are; entries are compressed, and those that pass between Spark and
Python at once are bounded by their size.

History is the versions whose signs add up to one. Daily metrics are kept as cells per
day, region, channel and customer to which the signed current versions are added;
only the months that a batch touches are written again.
"""

from __future__ import annotations

import base64
import json
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orelake.operators.history import COMMIT, COMMITTED_AT, as_ntz
from orelake.plans.metrics import DAILY_KEYS, HISTORY_COLUMNS, order_images
from orelake.sources.versions import read_parts, replace_parts
from orelake.streaming.jobs import run_available, write_batch
from orelake.vocab import OPEN_ENDED

KEY = "ORDER_ID"
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
CELL_KEYS = [*DAILY_KEYS, "CUSTOMER_ID"]
MONTH = "month_part"
BLOCK, BLOCK_BITS = "_block", 10
FILL = 64 << 10  # characters of an entry that count as a row where output is cut into batches
STORE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STORE}.rocksdb.maxMemoryUsageMB": "256",  # of all stores of an executor
    # Rows, and so entries, that a task sends to Python at once: those of a full entry.
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(1 << BLOCK_BITS),
}

Commit = tuple[int, int, bool, bool, str]  # number, time (micros), inserts, updates, image
Version = tuple[str, int, int | None, str]  # image, from, to, kind


@dataclass
class Order:
    """``image`` stands since ``since`` as ``kind``, or none is live; commits up to
    ``folded`` are part of that, ``pending`` ones are not."""

    folded: int | None = None
    live: bool = False
    current: Version | None = None
    pending: list[Commit] = field(default_factory=list)

    def versions(self) -> list[Version]:
        """The current version and all that the pending commits make of it."""
        return _applied(self.live, self.current, self.pending)[2]

    def fold(self, before: int) -> None:
        """Make the commits made before a time part of the order's past."""
        old = [c for c in self.pending if c[1] < before]
        if old:
            self.live, self.current, _ = _applied(self.live, self.current, old)
            self.folded = old[-1][0]
            self.pending = self.pending[len(old) :]

    def add(self, commits: list[Commit]) -> list[Commit]:
        """Take in commits, each once; those that came too late are returned."""
        known = {c[0] for c in self.pending}
        late = []
        for c in commits:
            if self.folded is not None and c[0] <= self.folded:
                late.append(c)
            elif c[0] not in known:
                known.add(c[0])
                self.pending.append(c)
        self.pending.sort()
        return late

    def parts(self) -> list:
        return [self.folded, self.live, self.current, self.pending]

    @classmethod
    def of(cls, parts: list) -> Order:
        folded, live, current, pending = parts
        return cls(folded, live, tuple(current) if current else None, [tuple(c) for c in pending])

    def packed(self) -> str:
        return json.dumps(self.parts())

    @classmethod
    def unpacked(cls, text: str) -> Order:
        return cls.of(json.loads(text))


def entry_text(orders: dict[str, list]) -> str:
    """The parts of orders by number as the text of a state entry, compressed."""
    plain = json.dumps(orders, separators=(",", ":")).encode()
    return f"{len(plain)}:{base64.b64encode(pa.compress(plain, 'zstd', asbytes=True)).decode()}"


def entry_orders(text: str) -> dict[str, list]:
    if text.startswith("{"):  # of a checkpoint made before entries were compressed
        return {number: json.loads(packed) for number, packed in json.loads(text).items()}
    size, packed = text.split(":")
    return json.loads(pa.decompress(base64.b64decode(packed), int(size), "zstd", asbytes=True))


def _applied(live: bool, current: Version | None, commits: list[Commit]) -> tuple[bool, Version | None, list[Version]]:
    """(live, current version, all versions from the current one on) after commits. A key
    is live after any insertion; an insertion takes effect unless it finds a live key
    and does not update it, or leaves it as it is; a deletion if it finds one."""
    out = []
    for _, at, inserts, updates, image in commits:
        if inserts and (not live or updates):
            if not (live and current and current[0] == image):
                if current:
                    out.append((current[0], current[1], at, current[3]))
                current = (image, at, None, "UPDATE" if updates else "INSERT")
        elif not inserts and live and current:
            out.append((current[0], current[1], at, "DELETE"))
            current = None
        live = inserts
    return live, current, [*out, *([current] if current else [])]


def _without(some: list[Version], others: list[Version]) -> list[Version]:
    """``some`` less ``others``, each as often as it is there."""
    if not others or some == others:
        return [] if others else some
    return list((Counter(some) - Counter(others)).elements())


def step(order: Order, commits: list[Commit], watermark: int) -> list[tuple[int, Version]]:
    """Signed versions that lead from an order's versions to those with more commits;
    a commit that came too late goes out with sign 0. The watermark is in micros."""
    old = order.versions()
    late = order.add(commits)
    new = order.versions()
    found = [(-1, v) for v in _without(old, new)] + [(1, v) for v in _without(new, old)]
    order.fold(watermark)
    return found + [(0, (image, at, None, "INSERT" if inserts else "DELETE")) for _, at, inserts, _, image in late]


_OUT = T.StructType([
    T.StructField(KEY, T.LongType()), T.StructField("SIGN", T.IntegerType()), T.StructField("image", T.StringType()),
    T.StructField("since", T.LongType()), T.StructField("until", T.LongType()), T.StructField("DML_TYPE", T.StringType()),
])


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = entry_orders(state.get[0]) if state.exists else {}
    arrived: dict[int, list[Commit]] = {}
    for pdf in frames:
        for order, *commit in zip(*[pdf[c].tolist() for c in (KEY, COMMIT, "at", "inserts", "updates", "image")]):
            arrived.setdefault(order, []).append(tuple(commit))
    watermark, rows = state.getCurrentWatermarkMs() * 1000, []
    for number, commits in arrived.items():
        known = held.get(str(number))
        order = Order.of(known) if known else Order()
        rows += [(number, sign, *v) for sign, v in step(order, commits, watermark)]
        held[str(number)] = order.parts()
    text = entry_text(held)
    state.update((text,))
    # Spark cuts output and entries into batches by rows of output alone: without a row of
    # its own an entry would be held until the task ends.
    rows += [(0, None, "", 0, None, "")] * (len(text) // FILL + 1 - len(rows))
    yield pd.DataFrame(rows, columns=_OUT.names).astype({"SIGN": "Int32", "until": "Int64"})


def signed_versions(changes: DataFrame, delay: str) -> DataFrame:
    """A stream of signed versions from a stream of order changes with ``_commit`` and
    ``_committed_at``; commits of an order may be out of order by ``delay``."""
    images = order_images(changes).select(*HISTORY_COLUMNS, "_action", "_is_update", COMMIT, COMMITTED_AT)
    inserts, updates = F.col("_action") == "INSERT", F.coalesce("_is_update", F.lit(False))
    # An update's deletion says nothing that its insertion does not.
    net = images.filter(inserts | ~updates).select(
        F.col(KEY).cast("long").alias(KEY), F.col(COMMIT).cast("long").alias(COMMIT),
        F.unix_micros(F.col(COMMITTED_AT).cast("timestamp")).alias("at"), inserts.alias("inserts"), updates.alias("updates"),
        F.to_json(F.struct(*HISTORY_COLUMNS), JSON_TIMES).alias("image"),
        F.col(COMMITTED_AT).cast("timestamp").alias("event_time"), F.shiftright(F.col(KEY).cast("long"), BLOCK_BITS).alias(BLOCK),
    )
    return (
        net.withWatermark("event_time", delay)
        .groupBy(BLOCK)
        .applyInPandasWithState(_update, _OUT, "packed string", "append", GroupStateTimeout.NoTimeout)
        .filter(F.col("SIGN").isNotNull())
    )


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """SETTINGS in force; a checkpoint made with another kind of store goes on with that."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _restored(rows: DataFrame, like: T.StructType) -> DataFrame:
    """Signed versions with the image's columns instead of its text."""
    kept = T.StructType([f for f in like.fields if f.name in HISTORY_COLUMNS])

    def moment(c: str):
        return F.timestamp_micros(c).cast("timestamp_ntz")

    return rows.withColumn("i", F.from_json("image", kept, JSON_TIMES)).select(
        "SIGN", "i.*", moment("since").alias("EFFECTIVE_FROM"),
        F.coalesce(moment("until"), as_ntz(OPEN_ENDED)).alias("EFFECTIVE_TO"),
        F.col("until").isNull().alias("IS_CURRENT"), "DML_TYPE",
    )


def daily_cells(versions: DataFrame) -> DataFrame:
    """Signed current versions as cells: orders, and sum and number of known amounts."""
    sign = F.col("SIGN").cast("long")
    current = versions.filter(F.col("IS_CURRENT") & (F.col("SIGN") != 0))
    return current.withColumn("METRIC_DATE", F.col("ORDER_DATE").cast("date")).groupBy(*CELL_KEYS).agg(
        F.sum(sign).alias("ORDERS"),
        F.coalesce(F.sum(F.col("NET_AMOUNT") * F.col("SIGN")), F.lit(0)).cast("decimal(38,2)").alias("NET"),
        F.coalesce(F.sum(F.when(F.col("NET_AMOUNT").isNotNull(), sign)), F.lit(0)).alias("NET_N"),
    )


def _merged(cells: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(t).alias(c) for c, t in (("ORDERS", "long"), ("NET", "decimal(38,2)"), ("NET_N", "long"))]
    return cells.groupBy(*CELL_KEYS).agg(*sums).filter(F.col("ORDERS") != 0)


_CELLS = "METRIC_DATE date, REGION string, CHANNEL string, CUSTOMER_ID long, ORDERS long, NET decimal(38,2), NET_N long, month_part string"


def _month(column: str = "METRIC_DATE"):
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none")).alias(MONTH)


def order_state_stream(source: DataFrame, out: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Keep order history and daily metrics below ``out`` up to date with a stream of
    order changes; run again with the same checkpoint to go on."""
    spark = source.sparkSession
    like = order_images(source).schema
    none = spark.createDataFrame([], _CELLS)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written once: the state is read and changed by this write alone.
        write_batch(_restored(batch, like), f"{out}/versions", batch_id)
        versions = spark.read.parquet(f"{out}/versions/batch_id={batch_id}")
        delta = daily_cells(versions)
        months = {r[0] for r in delta.select(_month()).distinct().collect()}
        held = read_parts(spark, f"{out}/cells", none, MONTH, months, before=batch_id)
        rows = _merged(held.drop(MONTH).unionByName(delta)).withColumn(MONTH, _month())
        replace_parts(rows, f"{out}/cells", MONTH, months, batch_id)

    with settings(spark):
        return run_available(signed_versions(source, delay), write, checkpoint)


def read_history(spark: SparkSession, out: str) -> DataFrame:
    """The versions as they stand."""
    rows = spark.read.parquet(f"{out}/versions").drop("batch_id").filter("SIGN != 0")
    columns = [c for c in rows.columns if c != "SIGN"]
    return rows.groupBy(*columns).agg(F.sum("SIGN").alias("SIGN")).filter("SIGN > 0").drop("SIGN")


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """Changes that came after the delay and were not applied, repetitions included."""
    return spark.read.parquet(f"{out}/versions").drop("batch_id").filter("SIGN = 0").drop("SIGN")


def read_daily_state(spark: SparkSession, out: str) -> DataFrame:
    """``daily_order_metrics`` of the history, from the cells alone."""
    cells = read_parts(spark, f"{out}/cells", spark.createDataFrame([], _CELLS), MONTH)
    return cells.groupBy(*DAILY_KEYS).agg(
        F.sum("ORDERS").alias("ORDER_COUNT"),
        F.when(F.sum("NET_N") > 0, F.sum("NET")).cast("decimal(24,2)").alias("TOTAL_REVENUE"),
        F.round(F.sum("NET").cast("decimal(38,2)") / F.nullif(F.sum("NET_N"), F.lit(0)), 2).cast("decimal(14,2)").alias("AVG_ORDER_VALUE"),
        F.count("CUSTOMER_ID").alias("NEW_CUSTOMERS"),
    )
