"""What the operators share: tables, shared storage, slices of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.session import scratch_dir

BROADCAST_ROWS = 200_000
SLICE_BYTES = 4 << 20  # text handled at once inside a task
BATCH_BYTES = 4 << 20  # sent to a task at once


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage."""
    path = f"{scratch_dir(df.sparkSession, 'llm')}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """``df.mapInArrow`` with batches bounded by bytes: 10,000 rows of long texts would
    not fit beside a worker. A task that ends gives its memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(task, ddl)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and what
    they hold idle adds up beside the executor's heap."""
    if not gc.get_freeze_count():
        gc.freeze()  # once: what is loaded by then stays, and need not be gone through each time
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, with the broadcast hint if it has been counted to be small."""
    return F.broadcast(df) if df.count() <= max_rows else df


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a column's decimal text, modulo ``divisor``; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor))


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(words of each text, the different words, the number of each word in turn) of
    texts lower-cased (A-Z) and cut at ASCII blanks; null is empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.values
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = lists.offsets.to_numpy()
    coded = words.filter(real).dictionary_encode()
    different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
    return before[ends[1:]] - before[ends[:-1]], different, coded.indices.to_numpy()


class Recent:
    """A table of at most ``2 * size`` values that were asked for last: a full
    generation becomes the old one, of which only what is asked for again is kept."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def many(self, keys: list) -> list:
        """The values of keys, None for those not held."""
        old = self.old.get
        found = list(map(self.young.get, keys))
        if self.old:
            again = {}
            for i, value in enumerate(found):
                if value is None and (value := old(keys[i])) is not None:
                    found[i] = again[keys[i]] = value
            self.put_all(again)
        return found

    def put_all(self, values: dict) -> None:
        if len(self.young) + len(values) <= self.size:
            self.young.update(values)
        else:
            for key, value in values.items():
                self.put(key, value)

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value
