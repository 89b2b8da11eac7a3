"""Token ids in binary blocks with Elias-Fano coded document boundaries.

A written corpus is a folder of Parquet rows, one per block. A block holds the
ids of successive documents in one byte string, each document closed by
``END_ID``, and the places where documents end as an Elias-Fano code: the lower
bits of each end stand side by side, the upper bits are gaps in a bit string, of
which every ``SAMPLE``-th one's position is noted. ``EliasFano.select`` finds an
end from the nearest note, so no table of offsets is stored. Blocks are numbered
inside shards (ranges of document ids); the ids before a block follow from the
sizes of the blocks and shards before it.

Ids come from the tokenizers library. A text is cut where the tokenizer's own cutting
rule always cuts too: before a single space between two other characters, around a
single line feed, and between a letter and the marks that end its word. So the ids of a
text are those of its pieces in turn; each different piece of a slice is encoded
once, and a worker keeps those it met last. Pieces of one space and letters are encoded
JOINED at a time, as a text that is cut before each of them; only their first ids begin
with a space.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator, Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import Recent, in_arrow, text_slices

END_ID = 0
BLOCK_IDS = 1 << 20
SAMPLE = 64
RECENT_PIECES = 200_000  # of a generation of a worker's table of pieces
JOINED = 100  # pieces encoded as one text

_CUT = re.compile(r"(?<=\S)(?= \S)")
_BLANK = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SEPARATOR = "\x1f"
_UNEVEN = rf"{_BLANK}[ \n]|[ \n]{_BLANK}|^ | $|\A | \z|{_SEPARATOR}"
# Marks but the apostrophe, which may begin a piece with letters, and those of special tokens.
_MARKED = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])([!-&(-/:;=?@\[-`{}~]+)([ \n]|$)"


class EliasFano:
    """A rising sequence of integers from 0 to ``universe`` in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, int(np.log2(max(universe, 1) / max(n, 1)))) if n else 0
        values = values.astype(np.int64)
        shifts = np.arange(low_bits)
        low = np.packbits((values[:, None] >> shifts & 1).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        span = self.low[first // 8 : (first + self.low_bits + 7) // 8]
        return int.from_bytes(span, "little") >> first % 8 & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the note before it and a scan over at most SAMPLE ones."""
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left = i % SAMPLE
        byte, value = at // 8, self.high[at // 8] & (0xFF << at % 8)
        while (ones := value.bit_count()) <= left:
            left -= ones
            byte += 1
            value = self.high[byte]
        for _ in range(left):
            value &= value - 1
        at = byte * 8 + (value & -value).bit_length() - 1
        return (at - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values in turn."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        upper = np.flatnonzero(bits) - np.arange(self.n)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
        lower = low.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return upper << self.low_bits | lower


class Pieces:
    """A tokenizer with a table of the pieces it encoded last, each with its ids' bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.recent = Recent(RECENT_PIECES)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a space
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _coded(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each of some different pieces."""
        words = [p for p in pieces if p[:1] == " " and p[1:].isalpha()]
        coded, size = {}, self.width.itemsize
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for group, ids in zip(groups, self._ids(["".join(g) for g in groups])):
            starts = (np.flatnonzero(self.spaced[np.frombuffer(ids, self.width)]) * size).tolist()
            if len(starts) == len(group):
                coded.update(zip(group, [ids[i:j] for i, j in zip(starts, [*starts[1:], len(ids)])]))
        others = [p for p in pieces if p not in coded]
        coded.update(zip(others, self._ids(others)))
        return coded

    def _runs(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of different pieces."""
        held = self.recent.many(pieces)
        new = [i for i, ids in enumerate(held) if ids is None]
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            coded = self._coded([pieces[i] for i in some])
            for i in some:
                held[i] = coded[pieces[i]]
            self.recent.put_all(coded)
        size = np.fromiter(map(len, held), np.int64, len(held)) // self.width.itemsize
        return np.frombuffer(b"".join(held), self.width), np.cumsum(size) - size, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with END_ID after each, number of ids of each). Null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(odd), "", texts)
        even = pc.replace_substring_regex(even, _MARKED, rf"\1{_SEPARATOR}\2\3")
        even = pc.replace_substring(even, "\n", f"{_SEPARATOR}\n{_SEPARATOR}")
        cut = pc.split_pattern(pc.replace_substring(even, " ", f"{_SEPARATOR} "), _SEPARATOR)
        spans = np.diff(cut.offsets.to_numpy())
        coded = cut.values.dictionary_encode()
        # By numpy, which makes strings several times faster than to_pylist.
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy().astype(np.int64)
        rows = np.flatnonzero(odd).tolist()
        if rows:
            # Texts with other blanks beside a space are cut before single spaces only.
            number = {p: i for i, p in enumerate(pieces)}
            parts = np.split(codes, np.cumsum(spans)[:-1])
            for i in rows:
                found = _CUT.split(texts[i].as_py())
                parts[i] = np.array([number.setdefault(p, len(number)) for p in found], dtype=np.int64)
                spans[i] = len(found)
            pieces, codes = list(number), np.concatenate(parts)
        ids, start, size = self._runs(pieces)
        ends = np.concatenate([[0], np.cumsum(size[codes])])
        counts = np.diff(ends[np.concatenate([[0], np.cumsum(spans)])])
        out = np.full(int(ends[-1]) + len(texts), END_ID, dtype=self.width)
        mine = np.ones(len(out), dtype=bool)
        mine[np.cumsum(counts + 1) - 1] = False
        out[mine] = _gather(ids, start[codes], size[codes])
        return out, counts + 1


def _gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` one after another."""
    before = np.cumsum(size) - size
    return ids[np.arange(size.sum()) + np.repeat(start - before, size)]


def worker_pieces(path: str) -> Pieces:
    """The worker's own table for a tokenizer, kept from task to task."""
    home = sys.modules.setdefault("_token_piece_tables", ModuleType("_token_piece_tables")).__dict__
    if path not in home:
        home[path] = Pieces(path)
    return home[path]


_BLOCK = pa.schema(
    [
        ("shard", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()),
        ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()),
        ("high", pa.binary()), ("samples", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "shard bigint, block bigint, doc_ids array<bigint>, n_ids bigint, width int, ids binary, low_bits int, "
    "low binary, high binary, samples binary"
)


def pack(shard: int, number: int, doc_ids: list, counts: list[int], ids: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(counts)
    ef = EliasFano.of(ends, int(ends[-1]))
    row = [shard, number, doc_ids, int(ends[-1]), ids.dtype.itemsize, ids.tobytes(), ef.low_bits, ef.low, ef.high, ef.samples]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCK.types)], schema=_BLOCK)


def unpack(row: dict) -> tuple[list, np.ndarray, EliasFano]:
    """(document ids, token ids, ends) of a block."""
    ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}")
    return row["doc_ids"], ids, EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"])


def encode_blocks(
    docs: DataFrame, tokenizer: str, block_ids: int = BLOCK_IDS, order: Sequence[str | Column] = ("doc_id",)
) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text) in ascending order, by doc_id unless told otherwise."""
    text = F.col("text").cast("string").alias("text")
    places = [(F.col(c) if isinstance(c, str) else c).alias(f"place{i}") for i, c in enumerate(order)]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *places)
    names = [f"place{i}" for i in range(len(places))]
    # The start of the text keeps rows of one place from being one range.
    ordered = source.repartitionByRange(*names, F.substring("text", 1, 64)).sortWithinPartitions(*names, "text")
    ordered = ordered.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, shard, number = worker_pieces(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        for batch in text_slices(batches):
            ids, n = pieces.encode(batch.column("text"))
            names, at = batch.column("doc_id").to_pylist(), 0
            ends = np.cumsum(n)
            while at < len(names):
                room = block_ids - sum(map(len, held))
                base = int(ends[at - 1]) if at else 0
                upto = max(int(np.searchsorted(ends, base + room, "right")), at if held else at + 1)
                doc_ids += names[at:upto]
                counts += n[at:upto].tolist()
                if upto > at:
                    held.append(ids[base : int(ends[upto - 1])])
                if upto < len(names):
                    yield pack(shard, number, doc_ids, counts, np.concatenate(held))
                    number, doc_ids, counts, held = number + 1, [], [], []
                at = upto
        if doc_ids:
            yield pack(shard, number, doc_ids, counts, np.concatenate(held))

    return in_arrow(ordered, run, _BLOCK_DDL)


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS, order: Sequence[str | Column] = ("doc_id",)
) -> None:
    """Write the ids of every text in the given order. A null text is empty (only the
    end id), a null id comes first, rows that share a place follow one another in
    order of text."""
    encode_blocks(docs, tokenizer, block_ids, order).write.option("compression", "zstd").parquet(path)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, before): the ids of all blocks before a block. Only the shard
    totals, one row per range of document ids, meet in one task."""
    sizes = spark.read.parquet(path).select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base"))
    inside = F.sum("n_ids").over(W.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(bases, "shard").select(
        "shard", "block", (F.col("base") + F.col("inside")).alias("before")
    )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every written document, read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, ids, ef = unpack(row)
                ends = ef.values()
                starts = np.concatenate([[0], ends[:-1]])
                wide = ids.astype("<u4")
                sums = [zlib.crc32(wide[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int64()), pa.array([row["block"]] * n, pa.int64()),
                     pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(sums, pa.int64())],
                    names=["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    rows = in_arrow(spark.read.parquet(path), run, "shard bigint, block bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    joined = rows.join(block_starts(spark, path), ["shard", "block"])
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """The ids of one document, end id included, found through ``select``."""
    held = spark.read.parquet(path).filter(F.array_contains("doc_ids", F.lit(doc_id))).first()
    if held is None:
        return []
    doc_ids, ids, ef = unpack(held.asDict())
    i = doc_ids.index(doc_id)
    return ids[ef.select(i - 1) if i else 0 : ef.select(i)].tolist()
