"""Line dedup by deletion neighbourhoods: of lines that are equal or differ in one
word (one put in, left out or replaced), the earliest stays.

Equal lines meet by a hash of their words. Of the different lines that are left,
each sends itself and its variants with one word deleted as hashed keys. Two lines
within the edit bound share a key, and a shared key says how: both left out the
word at the same place (one replaced), or one of them is the key as it stands (one
more). So per key and place only the earliest line has to be known, and every
line is compared with that one alone: a template with millions of fillings
takes as many rows, not their square. Each pair found is verified word by word.

Only lines that can have a partner send variants: one edit leaves the first or the
last half of a line untouched, so a line none of whose halves occurs in another
line is passed over. This loses nothing and spares nearly all variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import as_bytes, in_arrow, stored, text_slices

MIN_WORDS = 8  # of lines that may differ in a word; shorter ones must be equal
BROADCAST_NUMBERS = 500_000  # rows and line numbers, about 12 MB
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _words(line: str) -> Column:
    return F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _halves() -> Column:
    """Hashes of the first and last h words, for each h that a partner may share."""
    keys = []
    for h in (F.floor(F.col("n") / 2), F.floor((F.col("n") - 1) / 2)):
        h = h.cast("int")
        keys.append(F.xxhash64(F.lit("head"), h, F.slice("words", F.lit(1), h)))
        keys.append(F.xxhash64(F.lit("tail"), h, F.slice("words", F.col("n") - h + 1, h)))
    return F.when(F.col("n") >= MIN_WORDS, F.array_distinct(F.array(*keys)))


def variants(words: list[bytes]) -> np.ndarray:
    """Keys of a line: its own first, then without each of its words in turn."""
    n = len(words)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=_U)
    powers = np.cumprod(np.full(n, _BASE, dtype=_U), dtype=_U)
    before = np.concatenate([np.zeros(1, _U), np.cumsum(hashes * powers, dtype=_U)])
    out = np.empty(n + 1, dtype=_U)
    out[0] = before[n]
    out[1:] = before[:-1] + (before[n] - before[1:]) * _U(_INVERSE)
    sizes = np.full(n + 1, n - 1, dtype=_U)
    sizes[0] = n
    return (out ^ (out >> _U(29)) ^ sizes * _U(0xD6E8FEB86659FD93)).view(np.int64)


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether two word lists are equal or one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    return longer[head + 1 :] == shorter[head + (len(a) == len(b)) :]


def _emitted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, place, doc_id, line_no, line): keys of the wanted lines; place 0 and the
    text for a line as it stands, else the number of the deleted word."""
    kind = pa.schema(
        [("key", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("line_no", pa.int32()), ("line", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, wanted = batch.column("doc_id").to_pylist(), batch.column("wanted").to_pylist()
            for doc_id, text, numbers in zip(ids, as_bytes(batch.column("text")), wanted):
                lines = text.split(b"\n")
                for at in sorted(numbers):
                    keys = variants(lines[at].split())
                    n = len(keys)
                    columns = [keys, np.arange(n, dtype=np.int32), np.full(n, doc_id), np.full(n, at, np.int32)]
                    texts = [lines[at].decode(), *[None] * (n - 1)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(texts, pa.string())], schema=kind)

    by_doc = stored(wanted.groupBy("doc_id").agg(F.collect_list("line_no").alias("wanted")), "wanted")
    joined = docs.select("doc_id", "text").join(_few(by_doc, "wanted"), "doc_id")
    return in_arrow(joined, run, "key bigint, place int, doc_id bigint, line_no int, line string")


def _few(by_doc: DataFrame, numbers: str) -> DataFrame:
    """``by_doc``, with the broadcast hint if its rows and the line numbers they hold
    have been counted to be few."""
    held = by_doc.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size(numbers)), F.lit(0))).first()[0]
    return F.broadcast(by_doc) if held <= BROADCAST_NUMBERS else by_doc


def _verified(pairs: DataFrame) -> DataFrame:
    """The pairs (own, partner as text) whose lines are one edit apart, as (doc_id, line_no)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[t.split() for t in as_bytes(batch.column(c))] for c in ("line", "partner_line")]
            yield batch.filter(pa.array([within_one(a, b) for a, b in zip(*sides)], pa.bool_())).select(["doc_id", "line_no"])

    return in_arrow(pairs.select("doc_id", "line_no", "line", "partner_line"), run, "doc_id bigint, line_no int")


def near_repeats(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc_id, line_no) of different lines that have an earlier one within one edit.
    ``firsts`` has (first struct<doc_id, line_no>, halves) per different line."""
    keyed = firsts.filter(F.col("halves").isNotNull()).select("first", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    wanted = keyed.join(shared, "half").select("first.doc_id", "first.line_no").distinct()
    sent = stored(_emitted(docs, wanted), "variants")

    own = F.struct("doc_id", "line_no")
    by_place = stored(sent.groupBy("key", "place").agg(F.min(own).alias("least"), F.count(F.lit(1)).alias("n")), "places")
    replaced = by_place.filter((F.col("place") > 0) & (F.col("n") > 1)).select("key", "place", "least")
    whole = F.col("place") == 0
    added = by_place.groupBy("key").agg(
        F.min(F.when(whole, F.col("least"))).alias("whole"), F.min(F.when(~whole, F.col("least"))).alias("part")
    )
    added = added.filter(F.col("whole").isNotNull() & F.col("part").isNotNull())
    rows = sent.select("key", "place", own.alias("own"))
    links = rows.join(replaced, ["key", "place"]).select("own", F.col("least").alias("partner"))
    other = F.when(whole, F.col("part")).otherwise(F.col("whole"))
    links = links.union(rows.join(added, "key").select("own", other.alias("partner")))
    links = links.filter(F.col("partner") < F.col("own")).groupBy("own").agg(F.min("partner").alias("partner"))

    texts = sent.filter(whole).select("doc_id", "line_no", "line")
    mine = links.select("own.doc_id", "own.line_no", "partner").join(texts, ["doc_id", "line_no"])
    theirs = texts.select(F.struct("doc_id", "line_no").alias("partner"), F.col("line").alias("partner_line"))
    return _verified(mine.join(theirs, "partner"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, text): each document without the lines that
    repeat an earlier one, counted by kind.

    Lines end at a newline; they are compared by their words between ASCII blanks.
    Earlier means a smaller doc_id (an integer), then a smaller line number. A line
    goes if an equal one, or one within an edit if both have MIN_WORDS words or more,
    is earlier, whether or not that one stays. Lines without words stay. A null text
    stays null with no lines. Rows with a null id are returned as they are. Of rows that
    share an id the one whose text comes first is earlier; rows that also share the
    text are one document and keep the same lines.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = source.select("doc_id").filter(F.col("doc_id").isNotNull())
    if ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return _deduplicated(source)
    # Different rows get numbers of their own, in the order of their ids.
    counted = source.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    in_ranges = counted.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    numbered = stored(in_ranges.withColumn("row", F.monotonically_increasing_id()), "numbered")
    nameless = source.filter(F.col("doc_id").isNull())
    found = _deduplicated(numbered.select(F.col("row").alias("doc_id"), "text").unionByName(nameless))
    names = numbered.select("row", F.col("doc_id").alias("name"), "n")
    back = found.join(names, F.col("doc_id") == F.col("row"), "left").withColumn("doc_id", F.col("name"))
    uses = F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("n"), F.lit(1)).cast("int")))
    return back.withColumn("use", uses).select("doc_id", "n_lines", "n_exact", "n_near", "text")


def _deduplicated(source: DataFrame) -> DataFrame:
    """The same for ``source`` (doc_id, text), whose ids are unique or null."""
    named = source.filter(F.col("doc_id").isNotNull())
    lines = named.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # A filter on the words would be pushed below them, which cuts each line twice.
    lines = lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("words", _words("line")).withColumn("n", F.size("words"))
    # The key is exact but for collisions of md5; halves depend on it alone.
    keyed = lines.select(
        F.unhex(F.md5(F.array_join("words", " "))).alias("content"), _halves().alias("halves"),
        F.struct("doc_id", "line_no").alias("at"),
    )
    firsts = stored(keyed.groupBy("content", "halves").agg(F.min("at").alias("first")), "firsts").drop("content")
    near = stored(near_repeats(named, firsts), "near")
    by_doc = firsts.select("first.doc_id", "first.line_no").join(near.withColumn("near", F.lit(True)), ["doc_id", "line_no"], "left")
    by_doc = by_doc.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("near").isNull(), F.col("line_no"))).alias("kept"),
        F.collect_list(F.when(F.col("near"), F.col("line_no"))).alias("near"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = []
            for doc_id, text, kept, near in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "kept", "near")]):
                if text is None or doc_id is None:
                    out.append((doc_id, 0 if text is None else text.count("\n") + 1, 0, 0, text))
                    continue
                all_lines, kept, near = text.split("\n"), set(kept or ()), set(near or ())
                stay = [i for i, line in enumerate(all_lines) if i in kept or not line.encode().split()]
                gone = len(all_lines) - len(stay)
                out.append((doc_id, len(all_lines), gone - len(near), len(near), "\n".join(all_lines[i] for i in stay)))
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_exact", "n_near", "text"])

    joined = source.join(by_doc, "doc_id", "left")
    return in_arrow(joined, run, "doc_id bigint, n_lines bigint, n_exact bigint, n_near bigint, text string")
