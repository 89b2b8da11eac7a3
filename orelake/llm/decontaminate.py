"""Benchmark decontamination by a prefix-filtered containment join.

An item's windows are its runs of 13 words (the whole item if shorter). A
document contains a window exactly if it contains all of its words in order, so
the required overlap is the whole window and the prefix that any match must
share is one token: the window's rarest. Rarity is a count over all documents.
The scan looks up each document word in the table of these prefix tokens; a
match fixes where the window would have to start, which has to leave room for
the whole window before and after (the positional and length bounds), and the
window is then compared word by word.

The benchmark is held by the tasks in parts of at most ``PART_WINDOWS``
windows. A larger benchmark is worked through part by part, each a pass over
the documents, and the hits are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import as_bytes, bounded, in_arrow, stored, text_slices

WINDOW = 13
PART_WINDOWS = 250_000
SHARE = 20  # contaminated from one hit word in 20 on

# Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
_KEEP = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def item_windows(text: bytes) -> set[tuple[bytes, ...]]:
    w = words(text)
    size = min(WINDOW, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window array<binary>, items array): every different window with the ids,
    as text, of the items it comes from. Items without id or words have none."""
    source = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    kind = pa.schema([("item", pa.string()), ("window", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = [
                (i, list(w))
                for i, t in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text")))
                for w in item_windows(t)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kind.types)], schema=kind)

    found = in_arrow(source.filter(F.col("item").isNotNull()), run, "item string, window array<binary>")
    return found.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Part:
    """Some windows, ready to be looked for: words as numbers, prefix tokens by number."""

    def __init__(self, windows: list[tuple[list[bytes], list[str]]], counts: dict[bytes, int]):
        self.number: dict[bytes, int] = {}
        self.items = [i for _, i in windows]
        self.coded = [np.array([self.number.setdefault(w, len(self.number)) for w in ws]) for ws, _ in windows]
        self.by_prefix: dict[int, list[tuple[int, int]]] = {}
        for k, (ws, _) in enumerate(windows):
            at = min(range(len(ws)), key=lambda j: (counts.get(ws[j], 0), ws[j], j))
            self.by_prefix.setdefault(int(self.coded[k][at]), []).append((k, at))
        self.is_prefix = np.zeros(len(self.number) + 1, dtype=bool)
        self.is_prefix[list(self.by_prefix)] = True

    def occurrences(self, text_words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, window number) of each place where a window occurs."""
        get, unknown = self.number.get, len(self.number)
        codes = np.array([get(w, unknown) for w in text_words], dtype=np.int64)
        for at in np.flatnonzero(self.is_prefix[codes]).tolist():
            for k, offset in self.by_prefix[int(codes[at])]:
                start, coded = at - offset, self.coded[k]
                if 0 <= start <= len(codes) - len(coded) and np.array_equal(codes[start : start + len(coded)], coded):
                    yield start, k


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs in all documents."""
    held = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(sorted(vocabulary))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value
        total = np.zeros(len(number) + 1, dtype=np.int64)
        for batch in text_slices(batches):
            for text in as_bytes(batch.column("text")):
                codes = np.array([number.get(w, len(number)) for w in words(text)], dtype=np.int64)
                total += np.bincount(codes, minlength=len(number) + 1)
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["word", "n"])

    counted = in_arrow(docs, run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    by_number = sorted(vocabulary)
    out = {by_number[r["word"]]: r["n"] for r in counted.collect()}  # at most one row per word of the vocabulary
    held.unpersist()
    return out


def _found(docs: DataFrame, windows: list[tuple[list[bytes], list[str]]], counts: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_words, spans, items) per row: start and end of hit runs, items that occur."""
    held = docs.sparkSession.sparkContext.broadcast((windows, counts))
    kind = pa.schema(
        [("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _Part(*held.value)
        for batch in text_slices(batches):
            n, spans, items = [], [], []
            for text in as_bytes(batch.column("text")):
                w = words(text)
                runs, names = [], set()
                for start, k in sorted(look.occurrences(w)) if w else ():
                    end = start + len(look.coded[k])
                    names.update(look.items[k])
                    if runs and start <= runs[-1]:
                        runs[-1] = max(runs[-1], end)
                    else:
                        runs += [start, end]
                n.append(len(w))
                spans.append(runs)
                items.append(sorted(names))
            columns = [pa.array(x, t) for x, t in zip((n, spans, items), kind.types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *columns],
                                             names=["doc_id", "row", *kind.names])

    key = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs, run, f"doc_id {key}, row bigint, n_words bigint, spans array<bigint>, items array<string>"
    )


def _digest(found: DataFrame) -> DataFrame:
    """The hits of a row, whatever parts of the benchmark they came from, as figures."""
    key = found.schema["doc_id"].dataType.simpleString()
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, spans, items in zip(*[batch.column(c).to_pylist() for c in ("n_words", "spans", "items")]):
                hit, reach = 0, -1
                for start, end in sorted(zip(spans[::2], spans[1::2])):
                    hit += max(0, end - max(start, reach))
                    reach = max(reach, end)
                ids = sorted(set(items))
                sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
                rows.append((n, hit, len(ids), sha, hit > 0 and SHARE * hit >= n))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return in_arrow(found, run,
        f"doc_id {key}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row.

    n_hit counts the words inside any occurrence of an item's window; n_items the
    items with an occurring window. A null or empty text has no words and is
    clean; so is everything where the benchmark has no rows. Items without id or
    words are passed over; rows that repeat an item id are windows of one item.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    windows = stored(windows_of(items, item_col), "windows")
    total = windows.count()
    parts = max(1, -(-total // part_windows))
    number = F.pmod(F.xxhash64("window"), F.lit(parts))
    # A row keeps its number while parts are merged; with one part it is not needed.
    numbered = source.withColumn("row", F.lit(0).cast("long"))
    if parts > 1:
        numbered = stored(source.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = []
    for p in range(parts):
        chosen = [(list(r["window"]), r["items"]) for r in windows.filter(number == p).collect()]
        counts = word_counts(source.select("text"), {w for ws, _ in chosen for w in ws}) if chosen else {}
        found.append(_found(numbered, chosen, counts))
    if parts > 1:
        merged = reduce(DataFrame.unionByName, found).groupBy("row")
        found = [
            merged.agg(
                F.first("doc_id").alias("doc_id"),
                F.first("n_words").alias("n_words"),
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.flatten(F.collect_list("items")).alias("items"),
            ).select("doc_id", "row", "n_words", "spans", "items")
        ]
    return _digest(found[0])


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated documents. The verdict is one of a document's
    text, known by 128 bits of hash and its length; rows with a null id are judged by
    their text like any other."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = ("__llm_text", "__llm_again", "__llm_len")
    own = (F.xxhash64(text), F.xxhash64(F.lit("again"), text), F.length(text))
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(own, names)])
    slim = docs.select(F.struct(*[c.alias(n) for c, n in zip(own, names)]).alias("k"), F.col(text_col).alias("t"))
    bad = contamination(slim, items, "k", "t").filter("contaminated").select("doc_id").distinct()
    bad = stored(bad.select(*[F.col(f"doc_id.{n}").alias(n) for n in names]), "contaminated")
    joined = keyed.join(bounded(bad), list(names), "left_anti")
    return joined.select(*[f"`{c}`" for c in docs.columns])


_PLAIN = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LISTED = f"regexp_extract_all({_PLAIN}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_LISTED}, []) AS w FROM documents),
i AS (SELECT item_id, {_LISTED} AS w FROM benchmark WHERE item_id IS NOT NULL),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, list_slice(w, s, s + {WINDOW} - 1) AS v FROM starts),
looked AS (SELECT DISTINCT v, v[1] AS f, v[len(v)] AS l, len(v) AS n FROM windows),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d),
met AS (
  SELECT r, p, v, n FROM places JOIN looked ON w[p] = f AND w[p + n - 1] = l WHERE list_slice(w, p, p + n - 1) = v),
hits AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM met) GROUP BY r),
names AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM met JOIN windows USING (v)) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND {SHARE} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""
