"""SentencePiece encoding and decoding through a table of distinct chunks.

The library turns a space into a marker, puts one before the whole text and joins
characters to pieces. Where no piece has a marker behind another character, no
piece reaches from one marked word into the next: a text falls into chunks, each a
run of markers with the characters up to the next marker, and its ids are those of
its chunks in turn. A character that only pieces of its own hold (a line feed,
where the vocabulary has none in a longer piece) begins a chunk as well.

Texts are taken in slices of some megabytes. A slice becomes its distinct chunks and,
for every position of its texts, the number of the chunk that stands there. Each
distinct chunk is segmented once, by the library, and its ids go back to the
positions through their numbers, as array takes. The chunks met last stay in a
table of the worker, so that from slice to slice only new ones are segmented. Nothing
is shuffled: a table of the whole corpus' chunks would have to be joined
with every slice's own, which moves several times the input.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import Recent, in_arrow, text_slices

MARK = "▁"
SEPARATOR = "\x1f"  # texts that hold it take the slower way
SLICE_TEXT = 8 << 20
OUT_IDS = 1 << 20  # ids of the texts sent on at once
RECENT_CHUNKS = 300_000  # of a generation of a worker's table

_CHUNK = re.compile(" +[^ \n]*|\n[^ \n]*")


class Model:
    """A SentencePiece model that encodes and decodes chunks."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        check(proto)
        self.mark = self.library.piece_to_id(MARK)
        self.end = self.library.eos_id()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        # The library puts the first marker before a chunk itself. A chunk that begins
        # with a line feed has none, so the one the library adds is taken away.
        found = self.library.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [[self.mark] if c == " " else ids if c[0] == " " else ids[1:] for c, ids in zip(chunks, found)]

    def decode(self, chunks: list[str], ids: list[list[int]]) -> list[str]:
        """The text of each chunk's ids, its first marker a space."""
        texts = self.library.decode([i if c[0] == " " else [self.mark, *i] for c, i in zip(chunks, ids)], num_threads=1)
        return [" " + t if c[0] == " " else t for c, t in zip(chunks, texts)]


def check(proto) -> None:
    """Refuse a model whose pieces may reach across chunks."""
    rules, pieces = proto.normalizer_spec, [p for p in proto.pieces if p.type in (1, 4, 5)]
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces:
        raise ValueError("the model changes texts in other ways than marking their spaces")
    if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
        raise ValueError("the model has markers behind words or pieces of its user")
    if any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece for p in pieces) or all(p.piece != MARK for p in pieces):
        raise ValueError("pieces of the model may cross a marker or a line feed")


class Table:
    """A model with a table of the chunks it segmented last: their ids and texts."""

    def __init__(self, model: Model):
        self.model = model
        self.recent = Recent(RECENT_CHUNKS)

    def segmented(self, chunks: list[str]) -> tuple[pa.ListArray, pa.Array]:
        """The ids and texts of different chunks."""
        held = self.recent.many(chunks)
        new = [i for i, known in enumerate(held) if known is None]
        some = [chunks[i] for i in new]
        ids = self.model.encode(some)
        for i, own, text in zip(new, ids, self.model.decode(some, ids)):
            held[i] = (array("i", own).tobytes(), text)
            self.recent.put(chunks[i], held[i])
        flat = np.frombuffer(b"".join([k[0] for k in held]), np.int32)
        ends = np.cumsum(np.fromiter((len(k[0]) for k in held), np.int64, len(held)) // 4)
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array([k[1] for k in held], pa.string())


def worker_table(path: str) -> Table:
    """The worker's own table for a model, kept from task to task."""
    home = sys.modules.setdefault("_chunk_tables", ModuleType("_chunk_tables")).__dict__
    if path not in home:
        home[path] = Table(Model(path))
    return home[path]


def chunked(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different chunks, the number of the chunk at each position, positions of each
    text). A space stands for the marker; null and empty texts have no chunk."""
    texts = pc.fill_null(texts, "")
    marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " "))
    odd = pc.match_substring_regex(marked, f"  |{MARK}|{SEPARATOR}").to_numpy(zero_copy_only=False)
    even = pc.if_else(pa.array(odd), "", marked)
    for blank in (" ", "\n"):
        even = pc.replace_substring(even, blank, SEPARATOR + blank)
    cut = pc.split_pattern(even, SEPARATOR)
    sizes = np.diff(cut.offsets.to_numpy()) - 1  # nothing stands before the first separator
    first = np.zeros(len(cut.values), dtype=bool)
    first[cut.offsets.to_numpy()[:-1]] = True
    coded = cut.values.filter(pa.array(~first)).dictionary_encode()
    chunks, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int32)
    rows = np.flatnonzero(odd).tolist()
    if rows:
        number = {c: i for i, c in enumerate(chunks)}
        parts = np.split(codes, np.cumsum(sizes)[:-1])
        for i in rows:
            found = _CHUNK.findall(marked[i].as_py().replace(MARK, " "))
            parts[i] = np.array([number.setdefault(c, len(number)) for c in found], dtype=np.int32)
            sizes[i] = len(found)
        chunks, codes = list(number), np.concatenate(parts)
    return chunks, codes, sizes


_OUT_DDL = "doc_id bigint, ids array<int>, decoded string"
_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encoded_slice(doc_ids: pa.Array, texts: pa.Array, table: Table) -> Iterator[pa.RecordBatch]:
    """The ids and decoded texts of some documents, about OUT_IDS ids at a time."""
    chunks, codes, sizes = chunked(texts)
    ids, decoded = table.segmented(chunks)
    flat, width = ids.values.to_numpy(), np.diff(ids.offsets.to_numpy()).astype(np.int64)
    begin, stops = np.cumsum(width) - width, np.cumsum(sizes)
    tokens = np.concatenate([[0], np.cumsum(width[codes])])[np.concatenate([[0], stops])]
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(tokens, tokens[at] + OUT_IDS, "right")) - 1)
        own = codes[stops[at] - sizes[at] : stops[upto - 1]]
        n = width[own]
        found = flat[np.arange(int(n.sum())) + np.repeat(begin[own] - (np.cumsum(n) - n), n)]
        counts = np.diff(tokens[at : upto + 1]) + 1
        out = np.full(len(found) + len(counts), table.model.end, dtype=np.int32)
        mine = np.ones(len(out), dtype=bool)
        mine[np.cumsum(counts) - 1] = False
        out[mine] = found
        words = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes[at:upto])]).astype(np.int32)), decoded.take(pa.array(own))
        )
        # The marker that the library put before a text is not part of it.
        text = pc.utf8_slice_codeunits(pc.binary_join(words, ""), 1)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))
        yield pa.RecordBatch.from_arrays([doc_ids.slice(at, upto - at), listed, text], schema=_OUT)
        at = upto


def encoded(docs: DataFrame, model: str, slice_text: int = SLICE_TEXT) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs`` (doc_id, text): the ids of its
    whole text as the library gives them, the end id last, and the text that these
    ids stand for. A null text is empty and has the end id alone; rows that share an
    id or a text are rows of their own. ``model`` is a file that every machine has;
    one whose pieces may cross chunks is refused."""
    if not os.path.exists(model):
        raise FileNotFoundError(model)
    Model(model)  # refused here rather than in the tasks
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(model)
        held: list[pa.RecordBatch] = []

        def emptied() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            yield from encoded_slice(rows.column("doc_id").combine_chunks(), rows.column("text").combine_chunks(), table)

        for batch in text_slices(batches, limit=slice_text):
            held.append(batch)
            if sum(b.nbytes for b in held) >= slice_text:
                yield from emptied()
        if held:
            yield from emptied()

    return in_arrow(source, run, _OUT_DDL)
