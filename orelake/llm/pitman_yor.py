"""A hierarchical Pitman-Yor language model over words, sampled by Gibbs.

Every word has a restaurant whose customers are the words that follow it; these
context restaurants share one parent, the restaurant of all words, which draws
from a base distribution over the training words and one unknown word. A context
restaurant holds, for each dish (following word), its customers and the tables
they sit at; every table is a customer of the parent.

A Gibbs sweep seats the customers of each dish anew, given the other tables of
its restaurant and the parent's predictive probability: the first opens a table,
each further one opens another with the weight of a new table or joins one of the
dish's tables. From the 17th customer on they come in groups of a sixteenth of
those seated. Then the parent's customers, the tables of all contexts, are seated
in the same way. After ``BURN_IN`` sweeps, the predictive probabilities of
``SAMPLES`` sweeps are averaged.

How it is spread: documents are cut into blocks of some megabytes, which number
their words and hold their tokens as numbers. All that blocks must know of one
another are sums per word and per word pair. A block sends its keys, sorted and
packed, with its counts to the tasks that own ranges of the key space and gets the
sums back in its own order. A word that makes up a third of the corpus is one key
per block, so no task gets more for it. The random number of a seat is a hash of
the pair, the sweep and the step, so that all blocks seat a pair alike without
telling each other. Words and pairs are known by 64-bit hashes.

Blocks are kept in tables bucketed by block, so that only sums are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import give_back, in_arrow, remainder, split_words, stored, text_slices
from orelake.session import scratch_dir

BLOCK_BYTES = 12 << 20
BURN_IN, SAMPLES = 1, 2
CONCENTRATION = 1.0  # of every restaurant
UNKNOWN_SHARE = 0.5  # of the base distribution, for the unknown word
HELD_OUT = (10, 0)
_START, _END = np.uint64(1), np.uint64(2)  # stand for the places before and after a text
_U = np.uint64


# --- packed numbers ------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value for each 64-bit value."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * _U(0x9E3779B97F4A7C15) + mix(w))


def tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the different values, rising, and how often each occurs)."""
    values = np.sort(values)
    starts = np.flatnonzero(np.append(np.ones(min(len(values), 1), bool), values[1:] != values[:-1]))
    return values[starts], np.diff(np.append(starts, len(values)))


def pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys as the byte planes of their differences."""
    return np.diff(keys, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(_U).ravel(), dtype=_U)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs."""
    most = int(values.max()) if len(values) else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


# --- blocks ----------------------------------------------------------------------

_BLOCK = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.binary()), ("sizes", pa.binary()),
     ("vocabulary", pa.binary()), ("codes", pa.binary())]
)
_BLOCK_DDL = "block bigint, doc_ids array<bigint>, held_out binary, sizes binary, vocabulary binary, codes binary"


def _code(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, sorted word hashes, the number of each word's hash)."""
    sizes, words, codes = split_words(table.column("text").combine_chunks())
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=_U)
    vocabulary, place = np.unique(np.concatenate([np.array([_START, _END]), hashes]), return_inverse=True)
    return sizes, vocabulary, place[2:][codes]


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    divisor, held = HELD_OUT
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(remainder("doc_id", divisor) == held, F.lit(False)).alias("held_out"),
    )

    def block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        sizes, vocabulary, words = _code(table)
        # Each text is its words and the end.
        ends = np.cumsum(sizes + 1)
        codes = np.full(int(ends[-1]), np.searchsorted(vocabulary, _END), dtype=np.int64)
        inner = np.ones(len(codes), dtype=bool)
        inner[ends - 1] = False
        codes[inner] = words
        held = table.column("held_out").to_numpy().astype(np.uint8)
        row = [number, table.column("doc_id").to_pylist(), held.tobytes(), pack(sizes + 1), pack_keys(vocabulary), pack(codes)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCK.types)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in text_slices(batches, limit=block_bytes // 8):
            held.append(batch)
            size += batch.nbytes
            if size >= block_bytes:
                yield block(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield block(number, held)

    return in_arrow(source, run, _BLOCK_DDL)


@dataclass
class Block:
    """A block read back: tokens with the words before them, and its word pairs."""

    row: dict
    vocabulary: np.ndarray = field(init=False)
    sizes: np.ndarray = field(init=False)
    learned: np.ndarray = field(init=False)  # per token
    w: np.ndarray = field(init=False)
    u: np.ndarray = field(init=False)

    def __post_init__(self):
        self.vocabulary = unpack_keys(self.row["vocabulary"])
        self.sizes = unpack(self.row["sizes"])
        self.w = unpack(self.row["codes"]).astype(np.int32)
        self.u = np.roll(self.w, 1)
        self.u[np.concatenate([[0], np.cumsum(self.sizes)[:-1]])] = np.searchsorted(self.vocabulary, _START)
        self.learned = np.repeat(np.frombuffer(self.row["held_out"], np.uint8) == 0, self.sizes)

    def _token_keys(self) -> np.ndarray:
        return pair_keys(self.vocabulary[self.u], self.vocabulary[self.w])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sorted keys, their u, their w, the number of each token's pair)."""
        keys, first, place = np.unique(self._token_keys(), return_index=True, return_inverse=True)
        return keys, self.u[first], self.w[first], place.astype(np.int32)

    def different_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted keys, their u, their w)."""
        keys, first = np.unique(self._token_keys(), return_index=True)
        return keys, self.u[first], self.w[first]

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, the learned tokens of each): sorted as values, without their places."""
        token_keys = self._token_keys()
        keys, counts = tally(token_keys)
        if not self.learned.all():
            learned, times = tally(token_keys[self.learned])
            counts = np.zeros(len(keys), dtype=np.int64)
            counts[np.searchsorted(keys, learned)] = times
        return keys, counts


# --- sums over blocks -------------------------------------------------------------

_ASK_DDL = "block bigint, bucket bigint, keys binary, parts array<binary>"
_TOLD_DDL = "kind int, block bigint, bucket bigint, sums array<binary>, owner binary, totals array<double>"
_ASK = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("parts", pa.list_(pa.binary()))])


def ask(block: int, keys: np.ndarray, parts: list[np.ndarray], buckets: int) -> pa.Table:
    """Messages with the counts of rising keys, one for each range of keys."""
    width = -(-(1 << 64) // buckets)
    borders = np.array([i * width for i in range(1, buckets)], dtype=_U)
    cuts = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return pa.table(
        [
            pa.array([block] * len(rows), pa.int64()),
            pa.array([i for i, _, _ in rows], pa.int64()),
            pa.array([pack_keys(keys[a:b]) for _, a, b in rows], pa.binary()),
            pa.array([[pack(p[a:b]) for p in parts] for _, a, b in rows], pa.list_(pa.binary())),
        ],
        schema=_ASK,
    )


Post = Callable[[np.ndarray, list[np.ndarray]], tuple[list[np.ndarray], list[float]]]


def summed(asked: DataFrame, kind: int, post: Post) -> DataFrame:
    """Answers to messages: the sums of each key over all blocks in the order of the
    message, whether the message is the key's first, and a bucket's totals.
    ``post`` turns a bucket's keys and sums into what is told, and totals."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        give_back()
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        held = [unpack_keys(r["keys"]) for r in rows]
        keys, first, place = np.unique(np.concatenate(held), return_index=True, return_inverse=True)
        width = len(rows[0]["parts"])
        parts = [np.concatenate([unpack(r["parts"][i]) for r in rows]) for i in range(width)]
        told, totals = post(keys, [np.bincount(place, p, len(keys)).astype(np.int64) for p in parts])
        owner = np.zeros(len(place), dtype=np.uint8)
        owner[first] = 1
        out, at = [], 0
        for i, (r, h) in enumerate(zip(rows, held)):
            mine = place[at : at + len(h)]
            flags = np.packbits(owner[at : at + len(h)]).tobytes()
            out.append((kind, r["block"], r["bucket"], [pack(t[mine]) for t in told], flags, totals if i == 0 else []))
            at += len(h)
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.float64())]
        names = ["kind", "block", "bucket", "sums", "owner", "totals"]
        return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)

    return asked.groupBy("bucket").applyInArrow(run, _TOLD_DDL)


def totals(told: DataFrame, n: int) -> list[float]:
    row = told.filter(F.size("totals") > 0).agg(*[F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(n)]).first()
    return [x or 0.0 for x in row]


def answers(rows: list[dict], kind: int, width: int) -> list[np.ndarray]:
    """The sums of a kind in the order of the block's keys, and the owner flags."""
    mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
    if not mine:
        return [np.zeros(0, np.int64)] * (width + 1)
    sums = [[unpack(r["sums"][i]) for r in mine] for i in range(width)]
    flags = [np.unpackbits(np.frombuffer(r["owner"], np.uint8), count=len(s)) for r, s in zip(mine, sums[0])]
    return [np.concatenate(x) for x in (*sums, flags)]


# --- seating ----------------------------------------------------------------------


def seated(customers: np.ndarray, weight: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """The tables at which each dish's customers come to sit. ``weight`` is that of a
    new table: what the restaurant's other tables and its parent give it."""
    tables = (customers > 0).astype(np.int64)
    here = np.flatnonzero(customers > 1)
    sitting, step = 1, 0
    while len(here):
        group = max(1, sitting // 16)
        coming = np.minimum(group, customers[here] - sitting)
        seed = keys[here] + _U((sweep * 0x632BE59BD9B4E019 + step * 0x9E6C63D0876A9A47) & (1 << 64) - 1)
        chance = (mix(seed) >> _U(11)).astype(np.float64) * 2.0**-53
        new = weight[here] / (weight[here] + sitting - discount * tables[here])
        tables[here] += np.minimum(np.floor(coming * new + chance).astype(np.int64), coming)
        sitting += group
        step += 1
        here = here[customers[here] > sitting]
    return tables


def kneser_ney(ones: float, twos: float) -> float:
    """The discount that counts of one and two suggest, kept off its bounds."""
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones else 0.5


@dataclass(frozen=True)
class Sweep:
    """The parent restaurant after a sweep: discount, customers and tables in all."""

    discount: float
    customers: float
    tables: float

    def new_table(self) -> float:
        return CONCENTRATION + self.discount * self.tables

    def predictive(self, customers: np.ndarray, tables: np.ndarray, base: np.ndarray) -> np.ndarray:
        return (customers - self.discount * tables + self.new_table() * base) / (CONCENTRATION + self.customers)


_PAIRS, _WORDS, _SWEEP = 0, 1, 2
_STATE_DDL = "block bigint, vocabulary binary, u binary, w binary, customers binary, keys binary, tables binary, used binary"


class Model:
    """One run of the model over a corpus; the steps are Spark jobs."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES):
        self.spark = docs.sparkSession
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []
        self.blocks = self._kept(_blocks(docs, block_bytes))
        self.words = stored(summed(self._from_blocks(self._word_counts()), _WORDS, _word_post), "words")
        self.train_tokens, self.distinct = (int(x) for x in totals(self.words, 2))
        self.pairs = stored(summed(self._from_blocks(self._pair_counts()), _PAIRS, _pair_post), "pairs")
        self.discount = kneser_ney(*totals(self.pairs, 2))
        self.state = self._kept(self._with(self.blocks, self.pairs, self._multiples(), _STATE_DDL))
        self.sweeps: list[tuple[DataFrame, Sweep]] = []
        for number in range(BURN_IN + SAMPLES + 1):
            self._sweep(number)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE {name}")

    def _kept(self, df: DataFrame) -> DataFrame:
        name = f"pitman_yor_{uuid.uuid4().hex}"
        path = f"{scratch_dir(self.spark, 'llm')}/{name}"
        writer = df.write.option("path", path).option("compression", "zstd")
        writer.bucketBy(self.buckets, "block").saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def _from_blocks(self, run: Callable[[pa.Table], pa.Table]) -> DataFrame:
        return self.blocks.groupBy("block").applyInArrow(run, _ASK_DDL)

    @staticmethod
    def _with(blocks: DataFrame, told: DataFrame, run: Callable, ddl: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, ddl)

    def _word_counts(self) -> Callable[[pa.Table], pa.Table]:
        buckets = self.buckets

        def run(table: pa.Table) -> pa.Table:
            give_back()
            b = Block(table.to_pylist()[0])
            n = len(b.vocabulary)
            parts = [np.bincount(x[b.learned], minlength=n) for x in (b.w, b.u)]
            return ask(b.row["block"], b.vocabulary, parts, buckets)

        return run

    def _pair_counts(self) -> Callable[[pa.Table], pa.Table]:
        buckets = self.buckets

        def run(table: pa.Table) -> pa.Table:
            give_back()
            b = Block(table.to_pylist()[0])
            keys, counts = b.pair_counts()
            return ask(b.row["block"], keys, [counts], buckets)

        return run

    def _multiples(self) -> Callable[[pa.Table, pa.Table], pa.Table]:
        """The pairs a block owns: those of one customer as counts of tables per word,
        those of several one by one."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            give_back()
            b = Block(left.to_pylist()[0])
            keys, u, w = b.different_pairs()
            customers, owner = answers(right.to_pylist(), _PAIRS, 1)
            single, several = (customers == 1) & (owner == 1), (customers > 1) & (owner == 1)
            n = len(b.vocabulary)
            row = {
                "block": b.row["block"], "vocabulary": b.row["vocabulary"],
                "u": pack(u[several]), "w": pack(w[several]), "customers": pack(customers[several]),
                "keys": pack_keys(keys[several]),
                "tables": pack(np.bincount(u[single], minlength=n)), "used": pack(np.bincount(w[single], minlength=n)),
            }
            kinds = [pa.int64()] + [pa.binary()] * 7
            return pa.table([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

        return run

    def _base(self) -> tuple[float, float]:
        """The base probability of a training word and of the unknown word."""
        return (1 - UNKNOWN_SHARE) / max(self.distinct, 1), UNKNOWN_SHARE

    def _sweep(self, number: int) -> None:
        buckets, discount, known = self.buckets, self.discount, self._base()[0]
        last = self.sweeps[-1] if self.sweeps else None
        parent = last[1] if last else None

        def run(left: pa.Table, right: pa.Table | None = None) -> pa.Table:
            give_back()
            row = left.to_pylist()[0]
            vocabulary, keys = unpack_keys(row["vocabulary"]), unpack_keys(row["keys"])
            u, w, customers = (unpack(row[c]) for c in ("u", "w", "customers"))
            if parent is None:
                new = np.ones(len(u), dtype=np.int64)
            else:
                told = answers(right.to_pylist(), _SWEEP, 3)
                new = seated(customers, _weights(told, parent, discount, known, u, w), discount, keys, number)
            n = len(vocabulary)
            parts = [unpack(row["tables"]) + np.bincount(u, new, n).astype(np.int64),
                     unpack(row["used"]) + np.bincount(w, new, n).astype(np.int64)]
            return ask(row["block"], vocabulary, parts, buckets)

        def post(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[float]]:
            tables, customers = sums
            if parent is None:
                own = (customers > 0).astype(np.int64)
            else:
                weight = np.full(len(keys), parent.new_table() * known)
                own = seated(customers, weight, parent.discount, keys, number)
            ones, twos = int((customers == 1).sum()), int((customers == 2).sum())
            return [tables, customers, own], [float(customers.sum()), float(own.sum()), ones, twos]

        if last:
            asked = self._with(self.state, last[0], run, _ASK_DDL)
        else:
            asked = self.state.groupBy("block").applyInArrow(lambda table: run(table), _ASK_DDL)
        told = stored(summed(asked, _SWEEP, post), f"sweep{number}")
        customers, own, ones, twos = totals(told, 4)
        keep = parent.discount if parent else kneser_ney(ones, twos)
        self.sweeps.append((told, Sweep(keep, customers, own)))

    def scores(self) -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
        total, distinct, discount = self.train_tokens, self.distinct, self.discount
        known, unknown = self._base()
        used = self.sweeps[BURN_IN:]
        parents = [s for _, s in used]
        told = self.words.unionByName(self.pairs)
        for i, (rows, _) in enumerate(used):
            told = told.unionByName(rows.withColumn("kind", F.lit(_SWEEP + i)))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            give_back()
            b, rows = Block(left.to_pylist()[0]), right.to_pylist()
            keys, u, w, place = b.pairs()
            count, context, _ = answers(rows, _WORDS, 2)
            customers, _ = answers(rows, _PAIRS, 1)
            base = np.where(count > 0, known, unknown)
            told = [answers(rows, _SWEEP + i, 3) for i in range(len(parents))]
            chance = np.zeros(len(keys))
            for i in range(1, len(parents)):
                weight = _weights(told[i - 1], parents[i - 1], discount, known, u, w)
                tables = seated(customers, weight, discount, keys, BURN_IN + i)
                open_, used_by, own, _ = told[i]
                above = parents[i].predictive(used_by, own, base)[w]
                all_ = CONCENTRATION + context[u]
                chance += (customers - discount * tables + (CONCENTRATION + discount * open_[u]) * above) / all_
            score = np.log10(chance / (len(parents) - 1))
            plain = np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))
            starts = np.concatenate([[0], np.cumsum(b.sizes)[:-1]])
            sums = [np.add.reduceat(x, starts) for x in ((count > 0)[b.w].astype(np.int64), plain[b.w], score[place])]
            held = np.frombuffer(b.row["held_out"], np.uint8).astype(bool)
            columns = [pa.array(b.row["doc_ids"], pa.int64()), held, b.sizes, sums[0], np.full(len(held), total), sums[1], sums[2]]
            names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            return pa.table(columns, names=names)

        ddl = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
        return self._with(self.blocks, told, run, ddl)


def _weights(told: list[np.ndarray], parent: Sweep, discount: float, known: float, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The weight of a new table for dish w in restaurant u, whose other tables count."""
    tables, customers, own = told[:3]
    above = parent.predictive(customers, own, np.full(len(own), known))
    return (CONCENTRATION + discount * np.maximum(tables[u] - 1, 0)) * above[w]


def _word_post(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[float]]:
    return sums, [float(sums[0].sum()), float((sums[0] > 0).sum())]


def _pair_post(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[float]]:
    return sums, [float((sums[0] == 1).sum()), float((sums[0] == 2).sum())]


def scored(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Texts are lower-cased (A-Z) and cut at ASCII blanks; one end follows. A null text
    is empty: its end is its only token. A null id is not held out and is learned
    from. Repeated rows each count and keep a row. Without training documents every
    token is unknown. base_score is the log10 of the additive unigram probability,
    score that of the model's averaged predictive probabilities, summed over tokens.
    """
    if docs.isEmpty():
        ddl = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
        return docs.sparkSession.createDataFrame([], ddl)
    model = Model(docs, block_bytes)
    out = stored(model.scores(), "scores")
    model.close()
    return out
