"""Language identification in two levels: family first, then language.

A text is described by its letters only: counts of one, two and three adjacent
bytes of its letters (other characters count as one space), hashed into
``DIMENSIONS`` cells, damped by a square root and scaled to length one. A
linear support vector machine for each pair of families chooses the family, one
for each pair of languages within it the language; each pair votes.

The machines are fitted on all labelled texts. Their counts are written once; each
step of L-BFGS adds up loss and gradient of all machines in one Spark pass over
them. Every text is predicted, from the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orelake.llm.common import as_bytes, bounded, in_arrow, remainder, stored, text_slices

DIMENSIONS = 2048
ROWS_AT_ONCE = 256
PENALTY = 1e-3
STEPS = 30  # of L-BFGS
ENOUGH = 1e-4  # share of the loss; a step that gains less is the last
FIXED_POINT = 1 << 24  # sums of whole numbers do not depend on their order
SCORE_BINS = 4096
UNKNOWN = "und"
MISSED = 0.001  # share of the held-out texts, judged right, that limits may reject
LEAST_MEASURED = 50
MARGIN = 0.1  # limits lie so far below what was measured
SIZE_CLASSES = 14
HELD_OUT = (4, 2)  # ids whose crc32 leaves 2 on division by 4 are not learned from

# Languages of one family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "indo-aryan": "hi ur bn mr ne pa gu",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "sinitic": "zh yue",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def has_letter(text: bytes) -> bool:
    plain = text.translate(_LETTERS)
    if any(w for w in plain.split() if w[0] < 0x80):
        return True
    return any(c.isalpha() for c in plain.decode("utf-8", "ignore"))


def counted(texts: list[bytes], dimensions: int) -> np.ndarray:
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    for row, text in enumerate(texts):
        b = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", dtype=np.uint8).astype(np.uint32)
        pairs = b[:-1] << 8 | b[1:]
        for n, code in enumerate((b, pairs, pairs[:-1] << 8 | b[2:]), 1):
            cell = (code + np.uint32(n << 24)) * np.uint32(2654435761) >> np.uint32(12)
            out[row] += np.bincount(cell % dimensions, minlength=dimensions)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    out = np.sqrt(counts)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norms, 1e-9)


def describe(texts: list[bytes], dimensions: int) -> np.ndarray:
    return scaled(counted(texts, dimensions))


@dataclass(frozen=True)
class Pair:
    """A machine that is positive for ``first`` and negative for ``second``."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Model:
    members: dict[str, list[str]]  # family -> its languages
    family_pairs: list[Pair]
    language_pairs: dict[str, list[Pair]]
    dimensions: int

    def judge(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for at in range(0, len(texts), ROWS_AT_ONCE):
            some = texts[at : at + ROWS_AT_ONCE]
            spoken = np.array([bool(self.members) and has_letter(t) for t in some], dtype=bool)
            label = np.full(len(some), UNKNOWN, dtype=object)
            score = np.zeros(len(some))
            if spoken.any():
                x = describe([t for t, s in zip(some, spoken) if s], self.dimensions)
                family, sure = _vote(x, sorted(self.members), self.family_pairs)
                found, degree = np.empty(len(x), dtype=object), np.zeros(len(x))
                for name, languages in self.members.items():
                    here = family == name
                    found[here], degree[here] = _vote(x[here], languages, self.language_pairs[name])
                label[spoken], score[spoken] = found, sure * degree
            names += label.tolist()
            scores += score.tolist()
        return names, scores


def _vote(x: np.ndarray, classes: list[str], pairs: list[Pair]) -> tuple[np.ndarray, np.ndarray]:
    """The class with most won pairs, then with the clearest, and its mean support (0 to 1)."""
    place = {c: i for i, c in enumerate(classes)}
    wins, support = np.zeros((2, len(x), len(classes)))
    for p in pairs:
        margin = x @ p.weights + p.bias
        share = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
        for c, s in ((p.first, share), (p.second, 1 - share)):
            support[:, place[c]] += s
            wins[:, place[c]] += s >= 0.5
    rivals = max(len(classes) - 1, 1)
    best = np.argmax(wins + support / (2 * rivals), axis=1)
    sure = support[np.arange(len(x)), best] / rivals if pairs else np.ones(len(x))
    return np.array(classes, dtype=object)[best], sure


def labelled(docs: DataFrame, held_out: bool = False) -> DataFrame:
    """The rows with a language to learn from, or the held-out ones."""
    divisor, held = HELD_OUT
    rest = remainder("doc_id", divisor)
    return docs.filter((rest == held if held_out else rest != held) & F.col("lang").isNotNull())


def labelled_sample(docs: DataFrame, per_language: int, held_out: bool = False) -> DataFrame:
    """(text, lang): at most ``per_language`` rows of each language, of those to learn
    from or of the held-out ones. They are chosen by id; only the texts of chosen
    ids are read further."""
    known = labelled(docs, held_out)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    # Twice the share that is wanted, so that next to no row reaches the ranking in vain.
    share = F.col("place") * F.col("size").cast("double") < 2.0 * per_language * float(1 << 40)
    near = known.select("doc_id", "lang", place.alias("place")).join(bounded(stored(sizes, "sizes")), "lang").filter(share)
    rank = F.row_number().over(W.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = stored(near.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("doc_id", "lang"), "chosen")
    rows = known.join(bounded(chosen.distinct()), ["doc_id", "lang"], "left_semi")
    # An id that is repeated may bring more rows than it was counted for.
    rank = F.row_number().over(W.partitionBy("lang").orderBy("doc_id", "text"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("text", "lang")


def _chosen(docs: DataFrame, per_language: int | None, held_out: bool = False) -> DataFrame:
    """(text, lang) of the rows to learn from or of the held-out ones: all, or so many of each language."""
    columns = [F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")]
    docs = docs.select(*columns)
    return labelled(docs, held_out).select("text", "lang") if per_language is None else labelled_sample(docs, per_language, held_out)


def described(known: DataFrame, dimensions: int) -> DataFrame:
    """(lang, cells): the counts of the texts with a letter, each in as few bytes as its largest takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts, langs = as_bytes(batch.column("text")), batch.column("lang")
            for at in range(0, len(texts), ROWS_AT_ONCE):
                some = texts[at : at + ROWS_AT_ONCE]
                keep = np.array([has_letter(t) for t in some], dtype=bool)
                counts = counted([t for t, k in zip(some, keep) if k], dimensions)
                cells = [row.astype(np.min_scalar_type(int(row.max()))).tobytes() for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [langs.slice(at, len(some)).filter(pa.array(keep)), pa.array(cells, pa.binary())], names=["lang", "cells"]
                )

    return in_arrow(known, run, "lang string, cells binary")


def _counts(cells: list[bytes], dimensions: int) -> np.ndarray:
    return np.array([np.frombuffer(c, f"u{len(c) // dimensions}") for c in cells], dtype=np.float32)


def _slack(rows: DataFrame, weights: np.ndarray, sides: Mapping[str, np.ndarray]) -> np.ndarray:
    """Of each machine (a row of ``weights``, its bias last) the sums over all rows of the gradient
    of the squared hinge loss and, last, of the loss. ``sides`` has 1, -1 or 0 (no part) for
    each machine, by language."""
    many, dimensions = weights.shape[0], weights.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((many, dimensions + 2))
        for batch in text_slices(batches, "cells"):
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                x = scaled(_counts(some.column("cells").to_pylist(), dimensions))
                side = np.array([sides[lang] for lang in some.column("lang").to_pylist()])
                margin = x.astype(np.float64) @ weights[:, :-1].T + weights[:, -1]
                short = np.maximum(1 - side * margin, 0) * (side != 0)
                pull = -2 * side * short
                sums[:, :-2] += pull.T @ x
                sums[:, -2] += pull.sum(axis=0)
                sums[:, -1] += (short**2).sum(axis=0)
        whole = pa.array(np.rint(sums * FIXED_POINT).astype(np.int64).ravel())
        for at in range(0, len(whole), 1 << 16):
            part = whole.slice(at, 1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(part))), part], names=["place", "value"])

    out = np.zeros(many * (dimensions + 2))
    found = in_arrow(rows, run, "place bigint, value bigint").groupBy("place").agg(F.sum("value").alias("value"))
    table = found.toArrow()  # a number for each cell of each machine
    out[table.column("place").to_numpy()] = table.column("value").to_numpy() / FIXED_POINT
    return out.reshape(many, dimensions + 2)


def _downhill(slope: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """The direction of L-BFGS after steps ``moves`` that changed the gradient by ``turns``."""
    way, shares = -slope, []
    for s, y in zip(moves[::-1], turns[::-1]):
        shares.append(np.vdot(s, way) / np.vdot(s, y))
        way = way - shares[-1] * y
    way = way * (np.vdot(moves[-1], turns[-1]) / np.vdot(turns[-1], turns[-1]) if moves else 0.25)
    for s, y, share in zip(moves, turns, shares[::-1]):
        way = way + s * (share - np.vdot(y, way) / np.vdot(s, y))
    return way


def _machines(rows: DataFrame, sizes: Mapping[str, int], duels: list[tuple[str, set[str], str, set[str]]], dimensions: int) -> list[Pair]:
    """A linear support vector machine (squared hinge loss, L2 penalty) for each two named groups
    of languages, all fitted together on all rows."""
    if not duels:
        return []
    sides = {lang: np.array([(lang in a) - (lang in b) for _, a, _, b in duels], dtype=np.float64) for lang in sizes}
    n = sum(np.abs(sides[lang]) * size for lang, size in sizes.items())[:, None]

    def judged(weights: np.ndarray) -> tuple[float, np.ndarray]:
        sums = _slack(rows, weights, sides) / n
        plain = np.append(weights[:, :-1], np.zeros((len(duels), 1)), axis=1)  # a bias has no penalty
        return float(sums[:, -1].sum() + PENALTY / 2 * np.vdot(plain, plain)), sums[:, :-1] + PENALTY * plain

    weights = np.zeros((len(duels), dimensions + 1))
    loss, slope = judged(weights)
    moves: list[np.ndarray] = []
    turns: list[np.ndarray] = []
    step = 1.0
    for _ in range(STEPS):
        way = _downhill(slope, moves, turns) * step
        new_loss, new_slope = judged(weights + way)
        if new_loss > loss:
            step /= 4
            continue
        if np.vdot(way, new_slope - slope) > 0:
            moves, turns = [*moves[-9:], way], [*turns[-9:], new_slope - slope]
        gain, loss, weights, slope, step = loss - new_loss, new_loss, weights + way, new_slope, 1.0
        if gain <= ENOUGH * loss:
            break
    return [Pair(a, b, w[:-1].astype(np.float32), float(w[-1])) for (a, _, b, _), w in zip(duels, weights)]


def fit(
    docs: DataFrame,
    per_language: int | None = None,
    dimensions: int = DIMENSIONS,
    families: Mapping[str, str] = FAMILY_OF,
) -> Model:
    """Learn from all ``docs`` (doc_id, text, lang) outside the held-out ids, or from
    ``per_language`` of each language. Rows with a null id or lang and texts without a
    letter are not learned from. With a single language it is always predicted; with
    none, everything is ``und``."""
    rows = stored(described(_chosen(docs, per_language), dimensions), "language-counts")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # the learned languages
    members: dict[str, list[str]] = {}
    for lang in sorted(sizes):
        members.setdefault(families.get(lang, lang), []).append(lang)
    across = [(a, set(members[a]), b, set(members[b])) for a, b in combinations(sorted(members), 2)]
    within = [(a, {a}, b, {b}) for own in members.values() for a, b in combinations(own, 2)]
    pairs = _machines(rows, sizes, across + within, dimensions)
    inside = pairs[len(across) :]
    return Model(
        members,
        pairs[: len(across)],
        {name: [p for p in inside if p.first in own] for name, own in members.items()},
        dimensions,
    )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row.

    Null texts and texts without a letter are ``und`` with score 0; a null id is
    not held out. Repeated rows each keep a row.
    """
    divisor, held = HELD_OUT
    out = F.coalesce(remainder("doc_id", divisor) == held, F.lit(False))
    source = docs.select("doc_id", out.alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            names, scores = model.judge(as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return in_arrow(source, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def size_class(text: bytes) -> int:
    return min(len(text).bit_length(), SIZE_CLASSES)


def lowest(scores: DataFrame, share: float, least: int) -> dict[int, float]:
    """For each size with ``least`` or more rows of ``scores`` (size, score from 0 to 1) the exact
    percentile at ``share``, interpolated as Spark's is. Rows are counted by bins of the score;
    only those in the bins that hold the percentile are put in order."""
    bins = F.floor(F.col("score") * SCORE_BINS).cast("int")
    held: dict[int, dict[int, int]] = {}
    for r in scores.groupBy("size", bins.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():  # a row for each size and bin
        held.setdefault(r["size"], {})[r["bin"]] = r["n"]
    wanted = []
    for size, counts in held.items():
        n, before = sum(counts.values()), 0
        if n < least:
            continue
        place = share * (n - 1)
        low, high = int(np.floor(place)), int(np.ceil(place))
        for b in sorted(counts):
            for rank in {low, high}:
                if before <= rank < before + counts[b]:
                    wanted.append((size, b, rank - before, 1.0 if low == high else 1 - abs(place - rank)))
            before += counts[b]
    if not wanted:
        return {}
    asked = scores.sparkSession.createDataFrame(wanted, "size int, bin int, rank bigint, weight double")
    near = scores.withColumn("bin", bins).join(F.broadcast(asked.select("size", "bin").distinct()), ["size", "bin"])
    near = near.groupBy("size", "bin", "score").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("size", "bin").orderBy("score"))
    near = near.withColumn("upto", upto).join(F.broadcast(asked), ["size", "bin"])
    near = near.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    found = near.groupBy("size").agg(F.sum(F.col("score") * F.col("weight")).alias("least"))
    return {r["size"]: r["least"] for r in found.collect()}  # a row for each size


def limits(
    docs: DataFrame, model: Model, missed: float = MISSED, per_language: int | None = None
) -> dict[int, float]:
    """For each size of text (a power of two of bytes) a score, MARGIN below what all but
    a share ``missed`` of its held-out labelled texts reach that are judged right: what
    scores lower is not in a language that was learned. Measured on all held-out texts, or
    on ``per_language`` of each language; sizes with fewer than ``LEAST_MEASURED`` of them
    have no limit. Short texts say little, so their limits are low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = as_bytes(batch.column("text"))
            names, scores = model.judge(texts)
            right = pa.array([n == g for n, g in zip(names, batch.column("lang").to_pylist())], pa.bool_())
            sizes = pa.array([size_class(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([sizes, pa.array(scores, pa.float64()), right], names=["size", "score", "right"])

    judged = in_arrow(_chosen(docs, per_language, held_out=True), run, "size int, score double, right boolean")
    found = lowest(stored(judged.filter("right").select("size", "score"), "judged"), missed, LEAST_MEASURED)
    return {size: max(score - MARGIN, 0.0) for size, score in found.items()}


def keep_known(docs: DataFrame, model: Model, least: Mapping[int, float] | None = None) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or whose score is below the
    limit of their text's size."""
    least = dict(least or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = as_bytes(batch.column("text"))
            names, scores = model.judge(texts)
            good = [n != UNKNOWN and s >= least.get(size_class(t), 0.0) for t, n, s in zip(texts, names, scores)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return in_arrow(docs, run, docs.schema)
