"""Conversation structure repair by iterative-deepening A*.

A repaired conversation is empty, or a system turn where there is one and then
user and assistant in turn, ending with the assistant. Turns are edited in order:
Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or
assistant turn) 2; blank turns and repeated ones must be deleted, and a truncated
turn that is not deleted adds 1. The audit is the initials of the cheapest edits,
and of equally cheap ones the least in ASCII order.

``search`` tries edits depth first in the order D, I, K, R within a bound on the
cost, and raises the bound to the least cost that went beyond it. States that
failed keep the lower bound that their failure proved, across bounds, so none is
entered again before the bound allows it. The first path that ends is the answer.

Conversations are searched whole inside tasks. One that is too long for a task's
memory is cut into blocks. What a block costs between any two states, found by the
same search, is added up from the last block to the first; with that as the cost
of its end, each block finds its own part of the audit. An insertion belongs to
the turn after it, so no part is the beginning of another and the parts that come
first in ASCII order make the whole audit that does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import bounded, in_arrow, stored
from orelake.llm.sql import crc32

LONG_ROWS = 4_000  # conversations beyond either are cut into blocks
LONG_BYTES = 16 << 20
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20

NEVER = 1 << 60
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what has been written last
CLOSING = (0, 4, 2, 0)  # the cost of the turns inserted at the end
OTHER, TRUNCATED, FORCED = 3, 4, 8  # a turn is 0 s, 1 u, 2 a or 3 other, and flags
CLASS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"


def _takes(state: int, kind: int) -> bool:
    """Whether a turn of this kind may follow what was written last."""
    if kind == 0:
        return state == EMPTY
    return kind == (2 if state == USER else 1)


def _moves() -> list[list[list[tuple[str, int, int, int]]]]:
    """(edit, cost, turns passed, state after) by turn and state, in ASCII order."""
    table = []
    for code in range(16):
        kind, extra = code & 3, 1 if code & TRUNCATED else 0
        states = []
        for state in range(4):
            written = ASSISTANT if state == USER else USER
            moves = [("D", 3, 1, state), ("I", 2, 0, written)]
            if not code & FORCED:
                if _takes(state, kind):
                    moves.append(("K", extra, 1, kind + 1))
                moves.append(("R", 2 + extra, 1, written))
            states.append(moves)
        table.append(states)
    return table


MOVES = _moves()


def lower_bounds(turns: bytes, end: Sequence[int]) -> list[int]:
    """For each place and state a cost that no way to the end undercuts: 3 for each
    turn that must go, 1 for each truncated one, and 2 for each of the neighbours
    among the other turns that may not follow each other, as far as these pairs
    share no turn. The state stands before the turns, and the end after them."""
    least, n = min(end), len(turns)
    out = [0] * (4 * (n + 1))
    # Of the unforced turns after a place: the most disjoint bad pairs from the next
    # one on and from the one after it, and the next one's kind (-1: the end).
    here, later, kind, fixed = 0, 0, -1, least
    out[4 * n :] = list(end)
    for i in range(n - 1, -1, -1):
        code = turns[i]
        if code & FORCED:
            fixed += 3
        else:
            own = code & 3
            bad = end[own + 1] >= least + 2 if kind < 0 and own < OTHER else not (own < OTHER and kind >= 0 and _takes(own + 1, kind))
            here, later = max(here, later + bad), here
            kind = own
            fixed += 1 if code & TRUNCATED else 0
        for state in range(4):
            bad = end[state] >= least + 2 if kind < 0 else not _takes(state, kind)
            out[4 * i + state] = fixed + 2 * max(here, later + bad)
    return out


def search(turns: bytes, start: int, end: Sequence[int]) -> tuple[str, int, int]:
    """(audit, last state, cost without its end's) of the cheapest way from ``start``
    through all ``turns``, whose end in a state costs ``end``; some state that can be
    reached must have a finite cost."""
    last = 4 * len(turns)
    if not turns:
        return "", start, 0
    lower = lower_bounds(turns, end)
    while True:
        limit = lower[start]
        path: list[str] = []
        # node, spent, moves left, least cost found beyond the limit, cost of the move to it
        stack = [[start, 0, iter(MOVES[turns[0]][start]), NEVER, 0]]
        while stack:
            top = stack[-1]
            node, spent = top[0], top[1]
            for edit, cost, ahead, state in top[2]:
                child = (node & ~3) + 4 * ahead + state
                need = cost + lower[child]
                if spent + need > limit:
                    if need < top[3]:
                        top[3] = need
                    continue
                path.append(edit)
                if child >= last:
                    return "".join(path), state, spent + cost
                stack.append([child, spent + cost, iter(MOVES[turns[child >> 2]][state]), NEVER, cost])
                break
            else:
                if top[3] > lower[node]:
                    lower[node] = top[3]
                stack.pop()
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[3] = min(above[3], top[4] + lower[node])


def costs(turns: bytes) -> list[int]:
    """The least cost from each state through a block to each state, 16 numbers."""
    n = len(turns)
    gone = 3 * n
    kept = [1 if c & TRUNCATED else 0 for c in turns if not c & 3 and not c & FORCED]
    found = [[NEVER] * 4 for _ in range(4)]
    found[EMPTY][EMPTY] = found[SYSTEM][SYSTEM] = gone
    if kept:
        found[EMPTY][SYSTEM] = gone - 3 + min(kept)
    for start in range(4):
        for state in (USER, ASSISTANT):
            end = [NEVER] * 4
            end[state] = 0
            found[start][state] = search(turns, start, end)[2]
    return [c for row in found for c in row]


def closed(turns: bytes) -> tuple[str, int]:
    """(audit, cost) of a whole conversation."""
    audit, state, cost = search(turns, EMPTY, CLOSING)
    return audit + "I" * (CLOSING[state] // 2), cost + CLOSING[state]


def kinds(roles: list[str], texts: list[str], repeated: Iterable[bool] | None = None) -> tuple[bytes, list[str | None]]:
    """The turns' codes and first faults. A turn is repeated if its role and text
    were there before, or as told."""
    seen: set[tuple[str, str]] = set()
    codes, faults = bytearray(), []
    for role, text, again in zip(roles, texts, repeated or [None] * len(roles)):
        code, kept = CLASS.get(role[:1], OTHER), text.rstrip(BLANKS)
        if again is None:
            again = (role, text) in seen
            seen.add((role, text))
        fault = "blank" if not kept else "duplicate" if again else None if kept[-1] in ".!?" else "truncated"
        faults.append(fault)
        codes.append(code | (0 if fault is None else TRUNCATED if fault == "truncated" else FORCED))
    return bytes(codes), faults


def edited(audit: str, state: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The turns that an audit leaves."""
    out, at = [], 0
    for edit in audit:
        role, text = "assistant" if state == USER else "user", ""
        if edit != "I":
            text = texts[at]
            role = roles[at] if edit == "K" else role
            at += 1
        if edit != "D":
            out.append({"role": role, "text": text})
            state = CLASS.get(role[:1], OTHER) + 1
    return out


def _gaps(turns: Sequence[int | None]) -> int:
    known = sorted({t for t in turns if t is not None})
    return known[-1] - known[0] + 1 - len(known) if known else 0


def _illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in pairwise(initials))


_OUT = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("gaps", pa.int64()), ("blank", pa.int64()),
        ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
        ("audit", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ]
)
_OUT_DDL = (
    "conv_id bigint, block bigint, whole boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, turns array<struct<role: string, text: string>>"
)


def _batches(rows: Iterator[dict], schema: pa.Schema, weight: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most 1,000 and, where a list of turns has the bytes, about 4 MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(t["text"]) for t in row[weight]) if weight else 0
        if len(held) == 1_000 or size > BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _runs(rows: Iterator[dict], key: str) -> Iterator[list[dict]]:
    held: list[dict] = []
    for row in rows:
        if held and held[-1][key] != row[key]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _repair_whole(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(turns: list[dict]) -> dict:
            roles, texts = [t["role"] for t in turns], [t["text"] for t in turns]
            codes, faults = kinds(roles, texts)
            audit, cost = closed(codes)
            counts = {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
            return counts | {
                "conv_id": turns[0]["conv_id"], "block": 0, "whole": True, "gaps": _gaps([t["turn"] for t in turns]),
                "illegal": _illegal([r[:1] for r in roles]), "cost": cost, "audit": audit,
                "turns": edited(audit, EMPTY, roles, texts),
            }

        yield from _batches(map(one, _runs(_rows(batches), "conv_id")), _OUT, "turns")

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_arrow(dealt, run, _OUT_DDL)


_CUT = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("codes", pa.binary()), ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())), ("first", pa.int64()), ("last", pa.int64()), ("gaps", pa.int64()),
        ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ]
)
_CUT_DDL = (
    "conv_id bigint, block bigint, codes binary, roles array<string>, texts array<string>, first bigint, last bigint, "
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def _cut(rows: DataFrame, block_rows: int) -> DataFrame:
    """The blocks of sorted conversations, numbered in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32

        def blocks() -> Iterator[list[dict]]:
            held: list[dict] = []
            size = 0
            for row in _rows(batches):
                if held and (held[-1]["conv_id"] != row["conv_id"] or len(held) == block_rows or size > BLOCK_BYTES):
                    yield held
                    held, size = [], 0
                held.append(row)
                size += len(row["text"])
            if held:
                yield held

        for number, turns in enumerate(blocks()):
            roles, texts = [t["role"] for t in turns], [t["text"] for t in turns]
            codes, faults = kinds(roles, texts, [t["repeated"] for t in turns])
            known = [t["turn"] for t in turns if t["turn"] is not None]
            row = {f: faults.count(f) for f in ("blank", "duplicate", "truncated")} | {
                "conv_id": turns[0]["conv_id"], "block": part + number, "codes": codes, "roles": roles, "texts": texts,
                "first": known[0] if known else None, "last": known[-1] if known else None, "gaps": _gaps(known),
                "illegal": _illegal([r[:1] for r in roles]),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_CUT)

    return in_arrow(rows, run, _CUT_DDL)


def _per_conversation(df: DataFrame, back: bool, run, ddl: str) -> DataFrame:
    """One pass over the blocks of each conversation, in order or back from the last,
    that keeps a few numbers only."""
    block = F.col("block").desc() if back else F.col("block")
    return in_arrow(df.repartition("conv_id").sortWithinPartitions("conv_id", block), run, ddl)


def _tails(blocks: DataFrame) -> DataFrame:
    """(block, tail, final): what the rest of a conversation costs after a block, by state."""

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([costs(c) for c in b.column("codes").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), found], names=["conv_id", "block", "costs"])

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("tail", pa.list_(pa.int64())), ("final", pa.bool_())])

        def rows() -> Iterator[dict]:
            before: object = rows  # no conversation yet
            tail = list(CLOSING)
            for row in _rows(batches):
                final = row["conv_id"] != before
                before = row["conv_id"]
                tail = list(CLOSING) if final else tail
                yield {"block": row["block"], "tail": tail, "final": final}
                tail = [min(c + t for c, t in zip(row["costs"][4 * q : 4 * q + 4], tail)) for q in range(4)]
                tail = [min(t, NEVER) for t in tail]

        yield from _batches(rows(), schema)

    each = in_arrow(blocks.select("conv_id", "block", "codes"), matrix, "conv_id bigint, block bigint, costs array<bigint>")
    return stored(_per_conversation(each, True, backwards, "block bigint, tail array<bigint>, final boolean"), "tails")


def _parts(blocks: DataFrame) -> DataFrame:
    """(block, state, audit, cost, gap, bad): each block's part of the audit, the state
    it starts from, and what lies between it and the block before."""

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.select(["codes", "tail"]).to_pylist()
            found = [[search(r["codes"], q, r["tail"]) if min(r["tail"]) < NEVER else None for q in range(4)] for r in rows]
            arrays = [[[w[k] for w in ws] for ws in found] for k in range(3)]
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(a, pa.list_(t)) for a, t in zip(arrays, types)]
            ends = pa.array([[r[0][:1], r[-1][:1]] for r in b.column("roles").to_pylist()], pa.list_(pa.string()))
            kept = ["conv_id", "block", "first", "last", "final"]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in kept], ends, *arrays], names=[*kept, "ends", "audits", "states", "costs"])

    ways_ddl = (
        "conv_id bigint, block bigint, first bigint, last bigint, final boolean, ends array<string>, "
        "audits array<string>, states array<bigint>, costs array<bigint>"
    )

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("block", pa.int64()), ("state", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()),
             ("gap", pa.int64()), ("bad", pa.int64())]
        )

        def rows() -> Iterator[dict]:
            state, initial, turn, fresh = EMPTY, None, None, True
            for row in _rows(batches):
                if fresh:
                    state, initial, turn = EMPTY, None, None
                audit, after, cost = (row[k][state] for k in ("audits", "states", "costs"))
                if row["final"]:
                    audit, cost = audit + "I" * (CLOSING[after] // 2), cost + CLOSING[after]
                gap = 0 if turn is None or row["first"] is None else max(row["first"] - turn - 1, 0)
                bad = int(initial is not None and initial + row["ends"][0] not in LEGAL)
                yield {"block": row["block"], "state": state, "audit": audit, "cost": cost, "gap": gap, "bad": bad}
                state, initial, fresh = after, row["ends"][1], row["final"]
                turn = turn if row["last"] is None else row["last"]

        yield from _batches(rows(), schema)

    light = blocks.select("conv_id", "block", "codes", "roles", "first", "last").join(_tails(blocks), "block")
    parts_ddl = "block bigint, state bigint, audit string, cost bigint, gap bigint, bad bigint"
    return stored(_per_conversation(in_arrow(light, ways, ways_ddl), False, forwards, parts_ddl), "parts")


def _repair_long(rows: DataFrame, block_rows: int) -> DataFrame:
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "long")
    rows = rows.withColumn("content", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    first = rows.groupBy("conv_id", "content").agg(F.min(F.struct("turn", "row")).alias("earliest"))
    first = first.select(F.col("conv_id").alias("_conv_id"), F.col("content").alias("_content"), F.col("earliest.row").alias("_row"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("content") == F.col("_content"))
    known = rows.join(first, same).withColumn("repeated", F.col("row") != F.col("_row"))
    # Sorted ranges: the start of the text lets rows of one turn and role be cut too.
    known = known.select("conv_id", "turn", "role", "text", "row", "repeated").withColumn("start", F.substring("text", 1, 64))
    order = ("conv_id", "turn", "role", "start")
    blocks = stored(_cut(known.repartitionByRange(*order).sortWithinPartitions(*order, "text", "row"), block_rows), "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            out = {k: row[k] for k in ("conv_id", "block", "blank", "duplicate", "truncated", "cost", "audit")} | {
                "whole": False, "gaps": row["gaps"] + row["gap"], "illegal": row["illegal"] + row["bad"],
                "turns": edited(row["audit"], row["state"], row["roles"], row["texts"]),
            }
            yield pa.RecordBatch.from_pylist([out], schema=_OUT)

    return in_arrow(blocks.drop("codes", "first", "last").join(_parts(blocks), "block"), run, _OUT_DDL)


def repaired(turns: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repair the conversations of ``turns`` (conv_id, turn, role, text): one row for
    each, with the counts of first faults, gaps in the turn numbers, illegal
    neighbours, the cost and audit of its repair and the turns it leaves; several
    such rows, in order of ``block``, for a conversation that is too long for one.

    Turns stand in order of their number (null first), those with the same number in
    order of role and text; a null conv_id is a conversation like any other, a null
    role or text one space. The initial of a role decides; what is not s, u or a must
    be changed or deleted. Without rows there is no conversation."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    bytes_ = F.sum(F.octet_length("text") + F.octet_length("role") + 16)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), bytes_.alias("bytes"))
    is_long = (F.col("n") > long_rows) | (F.col("bytes") > long_bytes)
    found = stored(sizes.filter(is_long).select(F.col("conv_id").alias("_conv_id")), "sizes")
    if found.isEmpty():
        return _repair_whole(rows)
    found = bounded(found)
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    short, long = rows.join(found, same, "left_anti"), rows.join(found, same, "left_semi")
    return _repair_whole(short).unionByName(_repair_long(long, block_rows))


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(blocks: DataFrame) -> DataFrame:
    """One row per repaired conversation: its counts, cost, audit and the digest of its
    turns (``role:text``, a line feed between). The digest of a conversation in blocks
    passes through one task block by block, as its bytes must in turn."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = blocks.filter("whole").select("conv_id", *REPORT, "audit", F.sha2(text, 256).alias("repaired_sha256"))
    ddl = ", ".join(f"{c} bigint" for c in ("conv_id", *REPORT)) + ", audit string, repaired_sha256 string"
    schema = pa.schema([*[(c, pa.int64()) for c in ("conv_id", *REPORT)], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            total: dict | None = None
            for row in _rows(batches):
                if total is None or total["conv_id"] != row["conv_id"]:
                    if total is not None:
                        yield finished(total)
                    total = {"conv_id": row["conv_id"], "parts": [], "sha": hashlib.sha256(), "any": False} | dict.fromkeys(REPORT, 0)
                for c in REPORT:
                    total[c] += row[c]
                total["parts"].append(row["audit"])
                for turn in row["turns"]:
                    total["sha"].update(b"\n" * total["any"] + f"{turn['role']}:{turn['text']}".encode())
                    total["any"] = True
            if total is not None:
                yield finished(total)

        def finished(total: dict) -> dict:
            own = {c: total[c] for c in ("conv_id", *REPORT)}
            return own | {"audit": "".join(total["parts"]), "repaired_sha256": total["sha"].hexdigest()}

        yield from _batches(rows(), schema)

    parts = blocks.filter(~F.col("whole")).select("conv_id", "block", *REPORT, "audit", "turns")
    return whole.unionByName(_per_conversation(parts, False, run, ddl))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties
    its text, 2 removes its full stops and exclamation and question marks, 3 repeats
    it, 4 makes its role user. Nulls count as one space."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    text = F.when(draw == 1, "").when(draw == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    copies = F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.filter(draw != 0).select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"), copies.alias("copy")
    )


def audited(turns: DataFrame) -> DataFrame:
    """The report of the repair of every conversation of ``turns`` after damage, also
    of those that lost all their rows."""
    found = reports(repaired(damaged(turns))).withColumnRenamed("conv_id", "_conv_id")
    ids = turns.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in REPORT], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _oracle() -> str:
    blank = r"[\x20\x09-\x0D]"

    def add(way: str, cost: str, edits: str) -> str:
        """A way is its cost in nine digits and its edits, so that the least text is the best way."""
        return f"lpad((left({way}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({way}, 10) || '{edits}'"

    def free(way: str) -> str:
        """Null where the turn must be deleted."""
        return f"CASE WHEN NOT r.forced THEN {way} END"

    def kept(kind: str, way: str) -> str:
        return f"CASE WHEN NOT r.forced AND r.initial = '{kind}' THEN {add(way, 'r.extra', 'K')} END"

    # i_u, i_a: the best ways to these states after insertions before the turn
    i_u = f"least(w.u, {add('w.e', '2', 'I')}, {add('w.s', '2', 'I')}, {add('w.a', '2', 'I')})"
    i_a = f"least(w.a, {add('w.u', '2', 'I')}, {add('w.e', '4', 'II')}, {add('w.s', '4', 'II')})"
    from_ready = "least(i.e, i.s, i.a)"
    return f"""
    WITH RECURSIVE drawn AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            ({crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")}) % 20 AS k FROM conversations),
    rows_after AS (
        SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE k <> 0),
    numbered AS (
        SELECT conv_id, turn, role, text, left(role, 1) AS initial,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM rows_after),
    faulted AS (
        SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS previous,
            count(*) OVER (PARTITION BY conv_id) AS n,
            CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?]{blank}*$') THEN 'truncated' END AS fault FROM numbered),
    turns AS (
        SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS forced,
            CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra FROM faulted),
    ways(conv_id, pos, e, s, u, a) AS (
        SELECT DISTINCT conv_id, 0::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM turns
        UNION ALL
        SELECT conv_id, pos, e, s, u, a FROM (
            SELECT r.conv_id, r.pos, {add("i.e", "3", "D")} AS e,
                least({add("i.s", "3", "D")}, {kept("s", "i.e")}) AS s,
                least({add("i.u", "3", "D")}, {kept("u", from_ready)}, {free(add(from_ready, "2 + r.extra", "R"))}) AS u,
                least({add("i.a", "3", "D")}, {kept("a", "i.u")}, {free(add("i.u", "2 + r.extra", "R"))}) AS a
            FROM (SELECT w.conv_id, w.pos, w.e, w.s, {i_u} AS u, {i_a} AS a FROM ways w) i
            JOIN turns r ON r.conv_id IS NOT DISTINCT FROM i.conv_id AND r.pos = i.pos + 1)),
    best AS (
        SELECT w.conv_id, least(w.e, {add("w.s", "4", "II")}, {add("w.u", "2", "I")}, w.a) AS way
        FROM ways w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos AND t.pos = t.n),
    edits AS (
        SELECT conv_id, step, substr(way, 9 + step, 1) AS edit FROM (
            SELECT conv_id, way, unnest(range(1, length(way) - 8)) AS step FROM best)),
    passed AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY step) AS pos,
            count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY step) AS place FROM edits),
    written AS (
        SELECT p.conv_id, p.step, p.place, p.edit, t.role, CASE WHEN p.edit = 'I' THEN '' ELSE t.text END AS text,
            max(CASE WHEN p.place = 1 AND p.edit = 'K' AND t.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS shift
        FROM passed p LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.pos = p.pos AND p.edit <> 'I'
        WHERE p.edit <> 'D'),
    texts AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || text, chr(10) ORDER BY step) AS whole FROM written GROUP BY conv_id),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id)
    SELECT c.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate,
        coalesce(k.truncated, 0) AS truncated, coalesce(k.illegal, 0) AS illegal,
        coalesce(left(b.way, 9)::BIGINT, 0) AS cost, coalesce(substr(b.way, 10), '') AS audit,
        sha256(coalesce(t.whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    """


ORACLE = _oracle()
