"""Repair of the order of speakers in conversations by generalised LR parsing.

The roles of a sound conversation follow the grammar ``C -> nothing | D``, ``D -> u a | s u a | D u a`` (initials of
system, user, assistant).  Its LR automaton reads the turns; at every turn each stack may delete it, keep it, give it
another role, or first read an inserted turn.  The stacks of all edit sequences live in one graph-structured stack:
vertices are interned, so equal stacks are one vertex, and of two edit sequences that reach the same vertex only the
smaller (cost, audit) goes on.  No stack is deeper than four vertices, so a turn costs a constant.

* Audits are compared without being read: live ones end in the edit of the same turn, hence none is a prefix of another
  and their order never changes when both grow.  A rank per vertex and the new letters are enough.
* Before one turn at most one insertion is tried: two insertions next to each other in the result can both be left out
  (10 less), or the system turn before them deleted (8 less).  Insertions before a deleted turn are never tried: after it
  they cost the same and give a smaller audit.
* A vertex that costs over ``REACH`` more than another cannot win: two insertions turn any stack into any other.

Distribution: rows are marked first (a text said before in its conversation: one partially aggregated minimum per text and
conversation), then partitioned by conversation and sorted, and a task reads them as a stream.  It holds the live
vertices and the audit (a byte a turn and vertex, in blocks), never the turns, so a conversation of a third of all rows
needs little memory.  It is one stream all the same: an audit, as the digest of a conversation, is read from front to back.

Odd input: a null role or text is one space; a null ``conv_id`` is a conversation like any other; null turns come
first; rows of one turn are in the order of role and text, so equal rows stand together; a conversation without rows left
is reported with zeros; very long texts are passed through; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType, StringType

from rulegrid.llm.shared import stored

# What an edit costs.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
NAMES = {"s": "system", "u": "user", "a": "assistant"}

# The automaton.  States: 0 start, 1 s, 2 u, 3 s u, 4 u a, 5 s u a, 6 D, 7 D u, 8 D u a.
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 3}, 2: {"a": 4}, 3: {"a": 5}, 6: {"u": 7}, 7: {"a": 8}}
REDUCE = {4: 2, 5: 3, 8: 3}  # vertices that the rule of D takes off
GOTO_D = {0: 6}
ACCEPT = {0, 6}

REACH = 2 * INSERT
BLOCK = 4096  # turns after which the letters of the live audits are put together
SPACE = " \t\n\x0b\x0c\r"


class Vertex:
    """A state on top of another vertex; equal stacks are one vertex."""

    def __init__(self, state: int, below: Vertex | None = None):
        self.state, self.below = state, below
        self.above: dict[int, Vertex] = {}
        self.known: dict = {}

    def push(self, state: int) -> Vertex:
        if state not in self.above:
            self.above[state] = Vertex(state, self)
        return self.above[state]

    def read(self, initial: str) -> Vertex | None:
        """The stack after ``initial``: its shift and the reductions that follow."""
        state = SHIFT.get(self.state, {}).get(initial)
        if state is None:
            return None
        top = self.push(state)
        while top.state in REDUCE:
            for _ in range(REDUCE[top.state]):
                top = top.below
            top = top.push(GOTO_D[top.state])
        return top

    def edits(self, initial: str, cut_off: bool) -> list[tuple[Vertex, int, str]]:
        """``(stack, cost, letters)`` for every way to take one turn, perhaps after an insertion."""
        key = (initial, cut_off)
        if key not in self.known:
            out = [(self, DELETE, "D")]
            starts = [(self, 0, "")] + [(v, INSERT, "I") for v in map(self.read, "ua") if v]
            for start, cost, letters in starts:
                for wanted in "sua":
                    top = start.read(wanted)
                    if top and wanted == initial:
                        out.append((top, cost + CUT_OFF * cut_off, letters + "K"))
                    elif top and wanted in "ua":
                        out.append((top, cost + REROLE + CUT_OFF * cut_off, letters + "R"))
            self.known[key] = out
        return self.known[key]


ROOT = Vertex(0)


class Parse:
    """The live vertices of one conversation: for each its cost, the rank of its audit and the audit's parts."""

    def __init__(self):
        self.live = {ROOT: (0, 0, ())}
        self.turns = 0

    def must_delete(self) -> None:
        self.live = {v: (cost + DELETE, rank, (audit, "D")) for v, (cost, rank, audit) in self.live.items()}
        self._count()

    def take(self, initial: str, cut_off: bool) -> None:
        best: dict[Vertex, tuple] = {}
        for vertex, (cost, rank, audit) in self.live.items():
            for top, more, letters in vertex.edits(initial, cut_off):
                new = (cost + more, rank, letters, audit)
                if top not in best or new[:3] < best[top][:3]:
                    best[top] = new
        reach = min(x[0] for x in best.values()) + REACH
        kept = sorted(((rank, letters, cost, v, audit) for v, (cost, rank, letters, audit) in best.items() if cost <= reach), key=lambda x: x[:2])
        self.live = {v: (cost, i, (audit, letters)) for i, (_, letters, cost, v, audit) in enumerate(kept)}
        self._count()

    def _count(self) -> None:
        self.turns += 1
        if self.turns % BLOCK == 0:
            self.live = {v: (cost, rank, (None, _text(audit))) for v, (cost, rank, audit) in self.live.items()}

    def result(self) -> tuple[int, str]:
        """The smallest (cost, audit) of an accepted conversation."""
        ends = [(cost, rank, "", audit) for v, (cost, rank, audit) in self.live.items() if v.state in ACCEPT]
        for v, (cost, rank, audit) in self.live.items():
            after = v.read("a")
            if after and after.state in ACCEPT:
                ends.append((cost + INSERT, rank, "I", audit))
        cost, _, letters, audit = min(ends, key=lambda x: x[:3])
        return cost, _text(audit) + letters


def _text(audit: tuple | None) -> str:
    parts = []
    while audit:
        audit, letters = audit
        parts.append(letters)
    return "".join(reversed(parts))


def repaired_roles(audit: str, roles: Iterator[str]) -> Iterator[tuple[str, str, bool]]:
    """``(edit, role, kept)`` of each turn of the result and each deleted one, in order."""
    top = ROOT
    for edit in audit:
        if edit == "D":
            next(roles)
            yield edit, "", False
            continue
        role = next(roles) if edit in "KR" else ""
        initial = role[:1] if edit == "K" else next(iter(c for c in "ua" if top.read(c)))
        top = top.read(initial)
        yield edit, role if edit == "K" else NAMES[initial], True


def marked(turns: DataFrame, n: str | None = None) -> DataFrame:
    """``turns (conv_id, turn, role, text)`` with ``copies``, ``blank``, ``cut_off`` and ``again`` (same role and text at an earlier turn).

    ``n`` names a column that says how often a row stands there (0: not at all); without it every row does once.
    """
    own = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.col(n) if n else F.lit(1)).cast("long").alias("copies"),
    )
    body = F.rtrim("text", F.lit(SPACE))
    identity = [F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), F.concat("role", "text")]
    own = own.withColumns(
        {
            "blank": body == "",
            "cut_off": ~F.right(body, F.lit(1)).isin(".", "!", "?"),
            "said": F.unhex(F.sha2(F.concat_ws(":", *identity), 256)),
            "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn"),
        }
    )
    texts = own.where("copies > 0").groupBy("said").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    repeated = texts.where("first <> last or (first.known <> last.known)").select("said", "first")
    joined = own.join(repeated, "said", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("at"))
    return joined.select("conv_id", "turn", "role", "text", "copies", "blank", "cut_off", again.alias("again"))


def _columns(turns: DataFrame, more: list[StructField]) -> StructType:
    return StructType([StructField("conv_id", turns.schema["conv_id"].dataType), *more])


_FAULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(_FAULTS, 0)
        self.parse = Parse()
        self.before = None  # the row before: turn, role, text
        self.low = self.high = None
        self.distinct = 0

    def row(self, turn, role, text, copies, blank, cut_off, again) -> None:
        initial = role[:1]
        if self.before and (self.before[1][:1], initial) not in _LEGAL:
            self.counts["illegal"] += 1
        if copies > 1 and (initial, initial) not in _LEGAL:
            self.counts["illegal"] += copies - 1
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.distinct += turn != self.high
            self.high = turn
        same = self.before == (turn, role, text)
        for i in range(copies):
            fault = "blank" if blank else "duplicate" if again or same or i else "truncated" if cut_off else None
            if fault:
                self.counts[fault] += 1
            if fault in ("blank", "duplicate"):
                self.parse.must_delete()
            else:
                self.parse.take(initial, cut_off)
        self.before = (turn, role, text)

    def result(self) -> list:
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.distinct
        self.counts["cost"], audit = self.parse.result()
        return [self.conv_id, *self.counts.values(), audit]


def _plan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    now = None
    for batch in batches:
        for conv_id, turn, role, text, copies, *facts in zip(*(batch[i].to_pylist() for i in range(batch.num_columns))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.result()
                now = _Conversation(conv_id)
            if copies:
                now.row(turn, role, text, copies, *facts)
    if now is not None:
        yield now.result()


def _in_batches(rows: Iterator[list], names: list[str], kinds: list[pa.DataType], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``size`` characters."""
    held: list[list] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += 32 + sum(len(x) for x in row if isinstance(x, str))
        if chars > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _over(rows_of: Callable, schema: StructType) -> Callable:
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = iter(batches)
        first = next(held, None)
        if first is None:
            return
        more = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string()}
        kinds = [first.schema.field("conv_id").type, *(more[f.dataType.simpleString()] for f in schema.fields[1:])]

        def every():
            yield first
            yield from held

        yield from _in_batches(rows_of(every()), names, kinds)

    return run


def repair_plans(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of every conversation of ``marked`` rows."""
    schema = _columns(rows, [*(StructField(c, LongType()) for c in _FAULTS), StructField("audit", StringType())])
    return _sorted(rows).mapInArrow(_over(_plan_rows, schema), schema)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    now, edits, waiting, place = object(), iter(()), [], 0

    def until_row() -> Iterator[list]:
        """The result's turns up to and with the next one that takes a row."""
        nonlocal place
        for edit, role, kept in edits:
            if edit == "I":
                yield [now, place, edit, role, ""]
                place += 1
                continue
            text = waiting.pop()
            if kept:
                yield [now, place, edit, role, text]
                place += 1
            return

    roles: list[str] = []
    for batch in batches:
        for conv_id, turn, role, text, copies, audit in zip(*(batch[i].to_pylist() for i in range(batch.num_columns))):
            if audit is not None:
                yield from until_row()  # insertions after the last row
                now, place = conv_id, 0
                edits = repaired_roles(audit, iter(roles.pop, object()))
                continue
            for _ in range(copies):
                roles.append(role)
                waiting.append(text)
                yield from until_row()
    yield from until_row()


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the conversations of ``marked`` rows after the edits of their ``plans``.

    The rows of a conversation stand together and in order in one partition, which ``digests`` relies on.
    """
    plain = rows.where("copies > 0").select("conv_id", "turn", "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    none = F.lit(None)
    heads = plans.select("conv_id", none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), "audit")
    schema = _columns(rows, [StructField("place", LongType()), *(StructField(c, StringType()) for c in ("edit", "role", "text"))])
    both = heads.unionByName(plain)
    return _sorted(both.withColumn("last", F.col("audit").isNull()), "last").drop("last").mapInArrow(_over(_repaired, schema), schema)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    now = None
    for batch in batches:
        for conv_id, place, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "place", "role", "text"))):
            if place == 0:
                if now:
                    yield [now[0], now[1].hexdigest()]
                now = (conv_id, hashlib.sha256())
            else:
                now[1].update(b"\n")
            now[1].update(f"{role}:{text}".encode())
    if now:
        yield [now[0], now[1].hexdigest()]


def digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of the turns of ``repaired_turns``, as ``role:text`` lines, hashed turn by turn."""
    schema = _columns(repaired, [StructField("repaired_sha256", StringType())])
    return repaired.mapInArrow(_over(_digest_rows, schema), schema)


def repair(turns: DataFrame, n: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The plans and the repaired turns of conversations (``marked`` explains ``n``)."""
    rows = stored(marked(turns, n), "repair-rows")
    plans = stored(repair_plans(rows), "repair-plans")
    return plans, repaired_turns(rows, plans)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` damaged by the checksum of conversation and turn, with ``copies``: 0 where a row was dropped, 2 where it was repeated."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
