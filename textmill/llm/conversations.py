"""Repair of conversation structure at least cost, by streaming over sorted turns.

A conversation's roles have to read `(s?(ua)+)?` by their initials. A row may be
kept, given another role, or deleted, and empty turns may be inserted, each at
its price; blank rows and repeats must go. Dynamic programming over the four
places of that pattern runs from the last turn to the first: rows are
repartitioned by conversation and sorted by turn, and a task carries four costs
from one Arrow batch to the next. For a row it keeps one byte: which edit each place
would choose, the ASCII-least of the cheapest. These bytes leave the task in blocks of
`BLOCK` rows, so a giant conversation never stays in memory; a block is sorted in
before its first row when the texts, which move only once, stream past from the
first turn to the last and take their edits.

One conversation is one task's work, as its digest runs over its turns in order;
that task's memory is a batch, a block and the string of edits.

Defined cases: null roles and texts count as one space; null turns come first;
rows of the same turn follow by role, then by a digest of the text; repeats are
told by role and a 128-bit digest of the text; rows of a null conversation are
one conversation; an empty table gives an empty table; extra columns pass by
unread.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import stage

RETYPE, DELETE, INSERT, CUT = 3, 4, 3, 3
BLOCK = 1 << 16

_BLANKS = " \t\n\x0b\x0c\r"
_INF = 1 << 40
# Places in the pattern: nothing yet, after s, after u, after a.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = {"s": 1, "u": 2, "a": 3}
# The only role of `user` and `assistant` that may follow at each place.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_EDITS = "DIKR"  # in ASCII order; a choice is a place in this string


# --- the steps of the dynamic programme -----------------------------------------------


def _follow(place: int, initial: int) -> int | None:
    """The place after a role's initial, if it may stand there."""
    if initial == 1:
        return _SYSTEM if place == _START else None
    return initial if initial and _NEXT[place] == initial else None


def _with_inserts(costs: list[int], choices: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs and packed choices when turns may be inserted before going on."""
    for _ in range(4):
        for place in range(4):
            other = INSERT + costs[_NEXT[place]]
            if other < costs[place] or (other == costs[place] and 1 < choices[place]):
                costs[place], choices[place] = other, 1
    return tuple(costs), sum(choice << 2 * place for place, choice in enumerate(choices))


END = _with_inserts([0, _INF, _INF, 0], [0] * 4)[0]


@cache
def step(costs: tuple[int, ...], initial: int, gone: bool, cut: bool) -> tuple[tuple[int, ...], int, int]:
    """Costs before a row, less their least, that least, and the choice of every place, from the costs after it."""
    new, choices = [], []
    for place in range(4):
        options = [(DELETE + costs[place], 0)]
        if not gone:
            end = _follow(place, initial)
            if end is not None:
                options.append((CUT * cut + costs[end], 2))
            options.append((RETYPE + CUT * cut + costs[_NEXT[place]], 3))
        cost, choice = min(options)
        new.append(cost)
        choices.append(choice)
    found, packed = _with_inserts(new, choices)
    least = min(found)
    return tuple(c - least for c in found), least, packed


# --- columns --------------------------------------------------------------------------


def _keyed(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with the columns they are sorted by."""
    named = F.col(conversation).cast("string")
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def _judged(rows: DataFrame) -> DataFrame:
    """A narrow row a turn: the initial and the first fault."""
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv", "turn", "role", "digest",
        F.coalesce(*[F.when(initial == k, v) for k, v in _INITIALS.items()], F.lit(0)).alias("initial"),
        (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"),
    ).repartition("conv")
    earlier = Window.partitionBy("conv", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    nth = narrow.withColumn("nth", F.row_number().over(earlier))
    fault = F.when(F.col("blank"), 1).when(F.col("nth") > 1, 2).when(F.col("open"), 3).otherwise(0)
    return nth.withColumn("fault", fault).drop("blank", "open")


def _order(down: bool = False) -> list[Column]:
    turn = F.col("turn")
    return [turn.desc_nulls_last() if down else turn.asc_nulls_first()] + [
        F.desc(c) if down else F.asc(c) for c in ("role", "digest")
    ]


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLANNED = (
    "conv string, kind int, turn bigint, role string, digest binary, number bigint, edits binary, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
)
_PLANNED = pa.schema([
    ("conv", pa.string()), ("kind", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()),
    ("number", pa.int64()), ("edits", pa.binary()), *((c, pa.int64()) for c in COUNTS),
])


class _Plan:
    """What is carried through one conversation, from its last turn to its first."""

    def __init__(self, conv: str):
        self.conv = conv
        self.costs, self.cost = END, 0
        self.edits = bytearray()
        self.blocks = 0
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.high = self.low = self.after = None

    def row(self, turn: int | None, initial: int, fault: int) -> None:
        self.costs, more, packed = step(self.costs, initial, fault in (1, 2), fault == 3)
        self.cost += more
        self.edits.append(packed)
        self.faults[fault] += 1
        if self.after is not None and (initial, self.after) not in ((1, 2), (2, 3), (3, 2)):
            self.illegal += 1
        self.after = initial
        if turn is not None:
            self.turns += turn != self.low
            self.high = turn if self.high is None else self.high
            self.low = turn

    def block(self, keys: list[pa.Array], at: int) -> dict:
        """The edits since the last block, which begin with the row at that place of the columns."""
        turn, role, digest = (column[at].as_py() for column in keys)
        # Blocks are numbered from the last turn: the first one has the least number.
        self.blocks -= 1
        out = {"conv": self.conv, "kind": 1, "turn": turn, "role": role, "digest": digest, "number": self.blocks,
               "edits": bytes(self.edits[::-1])}
        self.edits.clear()
        return out

    def summary(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        values = (gaps, *self.faults[1:], self.illegal, self.cost + self.costs[_START])
        return {"conv": self.conv, "kind": 0, "number": 0, **dict(zip(COUNTS, values))}


def _plans(block: int) -> Callable:
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Plan | None = None
        last: tuple = ()
        out: list[dict] = []
        size = 0

        def close() -> None:
            if current is not None:
                if current.edits:
                    out.append(current.block(*last))
                out.append(current.summary())

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("conv", "turn", "initial", "fault")]
            keys = [batch.column(batch.schema.get_field_index(n)) for n in ("turn", "role", "digest")]
            for at, (conv, turn, initial, fault) in enumerate(zip(*(c.to_pylist() for c in columns))):
                if current is None or conv != current.conv:
                    close()
                    current = _Plan(conv)
                current.row(turn, initial, fault)
                last = (keys, at)
                if len(current.edits) == block:
                    out.append(current.block(*last))
                    size += block
                if size > 1 << 22 or len(out) >= 10000:
                    yield pa.RecordBatch.from_pylist(out, _PLANNED)
                    out.clear()
                    size = 0
        close()
        yield pa.RecordBatch.from_pylist(out, _PLANNED)

    return plan


# --- texts take their edits -----------------------------------------------------------


class _Walk:
    """One conversation from its first turn to its last: edits are taken, texts pass by."""

    def __init__(self, conv: str):
        self.conv = conv
        self.counts: dict | None = None
        self.blocks: deque[tuple[bytes, int]] = deque()
        self.place = _START
        self.audit = bytearray()

    def next(self) -> int:
        """The packed choices for the next row."""
        edits, at = self.blocks[0]
        if at + 1 < len(edits):
            self.blocks[0] = (edits, at + 1)
        else:
            self.blocks.popleft()
        return edits[at]

    def _insert(self) -> str:
        self.place = _NEXT[self.place]
        self.audit.append(ord("I"))
        return _ROLES[self.place]

    def row(self, role: str) -> Iterator[tuple[str, str | None]]:
        """Inserted roles with None, then the row's own role with its edit, if it stays."""
        packed = self.next()
        while (choice := packed >> 2 * self.place & 3) == 1:
            yield self._insert(), None
        self.audit.append(ord(_EDITS[choice]))
        if choice == 2:
            self.place = _INITIALS[role[:1]]
            yield role, "K"
        elif choice == 3:
            self.place = _NEXT[self.place]
            yield _ROLES[self.place], "R"

    def end(self) -> Iterator[tuple[str, str | None]]:
        while self.place in (_SYSTEM, _USER):
            yield self._insert(), None


SUMMARY = ", ".join(["conv string", *(f"{c} bigint" for c in COUNTS), "audit string", "repaired_sha256 string"])
TURNS = "conv string, place bigint, edit string, role string, text string"


def _walk(batches: Iterator[pa.RecordBatch], start: Callable, turn: Callable, finish: Callable) -> Iterator:
    """Call back for every conversation's start, repaired turn and end; yields between batches."""
    walk: _Walk | None = None

    def close() -> None:
        if walk is not None:
            for role, _ in walk.end():
                turn(walk, role, "", "I")
            finish(walk)

    for batch in batches:
        columns = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
        rows = zip(*(columns[n].to_pylist() for n in ("conv", "kind", "role", "text")))
        for at, (conv, kind, role, text) in enumerate(rows):
            if walk is None or conv != walk.conv:
                close()
                walk = _Walk(conv)
                start(walk)
            if kind == 0:
                walk.counts = {c: columns[c][at].as_py() for c in COUNTS}
            elif kind == 1:
                walk.blocks.append((columns["edits"][at].as_py(), 0))
            else:
                for given, edit in walk.row(role):
                    turn(walk, given, "" if edit is None else text, edit or "I")
        yield
    close()
    yield


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv", pa.string()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ])
    out: list[dict] = []
    state: dict = {}

    def start(walk: _Walk) -> None:
        state.update(sha=hashlib.sha256(), first=True)

    def turn(walk: _Walk, role: str, text: str, edit: str) -> None:
        line = f"{role}:{text}" if state["first"] else f"\n{role}:{text}"
        state["first"] = False
        state["sha"].update(line.encode())

    def finish(walk: _Walk) -> None:
        out.append({"conv": walk.conv, **walk.counts, "audit": walk.audit.decode(), "repaired_sha256": state["sha"].hexdigest()})

    for _ in _walk(batches, start, turn, finish):
        yield pa.RecordBatch.from_pylist(out, schema)
        out.clear()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", pa.string()), ("place", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text"))])
    out: list[dict] = []
    state = {"place": 0}

    def start(walk: _Walk) -> None:
        state["place"] = 0

    def turn(walk: _Walk, role: str, text: str, edit: str) -> None:
        out.append({"conv": walk.conv, "place": state["place"], "edit": edit, "role": role, "text": text})
        state["place"] += 1

    for _ in _walk(batches, start, turn, lambda walk: None):
        yield pa.RecordBatch.from_pylist(out, schema)
        out.clear()


def _edited(df: DataFrame, columns: tuple[str, str, str, str], work: Callable, schema: str, block: int) -> DataFrame:
    rows = _keyed(df, *columns)
    # Rows alike in all are told apart by which of them comes first.
    falling = _judged(rows).sortWithinPartitions("conv", *_order(down=True), F.desc("nth"))
    planned = stage(falling.mapInArrow(_plans(block), PLANNED), "edits")
    head = (F.col("kind") > 0).cast("int")
    # The summary first, then each block before its first row.
    both = planned.unionByName(rows.withColumns({"kind": F.lit(2), "number": F.lit(0)}), allowMissingColumns=True)
    streamed = both.repartition("conv").sortWithinPartitions("conv", head, *_order(), "kind", "number")
    return streamed.mapInArrow(work, schema)


def _back(found: DataFrame, df: DataFrame, conversation: str) -> DataFrame:
    """The conversation's own value in place of its name as text."""
    kind = df.schema[conversation].dataType
    value = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind)
    return found.select(value.alias(conversation), *[c for c in found.columns if c != "conv"])


def repair(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """A row a conversation: its faults, the cost and kinds of its edits, the digest of its repaired turns."""
    columns = (conversation, turn, role, text)
    return _back(_edited(df, columns, _summaries, SUMMARY, block), df, conversation)


def repaired_turns(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """`conversation, place, edit, role, text`: the turns that stay or were inserted, in order from 0."""
    columns = (conversation, turn, role, text)
    return _back(_edited(df, columns, _turns, TURNS, block), df, conversation)


def damage(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, by the checksum of `conversation:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3
    repeats it, 4 makes its role `user`. Nulls are written as one space.
    """
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conversation, turn, role, text)}
    fault = F.crc32(F.concat(spaced[conversation], F.lit(":"), spaced[turn]).cast("binary")) % 20
    rows = df.select(
        conversation, turn, spaced[role].alias(role), spaced[text].alias(text), fault.alias("_fault")
    ).filter("_fault <> 0")
    damaged = {
        text: F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)),
        role: F.when(F.col("_fault") == 4, "user").otherwise(F.col(role)),
        "_copy": F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    }
    return rows.withColumns(damaged).drop("_fault", "_copy")
