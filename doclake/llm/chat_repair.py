"""Conversation structure repair by secondary-sorted streaming.

Turns are dealt out by conversation and sorted by turn; Python tasks then stream over the sorted rows and hold no
conversation, only the state of the one they are in:

1. Backwards through the turns, a dynamic programme over the four states of the pattern ``(s?(ua)+)?`` keeps the least
   cost to finish from each state. Every row leaves with its backpointers: the best edits from each state, two bytes.
2. The same rows are sorted forwards within their partitions. Spark's external sort holds the backpointers meanwhile
   and spills them, so a giant conversation needs no memory of its own. The second stream follows the pointers from the
   start state and gives the edits.

Edits: keep (0), change the role to user or assistant (2), delete (3; a must for blank and repeated turns), insert a
turn without text (2); a truncated turn that stays costs 1. Of the cheapest edit sequences the one whose letters
``D I K R`` are least in ASCII wins. Letters determine states, and each edit of a row ends with a letter other than
``I``, so comparing the edits of one row is enough.

Defined cases: null roles and texts count as one space; turns go in order, nulls first, ties by role, then text, in byte
order; the null conversation is a conversation of its own; repeated rows are duplicates of the first; the initial of an
empty role is no legal one; an empty table gives an empty result; further columns are ignored. Texts of any length are
held one at a time. A conversation is streamed by one task, whatever its length: the hash over its repaired text runs
from its first to its last turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
KEEP, REROLE, DELETE, INSERT, LATE = 0, 2, 3, 2, 1
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = range(4)
#: Next state by initial; what is missing is illegal.
STEP = [
    {"s": AFTER_SYSTEM, "u": AFTER_USER}, {"u": AFTER_USER}, {"a": AFTER_ASSISTANT}, {"u": AFTER_USER},
]
#: What may be inserted, or a role changed to, in each state.
FILL = ["user", "user", "assistant", "user"]
MAX_INSERTS = 3  # one more would come back to a state already seen


def _ways(initial: str, forced: bool, truncated: bool) -> list[list[tuple[str, int, int]]]:
    """Per state: ``(letters, cost, next state)`` of every way to deal with one row, letters ascending."""
    out = []
    for state in STATES:
        ways, at, letters, cost = [], state, "", 0
        for _ in range(MAX_INSERTS + 1):
            ways.append((letters + "D", cost + DELETE, at))
            if not forced:
                late = LATE if truncated else 0
                if initial in STEP[at]:
                    ways.append((letters + "K", cost + KEEP + late, STEP[at][initial]))
                ways.append((letters + "R", cost + REROLE + late, STEP[at][FILL[at][0]]))
            at, letters, cost = STEP[at][FILL[at][0]], letters + "I", cost + INSERT
        out.append(sorted(ways))
    return out


def _ends() -> list[tuple[str, int]]:
    """Per state: the insertions that complete the pattern, and their cost."""
    out = []
    for state in STATES:
        letters, at = "", state
        while at not in (START, AFTER_ASSISTANT):
            letters, at = letters + "I", STEP[at][FILL[at][0]]
        out.append((letters, INSERT * len(letters)))
    return out


CLASSES = [(i, forced, late) for i in ("s", "u", "a", "") for forced in (False, True) for late in (False, True)]
WAYS = [_ways(*c) for c in CLASSES]
ENDS = _ends()


def row_class(initial: str, fault: str | None) -> int:
    return CLASSES.index((initial if initial in ("s", "u", "a") else "", fault in (BLANK, DUPLICATE), fault == TRUNCATED))


def relax(to_go: list[int], cls: int) -> tuple[list[int], int]:
    """Least cost from each state through one more (earlier) row, and the ways taken, four bits a state."""
    before, packed = [], 0
    for state, ways in enumerate(WAYS[cls]):
        best, choice = None, 0
        for i, (_, cost, to) in enumerate(ways):
            total = cost + to_go[to]
            if best is None or total < best:  # the first of equals: its letters are least
                best, choice = total, i
        before.append(best)
        packed |= choice << (4 * state)
    return before, packed


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each conversation, last turn first, with their backpointers."""
    held, to_go = None, None
    for batch in batches:
        packed = []
        for group, cls in zip(batch.column("conv").to_pylist(), batch.column("cls").to_pylist()):
            if to_go is None or group != held:
                held, to_go = group, [cost for _, cost in ENDS]
            to_go, choices = relax(to_go, cls)
            packed.append(choices)
        yield batch.append_column("ways", pa.array(packed, pa.int32()))


EDITS = (
    "conv string, conv_id long, turn long, edit string, fault string, role_before string, role string, text string, cost long"
)
_EDIT_ARROW = pa.schema([
    ("conv", pa.string()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("fault", pa.string()),
    ("role_before", pa.string()), ("role", pa.string()), ("text", pa.string()), ("cost", pa.int64()),
])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation in order."""
    held, state, conv_id = None, None, None

    def ending() -> list[tuple]:
        rows, at = [], state
        for _ in ENDS[state][0]:
            rows.append((held, conv_id, None, "I", None, None, FILL[at], "", INSERT))
            at = STEP[at][FILL[at][0]]
        return rows

    for batch in batches:
        out = []
        names = ("conv", "conv_id", "turn", "role", "text", "fault", "cls", "ways")
        for conv, cid, turn, role, text, fault, cls, ways in zip(*(batch.column(c).to_pylist() for c in names)):
            if state is None or conv != held:
                if state is not None:
                    out.extend(ending())
                held, state, conv_id = conv, START, cid
            letters, _, to = WAYS[cls][state][ways >> (4 * state) & 15]
            at = state
            for _ in letters[:-1]:
                out.append((conv, cid, None, "I", None, None, FILL[at], "", INSERT))
                at = STEP[at][FILL[at][0]]
            last = letters[-1]
            late = LATE if fault == TRUNCATED else 0
            cost = DELETE if last == "D" else (KEEP if last == "K" else REROLE) + late
            after = None if last == "D" else role if last == "K" else FILL[at]
            out.append((conv, cid, turn, last, fault, role, after, text, cost))
            state = to
        if out:
            yield _edit_batch(out)
    if state is not None and ending():
        yield _edit_batch(ending())


def _edit_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _EDIT_ARROW)], schema=_EDIT_ARROW)


def _fault(text: Column, copy: Column) -> Column:
    solid = r"[^\x20\x09-\x0D]"
    return (
        F.when(~text.rlike(solid), BLANK).when(copy > 1, DUPLICATE)
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
    )


def repair(turns: DataFrame) -> DataFrame:
    """The edits of every conversation of ``conv_id, turn, role, text`` rows, a conversation's edits in order and in one
    partition: ``conv, conv_id, turn, edit, fault, role_before, role, text, cost``.

    ``conv`` is the conversation's name (its identifier as text; empty for null). ``role`` and ``text`` of the rows whose
    edit is not ``D`` are the repaired conversation; inserted rows have no ``turn`` and no ``role_before``.
    """
    space = F.lit(" ")
    own = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    ).repartition("conv")
    same = Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    faulty = own.withColumn("copy", F.row_number().over(same)).withColumn("fault", _fault(F.col("text"), F.col("copy")))
    first = F.substring("role", 1, 1)
    number = F.lit(0)
    for i, (initial, forced, late) in enumerate(CLASSES):
        is_first = first == initial if initial else ~first.isin("s", "u", "a")
        is_forced = F.coalesce(F.col("fault").isin(BLANK, DUPLICATE), F.lit(False)) == forced
        is_late = F.col("fault").eqNullSafe(TRUNCATED) == late
        number = F.when(is_first & is_forced & is_late, i).otherwise(number)
    classed = faulty.withColumn("cls", number)
    order = ["turn", "role", "text", "copy"]
    last_first = classed.sortWithinPartitions("conv", *(F.col(c).desc_nulls_last() for c in order))
    pointed = map_arrow(
        last_first, _backward,
        "conv string, conv_id long, turn long, role string, text string, copy int, fault string, cls int, ways int",
    )
    return map_arrow(pointed.sortWithinPartitions("conv", *(F.col(c).asc_nulls_first() for c in order)), _forward, EDITS)


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
LEGAL = {"su", "ua", "au"}


class _Report:
    """What is told of one conversation, gathered edit by edit."""

    def __init__(self, conv: str, conv_id: int | None):
        self.conv, self.conv_id = conv, conv_id
        self.low = self.high = None
        self.turns = self.cost = self.illegal = 0
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.audit: list[str] = []
        self.before = None
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, turn, edit, fault, role_before, role, text, cost) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None and turn != self.high:
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            if fault is not None:
                self.faults[fault] += 1
            if self.before is not None:
                self.illegal += self.before[:1] + role_before[:1] not in LEGAL
            self.before = role_before
        if edit != "D":
            self.hash.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (
            self.conv_id, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
            "".join(self.audit), self.hash.hexdigest(),
        )


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    names = ("conv", "conv_id", "turn", "edit", "fault", "role_before", "role", "text", "cost")
    for batch in batches:
        out = []
        for conv, conv_id, *edit in zip(*(batch.column(c).to_pylist() for c in names)):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row())
                now = _Report(conv, conv_id)
            now.add(*edit)
        if out:
            yield _report_batch(out)
    if now is not None:
        yield _report_batch([now.row()])


def _report_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in REPORT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation of what ``repair`` returns, as it returns it: faults, cost, the edits' letters, and the
    hash of the repaired ``role:text`` lines."""
    return map_arrow(edits, _reports, REPORT)


def damaged(turns: DataFrame) -> DataFrame:
    """A stated rule of harm, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a turn, 1 empties its text, 2 takes its
    sentence marks, 3 logs it twice, 4 makes it the user's."""
    space = F.lit(" ")
    shown = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    harm = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    hurt = turns.select("conv_id", "turn", "role", "text").withColumn("harm", harm).filter("harm <> 0")
    return hurt.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("again"),
    ).drop("again")


def repair_report(turns: DataFrame, damage=damaged) -> DataFrame:
    """The report on every conversation of ``turns`` after damage; those without any row left have zeros."""
    told = report(repair(damage(turns)))
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    none = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    joined = every.alias("e").join(told.alias("t"), F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")), "left")
    return joined.select("e.conv_id", *(F.coalesce(F.col(f"t.{c}"), v).alias(c) for c, v in none.items()))
