"""Conversation structure repair: the cheapest edits that make the turns alternate.

A conversation is well formed if its turns' role initials are an `s` or none, then pairs `ua`,
or if it has no turns. Each row is kept (K, 0), given the role user or assistant (R, 2) or
deleted (D, 3); empty user or assistant turns are inserted (I, 2). Blank rows and duplicates
must be deleted; a truncated row that stays costs 1. Of the cheapest ways the one whose
letters come first in ASCII order is taken.

The dynamic program keeps one way for each state of the grammar: nothing yet, after `s`,
after `u`, after `a`. Ways are persistent: a way is its last edit, a node linked to the way
before it, so ways share their beginnings. A node knows its ancestors at powers of two and a
rolling hash of all letters up to it; ways of equal cost are compared by a search for their
longest common prefix along these, and what the hashes call equal is verified letter by letter
down to where the two ways become one. Equally cheap ways to one state never are a prefix of
one another: they have the same rows' letters, and a further insert costs more.

What all ways have in common is settled and passed on every so many rows, so a task holds the
open end of a conversation alone, and a conversation of any length can be streamed.

Rows are taken by turn (nulls first), ties by role and text. A null role or text is one
blank, so such a text is blank; an empty role has no initial and fits nowhere; null keys are one conversation; of repeated rows all but the
first are duplicates. Further columns are left alone. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, stored, work_folder
from ordertally.llm.turns import Rows, in_sequence, tuples

# Rows after which the common beginning of all ways is settled.
SETTLE_ROWS = 1024
_BASE, _PRIME = 1_000_003, 2**61 - 1
# States: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_KEEP = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ALTERNATE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
_LEGAL = {"su", "ua", "au"}

_EDITS = (
    "conv_id bigint, place bigint, edit string, fault string, illegal boolean, cost bigint, "
    "turn bigint, role string, text string"
)
_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("edit", pa.string()),
        ("fault", pa.string()),
        ("illegal", pa.bool_()),
        ("cost", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)


class Way:
    """Edits up to here: the last letter, and the way before it."""

    __slots__ = ("letter", "up", "depth", "hash")

    def __init__(self, letter: str = "", before: Way | None = None):
        self.letter = letter
        self.up: list[Way] = []  # ancestors 1, 2, 4 ... letters before
        if before is None:
            self.depth = self.hash = 0
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(letter)) % _PRIME
        ancestor, k = before, 0
        while True:
            self.up.append(ancestor)
            if k >= len(ancestor.up):
                break
            ancestor, k = ancestor.up[k], k + 1

    def at(self, depth: int) -> Way:
        """The ancestor with so many letters."""
        way = self
        while way.depth > depth:
            way = way.up[(way.depth - depth).bit_length() - 1]
        return way

    def letters(self, down_to: int = 0) -> str:
        out, way = [], self
        while way.depth > down_to:
            out.append(way.letter)
            way = way.up[0]
        return "".join(reversed(out))


def _same(one: Way, other: Way) -> bool:
    """Whether two ways of one length have the same letters, whatever their hashes."""
    while one is not other:
        if one.letter != other.letter:
            return False
        one, other = one.up[0], other.up[0]
    return True


def less(one: Way, other: Way) -> bool:
    """Whether one way's letters come before the other's."""
    depth = min(one.depth, other.depth)
    a, b = one.at(depth), other.at(depth)
    if a.hash == b.hash and _same(a, b):
        return one.depth < other.depth
    if a.hash != b.hash:
        for k in range(depth.bit_length(), -1, -1):  # up to just below the common prefix
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        if _same(a.up[0], b.up[0]):
            return a.letter < b.letter
    return one.letters() < other.letters()  # hashes collided


Ways = list  # for each state (cost, way), or None


def _offer(ways: Ways, state: int, cost: int, way: Way, letter: str) -> None:
    known = ways[state]
    if known is not None and known[0] < cost:
        return
    offered = Way(letter, way)
    if known is None or cost < known[0] or less(offered, known[1]):
        ways[state] = cost, offered


def _with_inserts(ways: Ways) -> Ways:
    """Two at most are of use in one place: a third leads back to where one was."""
    for _ in range(2):
        before = list(ways)
        for state, known in enumerate(before):
            if known is not None:
                _offer(ways, _ALTERNATE[state], known[0] + _COSTS["I"], known[1], "I")
    return ways


def start() -> Ways:
    return _with_inserts([(0, Way()), None, None, None])


def after(ways: Ways, initial: str, must_go: bool, truncated: bool) -> Ways:
    """The ways after one more row."""
    new: Ways = [None] * 4
    for state, known in enumerate(ways):
        if known is None:
            continue
        cost, way = known
        _offer(new, state, cost + _COSTS["D"], way, "D")
        if not must_go:
            to = _KEEP.get(initial, {}).get(state)
            if to is not None:
                _offer(new, to, cost + truncated, way, "K")
            _offer(new, _ALTERNATE[state], cost + _COSTS["R"] + truncated, way, "R")
    return _with_inserts(new)


def best(ways: Ways) -> tuple[int, Way]:
    ends = [known for known in (ways[NOTHING], ways[ASSISTANT]) if known is not None]
    if len(ends) == 2 and ends[0][0] == ends[1][0]:
        return ends[0] if less(ends[0][1], ends[1][1]) else ends[1]
    return min(ends, key=lambda end: end[0])


class Repair:
    """The edits of one conversation, as its rows come."""

    def __init__(self, key: int | None, settle_rows: int = SETTLE_ROWS):
        self.key, self.settle_rows = key, settle_rows
        self.ways = start()
        self.rows: list[tuple] = []  # rows of which the letter is open
        self.state, self.place, self.last = NOTHING, 0, None

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        initial = role[:1]
        illegal = self.last is not None and self.last + initial not in _LEGAL
        self.last = initial
        self.rows.append((turn, role, text, fault, illegal))
        self.ways = after(
            self.ways, initial, fault in ("blank", "duplicate"), fault == "truncated"
        )
        if len(self.rows) >= self.settle_rows:
            yield from self.settle()

    def settle(self) -> Iterator[tuple]:
        """Pass on the edits that all ways share; the ends of the ways begin anew there."""
        ends = [known and known[1].letters() for known in self.ways]
        known = [letters for letters in ends if letters is not None]
        low, high = min(known), max(known)
        common = next((k for k, x in enumerate(low) if k >= len(high) or x != high[k]), len(low))
        yield from self.edits(low[:common])
        root = Way()
        shared: dict[str, Way] = {"": root}
        for state, letters in enumerate(ends):
            if letters is None:
                continue
            rest = letters[common:]
            for k in range(1, len(rest) + 1):
                if rest[:k] not in shared:
                    shared[rest[:k]] = Way(rest[k - 1], shared[rest[: k - 1]])
            self.ways[state] = self.ways[state][0], shared[rest]
        # Ways that stay apart for long are settled less often.
        self.settle_rows = SETTLE_ROWS + 2 * len(self.rows)

    def edits(self, letters: str) -> Iterator[tuple]:
        used = 0
        for letter in letters:
            turn = fault = None
            role, text, illegal = "", "", False
            if letter != "I":
                turn, role, text, fault, illegal = self.rows[used]
                used += 1
            if letter == "K":
                self.state = _KEEP[role[:1]][self.state]
            elif letter != "D":
                self.state = _ALTERNATE[self.state]
                role = _NAMES[self.state]
            cost = _COSTS[letter] + (letter in "KR" and fault == "truncated")
            yield self.key, self.place, letter, fault, illegal, cost, turn, role, text
            self.place += 1
        self.rows = self.rows[used:]

    def end(self) -> Iterator[tuple]:
        yield from self.edits(best(self.ways)[1].letters())


def faults(conversations: DataFrame) -> DataFrame:
    """The rows with the first fault of each: blank, duplicate, truncated.

    Duplicates are found by Spark, on whole texts, in the partitioning by conversation.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    # The last character that is no white space.
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    earlier = W.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    fault = (
        F.when(last == "", "blank")
        .when(F.row_number().over(earlier) > 1, "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    return rows.repartition("conv_id").withColumn("fault", fault)


def repaired(conversations: DataFrame) -> DataFrame:
    """Every edit in order: what was done, to which row, and what the row is now.

    Edits other than `D` are the repaired conversation. `fault` and `illegal` (whether the
    row and the one before it stand in no legal order) are those of the row as it came.
    """

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = Rows(_SCHEMA, texts=[8]), None
        for key, *row in tuples(batches, ("conv_id", "turn", "role", "text", "fault")):
            if current is None or current.key != key:
                for edit in current.end() if current else ():
                    out.add(edit)
                current = Repair(key)
            for edit in current.add(*row):
                out.add(edit)
            if out.ready():
                yield from out.take()
        for edit in current.end() if current else ():
            out.add(edit)
        yield from out.take()

    rows = faults(conversations).sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(repair, _EDITS)


_TOTALS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
_TOTALS_SCHEMA = pa.schema(
    [
        *((name, pa.int64()) for name in ("conv_id", "gaps", "blank", "duplicate", "truncated")),
        *((name, pa.int64()) for name in ("illegal", "cost")),
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)


class _Summing:
    def __init__(self, key: int | None):
        self.key = key
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.low = self.high = None
        self.letters: list[str] = []
        self.digest, self.kept = hashlib.sha256(), False

    def add(self, edit, fault, illegal, cost, turn, role, text) -> None:
        if fault is not None:
            self.counts[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.letters.append(edit)
        if turn is not None and turn != self.high:  # turns come in order
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if edit != "D":
            self.digest.update(("\n" * self.kept + f"{role}:{text}").encode())
            self.kept = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        sums = gaps, *self.counts.values(), self.illegal, self.cost
        return self.key, *sums, "".join(self.letters), self.digest.hexdigest()


def totals(edits: DataFrame) -> DataFrame:
    """One row for each conversation with edits: faults, costs, letters and digest."""
    columns = ("conv_id", "edit", "fault", "illegal", "cost", "turn", "role", "text")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = Rows(_TOTALS_SCHEMA, texts=[7]), None
        for key, *edit in tuples(batches, columns):
            if current is None or current.key != key:
                if current:
                    out.add(current.row())
                current = _Summing(key)
            current.add(*edit)
            if out.ready():
                yield from out.take()
        if current:
            out.add(current.row())
        yield from out.take()

    return in_sequence(edits.select(*columns, "place"), "place").mapInArrow(total, _TOTALS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with one kind of damage in twenty each, by a checksum of conversation and turn."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text: Column = F.when(kind == 1, F.lit("")).when(
        kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")
    )
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(blank("role")).alias("role"),
        text.otherwise(blank("text")).alias("text"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
        kind.alias("kind"),
    )
    rows = rows.where("kind <> 0")
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    edits = stored(repaired(damaged(conversations)), f"{work_folder(spark)}/edits")
    found = totals(edits).withColumnRenamed("conv_id", "found_id")
    # Conversations of which nothing is left after the damage have no edits.
    known = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    joined = known.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
