"""Chat formatting: conversations cut into windows of a bounded number of tokens.

A turn becomes `<|im_start|>role`, a line break, its text, `<|im_end|>` and a line break.
Wherever a role or text holds a control string, a backslash is put after the string's first
character, and backslashes are doubled; a line break in a role is written behind a
backslash. So no text can open or close a turn, and `plain` gives back every text.

Windows are spans of whole turns. Prefix sums of the turns' tokens, searched in halves, say
where a span begins and ends: a window opens with the system turn, if the conversation opens
with one, repeats as many of the last turns as `history` and the room left by the first new
turn allow, and takes new turns up to `budget`. Each turn is new in one window. The loss mask
covers the texts of assistant turns that are new there; what a window repeats is masked. A
turn that does not fit beside the system turn alone has a window of those two, marked `over`:
nothing is cut or dropped. Tokens are counted turn by turn.

Rows are taken by turn (nulls first), ties by role and text. A null text or role is empty, a
null key is one conversation, repeated rows are turns of their own, further columns are left
alone, and an empty table gives no windows. A task reads a conversation as a stream and holds
one window of it, so one of any length needs no more memory than its largest turn.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, slices, stored, work_folder
from ordertally.llm.tokens import SLICE_BYTES, encoder, public_path
from ordertally.llm.turns import Rows, in_sequence, tuples

VOCABULARY = "byte_bpe_50k.json"
BUDGET, HISTORY = 1024, 256
# Rows that go to Python at once: the more, the fewer distinct words in proportion.
TURNS = 10_000

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Strings that mark turns or texts for one model or another.
CONTROLS = (
    OPEN,
    CLOSE,
    "<|endoftext|>",
    "<|startoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
_HEADS = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_HIDDEN = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    rf"{re.escape(OPEN)}((?:[^\\\n]|\\.)*)\n(.*?){re.escape(CLOSE)}\n", re.DOTALL
)
_WINDOWS = (
    "conv_id bigint, window bigint, turns int, repeated int, tokens bigint, over boolean, "
    "text string, loss array<struct<start: bigint, end: bigint>>"
)
_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("turns", pa.int32()),
        ("repeated", pa.int32()),
        ("tokens", pa.int64()),
        ("over", pa.bool_()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, windows bigint"
)
_READ_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("windows", pa.int64()),
    ]
)


def escaped(text: str) -> str:
    return _HEADS.sub(lambda head: head[0] + "\\", text.replace("\\", "\\\\"))


def plain(text: str) -> str:
    return _HIDDEN.sub(r"\1", text)


def head_of(role: str) -> str:
    return OPEN + escaped(role).replace("\n", "\\\n") + "\n"


def turns_in(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    at = 0
    for turn in _TURN.finditer(text):
        if turn.start() != at:
            break
        at = turn.end()
        yield plain(turn[1]), plain(turn[2])
    if at != len(text):
        raise ValueError(f"no turn at {at}")


class Windows:
    """The windows of one conversation, as its turns come."""

    def __init__(self, key: int | None, budget: int, history: int):
        self.key, self.budget, self.history = key, budget, history
        self.system: tuple[str, str] | None = None
        self.base = 0  # its tokens
        self.turns: list[tuple[str, str, bool]] = []  # head, text, whether it is a target
        self.sums = [0]  # tokens before each turn held, and of all at last
        self.new = 0  # the first that is new
        self.seen = self.number = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        self.seen += 1
        head, text = head_of(role), escaped(text)
        if self.seen == 1 and role == "system":
            self.system, self.base = (head, text), tokens
            return
        if len(self.turns) > self.new and self.base + self.sums[-1] - self.sums[0] + tokens > self.budget:
            yield self.close()
            room = max(0, min(self.history, self.budget - self.base - tokens))
            first = bisect_left(self.sums, self.sums[-1] - room)
            self.turns, self.sums = self.turns[first:], self.sums[first:]
            self.new = len(self.turns)
        self.turns.append((head, text, role == "assistant"))
        self.sums.append(self.sums[-1] + tokens)

    def close(self) -> tuple:
        repeated = self.new + (self.system is not None and self.number > 0)
        shown = [(*self.system, False)] if self.system else []
        held = len(shown)
        shown += self.turns
        parts, spans, at = [], [], 0
        for k, (head, text, target) in enumerate(shown):
            parts += (head, text, CLOSE, "\n")
            at += len(head)
            if target and k >= held + self.new:
                spans.append({"start": at, "end": at + len(text)})
            at += len(text) + len(CLOSE) + 1
        tokens = self.base + self.sums[-1] - self.sums[0]
        row = (self.key, self.number, len(shown), repeated, tokens, tokens > self.budget)
        self.number += 1
        return *row, "".join(parts), spans

    def end(self) -> Iterator[tuple]:
        if len(self.turns) > self.new or (self.system and not self.number):
            yield self.close()


def format_conversations(
    conversations: DataFrame, vocabulary: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """A row for each window: its number, how many turns it has and how many of these, at
    its beginning, an earlier window had as well, its tokens, the text, and the spans of the
    text, in code points, that a loss is taken on."""

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        # The line break at the end is no part of a word, so it is counted by itself.
        ending = len(tokens.whole(["\n"])[0]) // 4
        out, current = Rows(_SCHEMA, texts=[6]), None
        for batch in slices(batches, limit=SLICE_BYTES):
            rows = list(tuples([batch], ("conv_id", "role", "text")))
            turns = [head_of(role) + escaped(text) + CLOSE for _, role, text in rows]
            ids = tokens.encode(pa.array(turns, pa.string()))
            sizes = [len(one) // 4 + ending for one in ids]
            for (key, role, text), size in zip(rows, sizes, strict=True):
                if current is None or current.key != key:
                    for row in current.end() if current else ():
                        out.add(row)
                    current = Windows(key, budget, history)
                for row in current.add(role, text, size):
                    out.add(row)
                if out.ready():
                    yield from out.take()
        for row in current.end() if current else ():
            out.add(row)
        yield from out.take()

    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return in_sequence(rows, "turn", "role", "text").mapInArrow(form, _WINDOWS)


class _Reading:
    """What the windows of one conversation say."""

    def __init__(self, key: int | None):
        self.key = key
        self.turns = self.loss_chars = self.chars = self.windows = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, repeated: int, text: str, loss: list[dict]) -> None:
        self.windows += 1
        self.chars += len(text)
        for k, (role, said) in enumerate(turns_in(text)):
            if k >= repeated:
                self.turns += 1
                self.all.update(f"{role}\n{said}\n".encode())
        for span in loss:
            said = plain(text[span["start"] : span["end"]])
            self.loss_chars += len(said)
            self.loss.update(said.encode())

    def row(self) -> tuple:
        digests = self.all.hexdigest(), self.loss_chars, self.loss.hexdigest()
        return self.key, self.turns, *digests, self.chars, self.windows


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and targets of each conversation, parsed from the texts of its windows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = Rows(_READ_SCHEMA), None
        for key, repeated, text, loss in tuples(batches, ("conv_id", "repeated", "text", "loss")):
            if current is None or current.key != key:
                if current:
                    out.add(current.row())
                current = _Reading(key)
            current.add(repeated, text, loss)
            if out.ready():
                yield from out.take()
        if current:
            out.add(current.row())
        yield from out.take()

    shown = windows.select("conv_id", "window", "repeated", "text", "loss")
    return in_sequence(shown, "window").mapInArrow(read, _READ)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    shape = "conv_id bigint, turn bigint, role string, text string"
    tricky = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], shape)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    windows = format_conversations(rows.unionByName(tricky), public_path(VOCABULARY))
    return read_back(stored(windows, f"{work_folder(spark)}/windows", TURNS))
