"""Chat formatting from event logs.

A log row is (conv_id, turn, nth, seq, kind, role, text): what happened to message
(turn, nth) of a conversation as its ``seq``-th event.

* ``delta`` adds text to the message,
* ``edit`` replaces all its text,
* ``regenerate`` empties it and drops what later turns said before this event.

A role set by any event of a message is its role from there on. Logs are partitioned by
conversation and sorted by message, then sequence, so that a task folds one message at a
time: all that a later turn needs to know of earlier ones is the last regeneration.

The template is ``### role:\\n text </turn>\\n`` (without the blanks). Inside roles and
texts a backslash is put before every backslash, ``###`` and ``</turn>``, and in roles also
before a colon; reading takes any character after a backslash as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text

ASSISTANT = "assistant"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)

_TURN_EVENTS = Decimal(1 << 42)  # more than any turn has
_NULL_TURN = Decimal(-(1 << 63) - 1)  # before all turns

Batches = Iterator[pa.RecordBatch]

_MESSAGE = (
    "conv_id long, turn long, nth long, role string, rendered string, "
    "loss boolean, begin long, loss_begin long, loss_end long"
)


def escape(value: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", value)


def unescape(value: str) -> str:
    return _ESCAPED.sub(r"\1", value)


def render(role: str, value: str) -> tuple[str, int, int]:
    """A message in the template, and where its text begins and ends there."""
    head = f"### {_ROLE_CONTROL.sub(r'\\\g<0>', role)}:\n"
    body = escape(value)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse(rendered: str) -> list[tuple[str, str]]:
    """(role, text) of each message of a formatted conversation."""
    out, at = [], 0
    while at < len(rendered):
        match = _TURN.match(rendered, at)
        if match is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return out


def log_of(conversations: DataFrame) -> DataFrame:
    """An event log whose fold gives the rows of ``conversations`` back.

    Messages arrive in deltas; some are drafts that an edit replaces, some are regenerated.
    Rows of one turn are told apart by ``nth``, in order of role and text. Turns have disjoint
    ranges of ``seq``, in the order in which `messages` folds them; being decimal, these hold
    any turn.
    """
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.row_number().over(same).cast("long").alias("nth"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    event = "struct({} as at, '{}' as kind, {} as text)".format
    half = "int(length(text) / 2)"
    first, second = f"left(text, {half})", f"substring(text, {half} + 1)"
    streamed = f"array({event(0, 'delta', first)}, {event(1, 'delta', second)})"
    edited = f"array({event(0, 'delta', second)}, {event(1, 'edit', 'text')})"
    again = (
        f"array({event(0, 'delta', second)}, {event(1, 'regenerate', first)}, {event(2, 'delta', second)})"
    )
    kind = "pmod(xxhash64(conv_id, turn, nth), 3)"
    turn = F.coalesce(F.col("turn").cast("decimal(20,0)"), F.lit(_NULL_TURN))
    events = F.explode(F.expr(f"case {kind} when 0 then {streamed} when 1 then {edited} else {again} end"))
    return rows.withColumn("e", events).select(
        "conv_id", "turn", "nth",
        (turn * F.lit(_TURN_EVENTS) + F.col("nth") * 4 + F.col("e.at")).alias("seq"),
        F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text"),
    )


class _Fold:
    """Messages of one task's conversations, finished one after the other."""

    def __init__(self):
        self.conversation: object = self
        self.message: tuple | None = None
        self.reset = None  # the last regeneration of an earlier turn
        self.turn_reset = None  # of this turn
        self.turn: object = self
        self.offset = 0
        self.done: list[tuple] = []

    def event(self, conv, turn, nth, seq, kind, role, value) -> None:
        if conv != self.conversation or (turn, nth) != self.message:
            self.finish()
            if conv != self.conversation:
                self.conversation, self.offset, self.reset, self.turn_reset, self.turn = conv, 0, None, None, self
            if turn != self.turn:
                self.turn = turn
                self.reset = _later(self.reset, self.turn_reset)
                self.turn_reset = None
            self.message, self.role, self.texts, self.live = (turn, nth), "", [], False
        if kind == "regenerate":
            self.turn_reset = _later(self.turn_reset, seq)
        if self.reset is not None and (seq is None or seq < self.reset):
            return
        self.live = True
        if role is not None:
            self.role = role
        if kind in ("edit", "regenerate"):
            self.texts = []
        self.texts.append(value or "")

    def finish(self) -> None:
        if self.message is None or not self.live:
            self.message = None
            return
        rendered, begin, end = render(self.role, "".join(self.texts))
        turn, nth = self.message
        at = self.offset
        self.done.append(
            (self.conversation, turn, nth, self.role, rendered, self.role == ASSISTANT, at, at + begin, at + end)
        )
        self.offset += len(rendered)
        self.message = None


def _later(one, other):
    return other if one is None else one if other is None else max(one, other)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def messages(log: DataFrame) -> DataFrame:
    """The final messages of all conversations, rendered, in order within each.

    ``begin`` is where a message starts in its formatted conversation; if ``loss`` (it is
    an assistant's), its text from ``loss_begin`` to ``loss_end`` is under the loss mask.
    Offsets count code points. Null ids are one conversation, null turns come first,
    events without seq first of their message; null texts and roles are empty or unset.
    A repeated delta adds its text again. Messages all of whose events were dropped are none.
    """

    def run(batches: Batches) -> Batches:
        fold = _Fold()
        for batch in text.slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fold.event(*row)
            yield _batch(fold.done, _MESSAGE)
            fold.done = []
        fold.finish()
        yield _batch(fold.done, _MESSAGE)

    rows = log.select("conv_id", "turn", "nth", "seq", "kind", "role", "text")
    sent = rows.repartition("conv_id").sortWithinPartitions(*rows.columns)
    return sent.mapInArrow(run, _MESSAGE)


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(rendered: DataFrame) -> DataFrame:
    """What reading formatted conversations back gives, per conversation.

    ``rendered`` is what `messages` returns, in its order. Messages are parsed one by one,
    and hashed as they come, so a conversation may be of any length.
    """

    def run(batches: Batches) -> Batches:
        current: list | None = None

        def result() -> tuple:
            key, turns, turn_hash, loss, loss_hash, size = current
            return key, turns, turn_hash.hexdigest(), loss, loss_hash.hexdigest(), size

        for batch in text.slices(batches, column="rendered"):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "rendered", "loss", "begin", "loss_begin", "loss_end"))
            for key, value, loss, begin, low, high in zip(*columns, strict=True):
                if current is None or current[0] != key or begin == 0:
                    if current is not None:
                        out.append(result())
                    current = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(value):
                    current[1] += 1
                    current[2].update(f"{role}\n{said}\n".encode())
                if loss:
                    masked = unescape(value[low - begin : high - begin])
                    current[3] += len(masked)
                    current[4].update(masked.encode())
                current[5] += len(value)
            yield _batch(out, _DIGEST)
        yield _batch([result()] if current is not None else [], _DIGEST)

    return rendered.mapInArrow(run, _DIGEST)
