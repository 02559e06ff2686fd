"""Conversations as training text: a state machine over roles and a declarative template.

The machine checks the order of turns and emits text segments, each with a flag that says whether it counts in
the loss. Control strings inside texts are escaped, so nobody can open or close a turn by
writing a marker, and the text can be had back exactly. Turns are streamed: rows are dealt by
conversation, sorted, and pass through with one turn in memory, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "␛"


@dataclass(frozen=True)
class Template:
    """What stands around the role and the text of a turn, and which roles count in the loss."""

    before_role: str = "<|turn|>"
    before_text: str = "<|says|>"
    after_text: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Markers of other templates that shall not pass through as they are either.
    also_escaped: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")

    @property
    def control(self) -> tuple[str, ...]:
        return tuple(m.strip() for m in (self.before_role, self.before_text, self.after_text)) + self.also_escaped


#: From each state, the roles that may follow.
FOLLOWS = {
    None: ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user", "tool"),
    "tool": ("assistant", "tool"),
}


class Escaper:
    """Doubles the escape sign, and puts one after the first character of each control string."""

    def __init__(self, template: Template):
        self.find = re.compile(f"(?=(?:{'|'.join(map(re.escape, template.control))}))(.)")

    def escape(self, text: str) -> str:
        return self.find.sub(rf"\1{ESCAPE}", text.replace(ESCAPE, ESCAPE * 2))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(f"{ESCAPE}({ESCAPE}?)", r"\1", text)


_SEGMENT = "conv_id long, turn_no long, segment int, text string, loss boolean, turn_valid boolean"
_NAMES = [c.split()[0] for c in _SEGMENT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
_START = object()


def _ordered(turns: DataFrame) -> DataFrame:
    slim = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turn_no, segment, text, loss, turn_valid) of ``turns`` (conv_id, turn, role, text, ...).

    Joined in order of turn_no and segment, the texts are the formatted conversation. ``turn_valid`` is false
    where the role may not follow the one before; such turns are formatted all the same. Turns of one
    number go by role, then text; repeated rows are turns of their own; null role and text count as empty, a
    null turn comes first, and rows without conv_id are one conversation. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        escaper, conv, turn_no, state = Escaper(template), _START, 0, None
        for batch in batches:
            rows: list[tuple] = []
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if conv is _START or conv_id != conv:
                    conv, turn_no, state = conv_id, 0, None
                valid = role in FOLLOWS.get(state, ())
                head = f"{template.before_role}{escaper.escape(role)}{template.before_text}"
                parts = ((head, False), (escaper.escape(text), role in template.loss_roles), (template.after_text, False))
                rows += [(conv_id, turn_no, k, part, loss, valid) for k, (part, loss) in enumerate(parts)]
                turn_no, state = turn_no + 1, role
            columns = zip(*rows, strict=True) if rows else ([] for _ in _NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

    return _ordered(turns).mapInArrow(run, _SEGMENT)


class _Reader:
    """Reads one conversation back from its segments and digests what it finds."""

    def __init__(self, template: Template):
        t = template
        self.turn = re.compile(
            f"{re.escape(t.before_role)}(.*?){re.escape(t.before_text)}(.*?){re.escape(t.after_text)}", re.DOTALL
        )
        self.close = t.after_text
        self.pending, self.n_turns, self.chars, self.loss_chars, self.n_bad = "", 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.pending += text
        if loss:
            said = Escaper.unescape(text)
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        if text == self.close:
            self.n_bad += not valid
            found = self.turn.fullmatch(self.pending)
            if not found:
                raise ValueError("a turn cannot be read back")
            for part in found.groups():
                self.turns.update(Escaper.unescape(part).encode() + b"\n")
            self.n_turns, self.pending = self.n_turns + 1, ""

    def row(self, conv_id) -> tuple:
        return (conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.n_bad)


_SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_bad_turns long"
)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """A row of digests per conversation, read from ``segments`` as they come, in order."""

    def run(batches: Iterator[pa.RecordBatch]):
        names = [c.split()[0] for c in _SUMMARY.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

        def packed(rows):
            columns = zip(*rows, strict=True) if rows else ([] for _ in names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        conv, reader = _START, _Reader(template)
        for batch in batches:
            rows = []
            for conv_id, text, loss, valid in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True):
                if conv is not _START and conv_id != conv:
                    rows.append(reader.row(conv))
                    reader = _Reader(template)
                conv = conv_id
                reader.feed(text, loss, valid)
            yield packed(rows)
        if conv is not _START:
            yield packed([reader.row(conv)])

    return formatted.mapInArrow(run, _SUMMARY)
