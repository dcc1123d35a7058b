"""Chat formatting with typed content parts.

A turn's content is a text or a list of parts ``{type, text, ref, tokens}``. A visitor flattens the parts in
order: text is escaped, an image, audio or document part becomes its placeholder, and its reference, place and expanded
number of tokens are recorded. Texts cannot forge control strings: in every control string in a text a backslash
is put after the first character, and backslashes are doubled, which ``unescape`` takes back.

A turn is formatted on its own, so a conversation is split over tasks however long it is, and the output is a row per
turn: ``segment``, with the loss mask's span in it. ``digests`` reads the segments back in order as a stream: it keeps
hash states and counters only, never a conversation. SHA-256 of one conversation is a chain, so that part of one
conversation is read by one task.

Defined cases: null and empty texts and part lists give an empty text; a null role is an empty role; an unknown part type
counts as text; turns are sorted by turn, then segment, nulls first, and repeated rows stay turns of their own; a
null conversation id is a conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from radiolith.llm.common import width

PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
#: Strings that texts must not contain as they are.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", *PLACEHOLDERS.values())
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SEGMENT = re.compile(r"<s>\[INST\] ((?:[^\\\n]|\\.)*)\n(.*) \[/INST\]</s>", re.DOTALL)

PART = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
     T.StructField("tokens", T.LongType())]
)
_OUT = (
    "segment string, loss_start int, loss_end int, n_tokens long, "
    "attachments array<struct<kind: string, ref: string, at: int, tokens: long>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits parts in order and collects what a turn's content becomes."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0
    tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type")
        if kind in PLACEHOLDERS:
            self.attachment(kind, part)
        else:
            self.add(escape(part.get("text") or ""))

    def attachment(self, kind: str, part: dict) -> None:
        count = part.get("tokens") or 1
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "at": self.length, "tokens": count})
        self.tokens += count
        self.add(PLACEHOLDERS[kind])

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def format_turn(role: str | None, content: str | list[dict] | None) -> tuple[str, int, int, int, list[dict]]:
    """The turn's segment, the loss mask's span (an assistant's content, else empty), attachment tokens, attachments."""
    flat = Flattener()
    for part in [{"type": "text", "text": content}] if content is None or isinstance(content, str) else content:
        if part is not None:
            flat.visit(part)
    # A line break ends the role, so one inside it is escaped too.
    head = "<s>[INST] " + escape(role or "").replace("\n", "\\\n") + "\n"
    start = len(head)
    for attachment in flat.attachments:
        attachment["at"] += start
    end = start + (flat.length if role == "assistant" else 0)
    return f"{head}{''.join(flat.pieces)} [/INST]</s>", start, end, flat.tokens, flat.attachments


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError("not a turn's segment")
    return unescape(found[1]), unescape(found[2])


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         content_col: str = "text") -> DataFrame:
    """Per turn: ``conv_col, turn_col, segment, loss_start, loss_end, n_tokens, attachments``; places are in code points
    of the segment, and a conversation's string is its segments in order."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(content_col).alias("content"))
    listed = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int32()), ("tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turn(r, c) for r, c in zip(batch.column("role").to_pylist(), batch.column("content").to_pylist(), strict=True)]
            columns = list(zip(*made, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), listed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("turn"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["conv", "turn", "segment", "loss_start", "loss_end", "n_tokens", "attachments"],
            )

    conv, turn = (rows.schema[n].dataType.simpleString() for n in ("conv", "turn"))
    return rows.mapInArrow(run, f"conv {conv}, turn {turn}, {_OUT}").withColumnsRenamed({"conv": conv_col, "turn": turn_col})


class _Digest:
    """What is kept of a conversation while its segments stream by."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, end: int) -> None:
        role, text = read_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        learnt = unescape(segment[start:end])
        self.loss += len(learnt)
        self.learnt.update(learnt.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars


def digests(formatted: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Per conversation, read back from its segments: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)

        state, last = None, None
        for batch in batches:
            done = []
            for conv, group, segment, start, end in zip(*(batch.column(n).to_pylist() for n in ("conv", "group", "segment", "loss_start", "loss_end")), strict=True):
                if state is None or group != last:
                    if state is not None:
                        done.append(state.row())
                    state, last = _Digest(conv), group
                state.add(segment, start, end)
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([state.row()])

    kind = formatted.schema[conv_col].dataType.simpleString()
    rows = formatted.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), "segment", "loss_start", "loss_end",
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("group"),
    )
    shape = to_arrow_schema(T.StructType([
        rows.schema["conv"], *(T.StructField(n, T.LongType() if "sha" not in n else T.StringType())
        for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")),
    ]))
    return (
        rows.repartition(width(formatted.sparkSession), "group")
        .sortWithinPartitions("group", "turn", "segment")
        .mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
        .withColumnRenamed("conv", conv_col)
    )
