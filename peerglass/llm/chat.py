"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

A turn is rendered, reparsed by the deterministic parser below and compared with its source.  Where they differ, because the
text holds control strings or what looks like an escape, its role and text are escaped and the round is repeated.  Escaping a text puts
one more backslash between ``<`` and ``|`` wherever the two stand next to each other or are parted by backslashes only; the parser takes
one away.  A role stands on one line; it is percent-encoded.

Rendering and checking are per turn and move nothing.  Rendered turns are written, then read back in order: rows of
a conversation are sorted, not gathered, and digests run along them, so memory holds one turn at a time.

Defined cases: null role or text is empty; turns of equal number are put in order by role and text; repeated rows are turns of their
own; a null conversation id is a conversation; conversations without rows do not exist; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerglass.llm.scratch import Scratch

START, END = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def parse(rendered: str) -> list[tuple[str, str, tuple[int, int]]]:
    """Turns (role, text, place of the text as written) of a rendered conversation; anything else is an error."""
    turns, at = [], 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        end = rendered.find(END, line)
        if not rendered.startswith(START, at) or line < 0 or end < 0 or not rendered.startswith("\n", end + len(END)):
            raise ValueError(f"not a turn at {at}")
        role, text = rendered[at + len(START):line], rendered[line + 1:end]
        if START in text or START in role or END in role:
            raise ValueError(f"a control string inside the turn at {at}")
        turns.append((unquote(role), unescape(text), (line + 1, end)))
        at = end + len(END) + 1
    return turns


def render(role: str, text: str) -> str:
    """A turn that parses back to what it was made from; plain if that does, else escaped."""
    for shown_role, shown in ((role, text), (quote(role, safe=" "), escape(text))):
        made = f"{START}{shown_role}\n{shown}{END}\n"
        try:
            if [turn[:2] for turn in parse(made)] == [(role, text)]:
                return made
        except ValueError:
            pass
    raise ValueError(f"the turn does not survive its own format: {role!r}")


def format_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered) of rows (conv_id, turn, role, text); concatenated in order they are the conversations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            made = pa.array([render(role, text) for role, text in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "rendered"])

    source = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "conv_id bigint, turn bigint, role string, text string, rendered string")


SUMMARY = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Reading:
    """Digests of one conversation, from its rendered pieces in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def read_back(formatted: DataFrame) -> DataFrame:
    """One row of counts and digests for each conversation, parsed from its rendered turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, schema = None, None
        for batch in batches:
            done = []
            for conv_id, rendered in zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist()):
                if reading is None or reading.conv_id != conv_id:
                    done += [reading.row()] if reading else []
                    reading = _Reading(conv_id)
                reading.feed(rendered)
            schema = schema or pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in
                                          (field.split() for field in SUMMARY.split(", "))])
            yield pa.RecordBatch.from_pylist(done, schema)
        if reading:
            yield pa.RecordBatch.from_pylist([reading.row()], schema)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "rendered").mapInArrow(run, SUMMARY)


def loss_spans(rendered: str) -> list[tuple[int, int]]:
    """Where the loss applies in a rendered conversation: the texts of the assistant, as written."""
    return [place for role, _, place in parse(rendered) if role == "assistant"]


def round_trip(conversations: DataFrame) -> DataFrame:
    """Formats all conversations, writes them, and summarises what is read back."""
    scratch = Scratch(conversations.sparkSession, "chat")
    return read_back(scratch.cut(format_turns(conversations)))
