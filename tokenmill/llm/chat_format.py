"""Conversations as training text, proved by a grammar round trip.

Turns are marked as ``<|im_start|>role``, line end, text, ``<|im_end|>``, line
end.  A deterministic parser reads the rendered text again; where the turns that
it recovers are not those of the source, the content in conflict is escaped and
the text rendered anew, until both are identical.  Texts without conflicts stay
as they are.  No text may hold a control string, ``<|name|>``, whether the template
uses it or not, as tokenizers may read any of them as a token of its own.

Escaping puts a backslash between ``<`` and ``|`` (``<\\|im_end|>``), one more where
there are some already, so it is reversed by taking one away.  In a role it also
covers backslashes and line ends.

Rows meet by conversation, sorted by turn, and stream through the task: a
conversation longer than ``PART_CHARS`` is returned in several parts, cut between
turns, so memory is that of one part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.frames import column, schema_with

BEGIN, END = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1 << 23
RAW, TEXT_ESCAPED, ALL_ESCAPED = range(3)

_CONTROL = re.compile(r"<\|[A-Za-z0-9_]+\|>")
_MARK, _ESCAPED_MARK = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPE = re.compile(r"\\(.)")

Turn = tuple[str, str]


class NotATurn(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED_MARK.sub(r"<\1|", text) if "<\\" in text else text


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<|", "<\\|")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], role) if "\\" in role else role


def render(turn: Turn, level: int) -> tuple[str, int, int]:
    """The rendered turn, and where its text begins and ends in it."""
    role = escape_role(turn[0]) if level >= ALL_ESCAPED else turn[0]
    text = escape(turn[1]) if level >= TEXT_ESCAPED else turn[1]
    begin = len(BEGIN) + len(role) + 1
    return f"{BEGIN}{role}\n{text}{END}\n", begin, begin + len(text)


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted text, unescaped; NotATurn if a control string stands anywhere but around a turn."""
    at, out = 0, []
    while at < len(formatted):
        head = at + len(BEGIN)
        line, end = formatted.find("\n", head), formatted.find(END, at)
        if not formatted.startswith(BEGIN, at) or line < 0 or end <= line or _CONTROL.search(formatted, head, end) \
                or not formatted.startswith("\n", end + len(END)):
            raise NotATurn(f"no turn at {at}")
        out.append((unescape_role(formatted[head:line]), unescape(formatted[line + 1:end])))
        at = end + len(END) + 1
    return out


def reads_back(formatted: str, turns: list[Turn]) -> bool:
    try:
        return parse(formatted) == turns
    except NotATurn:
        return False


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """Text that parses back to ``turns``, the place of each turn's text in it, and how many turns were escaped."""
    levels = [RAW] * len(turns)
    while True:
        pieces = [render(turn, level) for turn, level in zip(turns, levels, strict=True)]
        formatted = "".join(p for p, _, _ in pieces)
        if reads_back(formatted, turns):
            break
        # a turn that reads back alone does so beside any others: marks never overlap a border
        conflicts = [i for i, turn in enumerate(turns) if not reads_back(pieces[i][0], [turn])]
        if not conflicts or any(levels[i] == ALL_ESCAPED for i in conflicts):
            raise ValueError("a conversation cannot be formatted so that it reads back")
        for i in conflicts:
            levels[i] += 1
    places, at = [], 0
    for piece, begin, end in pieces:
        places.append((at + begin, at + end))
        at += len(piece)
    return formatted, places, sum(level > RAW for level in levels)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         loss_roles: tuple[str, ...] = ("assistant",), part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_col``, ``part``, ``n_turns``, ``formatted``, ``loss_spans``, ``n_escaped``: one row a conversation, or part of a long one.

    ``loss_spans`` are (start, end) in code points of ``formatted``, the texts of
    ``loss_roles`` as they stand there, in order.  The parts of a conversation are
    consecutive rows of one partition, numbered from 0.

    Turns ascend by number, a null number first, ties by role and text; repeated rows
    are turns of their own.  A null role or text is empty, and rows with a null
    conversation form one.  Further columns are left out; an empty table gives an
    empty result.
    """
    out = schema_with(rows, conv_col, conv_col, "part int, n_turns long, formatted string, "
                      "loss_spans array<struct<start: int, end: int>>, n_escaped long")
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    narrow = rows.select(column(conv_col).alias("conv"), column(turn_col).alias("turn"), F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = narrow.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        conv, part, turns, chars = None, 0, [], 0

        def finished() -> pa.RecordBatch:
            formatted, places, escaped = format_turns(turns)
            loss = [{"start": a, "end": b} for (role, _), (a, b) in zip(turns, places, strict=True) if role in loss_roles]
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([part], pa.int32()), pa.array([len(turns)], pa.int64()), pa.array([formatted], pa.string()),
                 pa.array([loss], spans), pa.array([escaped], pa.int64())], names=out.names)

        def packed(done: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(done).combine_chunks().to_batches()[0]

        done, held = [], 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if turns and (c != conv or chars + len(text) > part_chars):
                    done.append(finished())
                    held += chars
                    part = part + 1 if c == conv else 0
                    turns, chars = [], 0
                    if held > part_chars or len(done) >= 2048:
                        yield packed(done)
                        done, held = [], 0
                conv = c
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            done.append(finished())
        if done:
            yield packed(done)

    return ordered.mapInArrow(run, out)
