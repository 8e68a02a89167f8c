"""Chat formatting with a grammar round trip.

A conversation is its turns, one behind the other; a turn is an opening mark, a
space, the text, a space and the closing mark of its role. A role other than
system, user and assistant is named on a line of its own before the text. The
parser reads up to the first mark, which has to be the closing one, and takes
one backslash out of every mark that has some behind its first character.

Each turn is rendered as it is, parsed again and compared with its source. If
they differ, or the parser takes offence, all marks in the text (with or without
backslashes) get one backslash more, until they are identical.

Turns are rendered where they lie. Only the digests of a conversation need its
turns in order; they are read from partitions sorted by conversation, one turn
in memory at a time, however long a conversation is. What is learnt from is read
by the loss mask, which has the place of an assistant's text in its turn and
nothing of other turns. Turns are ordered by turn (null last), role and text;
equal rows are turns of their own. A null text or role is empty; bytes that are no
UTF-8 are read as the replacement character. A null conversation id is a
conversation of its own. Extra columns are left out; an empty table gives an
empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import decoded

MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[OUT]", "</s>"),
}
OTHER = ("<<ROLE>>", "<</ROLE>>")
LEARNT = "assistant"  # the role under the loss mask
_ALL = sorted({mark for pair in [*MARKS.values(), OTHER] for mark in pair})
_MARK = re.compile("|".join(f"{re.escape(m[0])}\\\\*{re.escape(m[1:])}" for m in _ALL))
_SLASHED = re.compile("|".join(f"{re.escape(m[0])}\\\\+{re.escape(m[1:])}" for m in _ALL))
_PLAIN = re.compile("|".join(map(re.escape, _ALL)))
_OPENING = re.compile("|".join(re.escape(pair[0]) for pair in [*MARKS.values(), OTHER]))
_ROLE_OF: dict[str, str | None] = {p[0]: role for role, p in MARKS.items()} | {OTHER[0]: None}
_EXAMPLE = "</s>[INST] ok [/INST]"


class ParseError(ValueError):
    pass


def _more(match: re.Match) -> str:
    return f"{match[0][0]}\\{match[0][1:]}"


def _less(match: re.Match) -> str:
    return match[0][0] + match[0][2:]


def unescape(text: str) -> str:
    return _SLASHED.sub(_less, text) if "\\" in text else text


def escape(text: str) -> str:
    """One backslash more in every mark."""
    return _MARK.sub(_more, text)


def marks_of(role: str) -> tuple[str, str]:
    return MARKS.get(role, OTHER)


def _one_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _lines(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role and text of each turn, unescaped, and where its text stands."""
    turns, at = [], 0
    while at < len(formatted):
        opening = _OPENING.match(formatted, at)
        if not opening or not formatted.startswith(" ", opening.end()):
            raise ParseError(f"no turn at {at}")
        role, start = _ROLE_OF[opening[0]], opening.end() + 1
        closing = _PLAIN.search(formatted, start)
        if not closing or closing[0] != (MARKS[role] if role else OTHER)[1]:
            raise ParseError(f"the turn at {at} is not closed")
        end = closing.start() - 1
        if end < start or formatted[end] != " ":
            raise ParseError(f"the turn at {at} is not closed by a space and its mark")
        if role is None:
            line = formatted.find("\n", start, end)
            if line < 0:
                raise ParseError(f"the turn at {at} has no role")
            role, start = _lines(unescape(formatted[start:line])), line + 1
        turns.append((role, unescape(formatted[start:end]), start, end))
        at = closing.end()
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses to its source, and where its text stands in it."""
    head = role if role in MARKS else _one_line(role)
    for shown, written in ((head, text), (escape(head) if role not in MARKS else head, escape(text))):
        opening, closing = marks_of(role)
        line = "" if role in MARKS else f"{shown}\n"
        formatted = f"{opening} {line}{written} {closing}"
        try:
            turns = parse(formatted)
        except ParseError:
            continue
        if [turn[:2] for turn in turns] == [(role, text)]:
            return formatted, turns[0][2], turns[0][3]
    raise ValueError("a turn does not survive the round trip")


def _render(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        roles, texts = decoded(batch.column("role")), decoded(batch.column("text"))
        made = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
        masks = [x[1:] if r == LEARNT else (0, 0) for r, x in zip(roles, made, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": batch.column("conv_id"),
                "turn": batch.column("turn"),
                "role": pa.array(roles, pa.string()),
                "source": pa.array(texts, pa.string()),
                "formatted": pa.array([x[0] for x in made], pa.string()),
                "loss_start": pa.array([x[0] for x in masks], pa.int32()),
                "loss_end": pa.array([x[1] for x in masks], pa.int32()),
            }
        )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every turn as formatted text, and its loss mask.

    A formatted conversation is these texts in the order of turns. The mask is a
    range of the turn's code points: an assistant's text, else nothing.
    """
    turns = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "role", "text"
    )
    return turns.mapInArrow(
        _render,
        "conv_id bigint, turn bigint, role string, source string, formatted string, "
        "loss_start int, loss_end int",
    )


class _Reader:
    """What is read back from the formatted turns of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = sha256(), sha256()

    def read(self, formatted: str, start: int, end: int) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        learnt = unescape(formatted[start:end])
        self.loss_chars += len(learnt)
        self.loss.update(learnt.encode())

    def row(self) -> tuple:
        digests = self.all.hexdigest(), self.loss.hexdigest()
        return self.conv_id, self.turns, digests[0], self.loss_chars, digests[1], self.chars


_READ = {
    "conv_id": pa.int64(),
    "n_turns": pa.int64(),
    "turns_sha256": pa.string(),
    "loss_chars": pa.int64(),
    "loss_sha256": pa.string(),
    "formatted_chars": pa.int64(),
}


def _read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Reader | None = None
    done: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, _READ.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(_READ))

    for batch in rows:
        ids, texts = batch.column("conv_id").to_pylist(), batch.column("formatted")
        masks = zip(*(batch.column(f"loss_{x}").to_pylist() for x in ("start", "end")), strict=True)
        for conv_id, text, mask in zip(ids, texts, masks, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Reader(conv_id)
            now.read(text.as_py(), *mask)
        if len(done) >= 5000:
            yield flushed()
            done.clear()
    if now is not None:
        done.append(now.row())
    if done:
        yield flushed()


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from its formatted turns."""
    order = [
        F.asc("conv_id"), F.asc_nulls_last("turn"), F.asc("role"), F.asc("source"),
    ]
    placed = turns.repartition("conv_id").sortWithinPartitions(*order)
    types = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    read = placed.select("conv_id", "formatted", "loss_start", "loss_end")
    return read.mapInArrow(_read, types)


def example(conversations: DataFrame) -> DataFrame:
    """Conversation -1: both turns say what looks like the marks of a template."""
    rows = [(-1, 0, "user", _EXAMPLE), (-1, 1, "assistant", _EXAMPLE)]
    return conversations.sparkSession.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string"
    )
