"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

The parser is deterministic: a text ends at the next control string, which must be "<|im_end|>". In a
text, "<", one backslash or more, and the rest of a control string stand for the same with one
backslash less; in a role, backslash escapes stand for a backslash, a line break and "<".

A turn is rendered as it is, parsed, and compared with its source. If anything differs, control
strings in its text (with or without backslashes) get one more backslash and the turn is rendered
again, until what is read back is identical; then the whole conversation is checked the same way.
So ordinary text is never touched, and everything can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = re.compile(r"<\|im_(start|end)\|>")
LIKE_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
LEARNED_ROLE = "assistant"

FORMATTED = pa.struct(
    [
        ("text", pa.string()),
        ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
READ = pa.struct(
    [
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
    ]
)


def escape(text: str) -> str:
    return LIKE_CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")


def unescape_role(role: str) -> str:
    meaning = {"\\": "\\", "n": "\n", "l": "<"}
    return re.sub(r"\\(.)", lambda m: meaning.get(m[1], m[0]), role)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """The turns as (role, text, start, end), start and end of the escaped text; None if it is no conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.find("\n", at)
        if not formatted.startswith(START, at) or head < 0:
            return None
        end = CONTROL.search(formatted, head + 1)
        if not end or end[0] != END or not formatted.startswith("\n", end.end()):
            return None
        role = unescape_role(formatted[at + len(START) : head])
        turns.append((role, unescape(formatted[head + 1 : end.start()]), head + 1, end.start()))
        at = end.end() + 1
    return turns


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{text}{END}\n"


def format_turn(role: str, text: str) -> str:
    written = text
    while True:
        rendered = render(role, written)
        found = parse(rendered)
        if found and [turn[:2] for turn in found] == [(role, text)]:
            return rendered
        harder = escape(written)
        if harder == written:
            raise ValueError("a turn cannot be written so that it is read back")
        written = harder


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask: where the texts of the assistant are."""
    formatted = "".join(format_turn(role, text) for role, text in turns)
    found = parse(formatted)
    if found is None or [turn[:2] for turn in found] != turns:
        raise ValueError("a conversation is not read back as it was")
    return formatted, [(start, end) for role, _, start, end in found if role == LEARNED_ROLE]


def _format(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for turns in batch:
            turns = [(t["role"] or "", t["text"] or "") for t in turns.as_py()]
            text, mask = format_turns(turns)
            out.append({"text": text, "mask": [{"start": a, "end": b} for a, b in mask]})
        yield pa.array(out, type=FORMATTED)


def _read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for value in batch:
            value = value.as_py()
            turns = parse(value["text"])
            whole = "".join(f"{role}\n{text}\n" for role, text, _, _ in turns)
            learned = "".join(unescape(value["text"][m["start"] : m["end"]]) for m in value["mask"])
            out.append(
                {
                    "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(),
                    "loss_chars": len(learned),
                    "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                }
            )
        yield pa.array(out, type=READ)


def conversations(
    rows: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(id_column, formatted), one row per conversation; formatted has text and mask (spans under loss).

    Turns are ordered by turn, then role and text; a null turn comes first, a null role or text is
    empty, rows that repeat a turn are turns of their own, and a null id is a conversation too. An
    empty table gives none. A conversation is one value of the result, so its turns meet in one task.
    """
    turn = F.struct(
        F.col(turn_column).isNotNull().alias("given"),
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    gathered = rows.groupBy(F.col(id_column)).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    form = F.arrow_udf(_format, returnType=from_arrow_type(FORMATTED)).asNondeterministic()
    said = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return gathered.select(id_column, form(said).alias("formatted"))


def read_back(formatted: Column) -> Column:
    """What the formatted text and mask say: a struct of n_turns, turns_sha256 (of role, line break, text,
    line break for each turn), loss_chars and loss_sha256 (of the texts under the mask, unescaped)."""
    return F.arrow_udf(_read, returnType=from_arrow_type(READ)).asNondeterministic()(formatted)


for _function in (_format, _read):
    _function.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
