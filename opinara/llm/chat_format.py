"""Chat formatting: a finite-state machine over roles and a declarative template.

A template gives each role its marks and whether its text is trained on. The machine
checks the order of turns, the template turns each turn into segments (mark, text,
mark) with a loss flag each, and the segments of a conversation joined are the formatted
text. Control strings inside texts are broken by a backslash after their first
character, backslashes are doubled, so the formatted text can be read back exactly.

Everything is a DataFrame expression. A conversation is one output row, so its turns
meet in one row; conversations share nothing, and copies of one are separate rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"


@dataclass(frozen=True)
class RoleMarks:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks by role, marks of turns with any other role, and the machine over roles.

    ``moves`` maps (state, role) to the next state; what is missing is an error. A
    conversation is valid if it ends in one of ``accepts``.
    """

    roles: Mapping[str, RoleMarks]
    other_open: str = "[TURN]"
    other_named: str = "[AS]"
    other_close: str = "[/TURN]"
    start: str = "start"
    moves: Mapping[tuple[str, str], str] = field(default_factory=dict)
    accepts: tuple[str, ...] = ()

    @property
    def controls(self) -> list[str]:
        marks = [m for r in self.roles.values() for m in (r.open, r.close)]
        return sorted({*marks, self.other_open, self.other_named, self.other_close})

    def __post_init__(self) -> None:
        opens = [r.open for r in self.roles.values()] + [self.other_open]
        if len(set(opens)) != len(opens):
            raise ValueError("every role needs an opening mark of its own")
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("marks have two characters or more and no backslash")
        if any(a != b and a in b for a in self.controls for b in self.controls):
            raise ValueError("no mark may be part of another")


INSTRUCT = ChatTemplate(
    roles={
        "system": RoleMarks("<<SYS>>", "<</SYS>>"),
        "user": RoleMarks("[INST]", "[/INST]"),
        "assistant": RoleMarks("<s>", "</s>", loss=True),
    },
    moves={
        ("start", "system"): "primed",
        ("start", "user"): "asked",
        ("primed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    accepts=("answered",),
)


def _any_of(strings: list[str]) -> str:
    return "|".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", s) for s in strings)


def escape(text: Column, template: ChatTemplate) -> Column:
    """Double backslashes, then break every control string after its first character."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    broken = F.regexp_replace(doubled, f"(?s)(?=(?:{_any_of(template.controls)}))(.)", r"$1\\")
    return F.when(F.rlike(text, F.lit(r"[\\" + "".join({re.sub(r"([^A-Za-z0-9])", r"\\\1", c[0]) for c in template.controls}) + "]")), broken).otherwise(text)


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _segments(role: Column, text: Column, template: ChatTemplate) -> Column:
    """Segments of one turn: opening mark, escaped text, closing mark."""
    body = escape(text, template)
    named = F.concat(F.lit(template.other_open), escape(role, template), F.lit(template.other_named))
    out = F.array(_segment(named, False), _segment(body, False), _segment(F.lit(template.other_close), False))
    for name, marks in template.roles.items():
        own = F.array(
            _segment(F.lit(marks.open), False), _segment(body, marks.loss), _segment(F.lit(marks.close), False)
        )
        out = F.when(role == name, own).otherwise(out)
    return out


def _machine(template: ChatTemplate, turns: Column) -> Column:
    """The state after the last turn; ``error`` once no move fits."""
    steps = F.create_map(*[
        F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\x00{role}", to)
    ])
    return F.aggregate(
        turns,
        F.lit(template.start),
        lambda state, turn: F.coalesce(
            F.try_element_at(steps, F.concat(state, F.lit("\x00"), turn["role"])), F.lit(ERROR)
        ),
    )


def format_chats(
    turns: DataFrame, template: ChatTemplate = INSTRUCT, *, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv``, n_turns, state, valid, segments, formatted, loss_spans.

    ``segments`` is an array of (text, loss); ``loss_spans`` gives start and length, in
    characters of ``formatted``, of the texts trained on. Turns are ordered by turn (null
    first), then role, then text, so ties and repeated rows have one order and all are
    kept. A null text is empty, a null role is the empty role, and a null conversation
    id is a conversation of its own. Roles the template does not name are formatted with
    its marks for other roles. Invalid orders are formatted too, with valid = false. Other
    columns are left out; an empty table gives no rows.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    made = whole.select(
        "conv",
        F.size("turns").cast("long").alias("n_turns"),
        _machine(template, F.col("turns")).alias("state"),
        F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template))).alias("segments"),
    )
    # Runs over the segments once, carrying the length so far.
    spans = F.aggregate(
        "segments",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.char_length(s["text"])).alias("at"),
            F.when(
                s["loss"],
                F.array_append(
                    acc["spans"], F.struct(acc["at"].alias("start"), F.char_length(s["text"]).alias("length"))
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return made.select(
        F.col("conv").alias(conv),
        "n_turns",
        "state",
        F.col("state").isin(list(template.accepts)).alias("valid"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(formatted: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """Array of (role, text) read back from a formatted text."""
    opens = [r.open for r in template.roles.values()] + [template.other_open]
    closes = [r.close for r in template.roles.values()] + [template.other_close]
    pattern = f"(?s)({_any_of(opens)})(.*?)({_any_of(closes)})"
    marks = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2))
    names = F.create_map(*[F.lit(x) for name, r in template.roles.items() for x in (r.open, name)])

    def turn(mark: Column, body: Column) -> Column:
        known = F.try_element_at(names, mark)
        other = F.substring_index(body, template.other_named, 1)
        rest = F.substr(body, F.char_length(other) + F.lit(len(template.other_named) + 1))
        return F.struct(
            F.coalesce(known, unescape(other)).alias("role"),
            unescape(F.when(known.isNull(), rest).otherwise(body)).alias("text"),
        )

    return F.zip_with(marks, bodies, turn)


def digest(chats: DataFrame, template: ChatTemplate = INSTRUCT, *, conv: str = "conv_id") -> DataFrame:
    """Counts and SHA-256 digests read back from ``formatted`` and ``loss_spans``."""
    read = chats.select(
        F.col(f"`{conv}`").alias("conv"),
        "valid",
        "formatted",
        read_turns(F.col("formatted"), template).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
            ),
            "",
        ).alias("trained"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("conv").alias(conv),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
