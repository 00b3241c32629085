"""Chat formatting: a declarative template, a finite-state machine over roles, and text
segments with loss flags. DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import q


@dataclass(frozen=True)
class Turn:
    """How a role's turn opens and closes, and whether its text counts for the loss. The
    opening is ``[TAG]`` and a blank."""

    tag: str
    close: str
    loss: bool


@dataclass(frozen=True)
class Template:
    """Roles with their turns, and the states of the turn order.

    Texts are escaped so that no control string (an opening, a closing) stands in them and
    ``read_turns`` gives them back; templates whose strings are ambiguous are refused
    (``ValueError``). ``steps`` maps (state, role) to the next state; a missing step is an error. A
    conversation is valid if it ends in one of ``final``. Roles without a turn of their
    own are written as ``[ROLE:hex]`` and have no step."""

    turns: Mapping[str, Turn] = field(default_factory=lambda: {
        "system": Turn("SYS", " [/SYS]", False),
        "user": Turn("INST", " [/INST]", False),
        "assistant": Turn("OUT", "</s>", True),
    })
    other_close: str = " [/ROLE]"
    #: Pattern of further strings to hide inside texts: its first character, as a group, and
    #: a lookahead.
    hidden: str = ""
    start: str = "start"
    steps: Mapping[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        closings = list(dict.fromkeys([*(t.close for t in self.turns.values()), self.other_close]))
        openings = [f"[{t.tag}] " for t in self.turns.values()]
        bad = [c for c in [*closings, *openings] if "\\" in c or len(c) < 2]
        if bad:
            raise ValueError(f"control strings need two characters and no backslash: {bad}")
        if any(not t.tag or re.fullmatch("ROLE:[0-9A-F]*", t.tag) for t in self.turns.values()):
            raise ValueError("a tag is empty or written like that of a role without a turn")
        if any(a.startswith(b) for i, a in enumerate(openings) for k, b in enumerate(openings) if i != k):
            raise ValueError("a turn's opening begins with another one")
        for a in closings:
            for b in closings:
                # a text's end and the closing behind it must not make up a closing
                if (a != b and b in a) or any(b.startswith(a[k:]) for k in range(1, len(a))):
                    raise ValueError(f"closings {a!r} and {b!r} overlap")


def _control(template: Template) -> str:
    """Pattern of the place behind which a backslash breaks a control string: its first
    character that is not blank and not its last, as a group, and the rest as a lookahead."""
    strings = [*(t.close for t in template.turns.values()), template.other_close, *(f"[{t.tag}]" for t in template.turns.values()), "[ROLE:"]
    parts = [template.hidden] if template.hidden else []
    for c in dict.fromkeys(strings):
        at = next((k for k in range(len(c) - 1) if not c[k].isspace()), 0)
        parts.append(f"({re.escape(c[at])})(?={re.escape(c[at + 1:])})")
    return "|".join(parts)


#: Whatever looks like a control string of the default template, closed or not.
DEFAULT = Template(hidden=r"([\[<])(?=/?(?:INST|SYS|OUT|ROLE|s)[\]>:])")
ERROR = "error"


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Backslashes doubled, and one put behind the character of control strings that
    ``_control`` names."""
    pattern = _control(template)
    groups = "".join(f"${k + 1}" for k in range(pattern.count(")(?=")))
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), pattern, groups + "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _case(value: Column, cases: Mapping[str, Column], otherwise: Column) -> Column:
    out = None
    for key, result in cases.items():
        out = F.when(value == key, result) if out is None else out.when(value == key, result)
    return otherwise if out is None else out.otherwise(otherwise)


def _segments(turn: Column, template: Template) -> Column:
    """Opening, escaped text, closing."""
    role = turn["role"]
    tag = _case(role, {r: F.lit(t.tag) for r, t in template.turns.items()},
                F.concat(F.lit("ROLE:"), F.hex(role.cast("binary"))))
    close = _case(role, {r: F.lit(t.close) for r, t in template.turns.items()}, F.lit(template.other_close))
    loss = role.isin([r for r, t in template.turns.items() if t.loss])
    part = lambda text, counts: F.struct(text.alias("text"), counts.alias("loss"))
    return F.array(part(F.concat(F.lit("["), tag, F.lit("] ")), F.lit(False)),
                   part(escape(turn["text"], template), loss), part(close, F.lit(False)))


def _state(roles: Column, template: Template) -> Column:
    """The machine's state after all roles."""
    step = F.create_map(*[x for (s, r), to in template.steps.items() for x in (F.lit(f"{s} {r}"), F.lit(to))])
    return F.aggregate(roles, F.lit(template.start),
                       lambda s, r: F.coalesce(F.try_element_at(step, F.concat(s, F.lit(" "), r)), F.lit(ERROR)))


def format_chats(turns: DataFrame, template: Template = DEFAULT, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col``, ``segments`` (array of ``text``, ``loss``),
    ``formatted`` (their texts joined), ``state`` and ``valid``.

    Turns go by number, then role, then text, null numbers first; repeated rows are turns
    of their own. A null text or role is empty, a null conversation id is one conversation.
    An invalid order is formatted all the same and flagged. A conversation's text is one
    value, so it has to fit a row; the shuffle only moves its turns."""
    rows = turns.select(q(conv_col).alias("__conv"), F.struct(
        q(turn_col).alias("turn"), F.coalesce(q(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text")).alias("__turn"))
    chats = rows.groupBy("__conv").agg(F.sort_array(F.collect_list("__turn")).alias("__turns"))
    chats = chats.select("__conv", F.flatten(F.transform("__turns", lambda t: _segments(t, template))).alias("segments"),
                         _state(F.transform("__turns", lambda t: t["role"]), template).alias("state"))
    return chats.select(F.col("__conv").alias(conv_col), "segments",
                        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        "state", F.col("state").isin(*template.final).alias("valid"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns of a formatted text: array of ``role``, ``text`` (unescaped), ``loss``."""
    tags = "|".join([re.escape(t.tag) for t in template.turns.values()] + ["ROLE:[0-9A-F]*"])
    quoted = [re.escape(c) for c in [*(t.close for t in template.turns.values()), template.other_close]]
    pattern = F.lit(rf"(?s)\[({tags})\] (.*?)(?:{'|'.join(quoted)})")
    by_tag = {t.tag: r for r, t in template.turns.items()}
    lossy = [t.tag for t in template.turns.values() if t.loss]

    def turn(tag: Column, text: Column) -> Column:
        other = F.decode(F.unhex(F.substring(tag, 6, 1 << 30)), "UTF-8")
        return F.struct(_case(tag, {t: F.lit(r) for t, r in by_tag.items()}, other).alias("role"),
                        unescape(text).alias("text"), tag.isin(lossy).alias("loss"))

    return F.zip_with(F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2)), turn)
