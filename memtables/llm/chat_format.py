"""Chat formatting by a finite-state machine over roles. DataFrame functions only.

A template (:data:`TEMPLATE`) declares for each role the strings before and
after a text, whether the text counts for the loss, and the role's transitions.
Each control string has exactly one of the characters ``<`` or ``[``, at its
start. Texts and the names of other roles are escaped: ``\\`` becomes ``\\0``,
``<`` becomes ``\\1``, ``[`` becomes ``\\2``, in names ``>`` becomes ``\\3``. So no text can hold a control
string, the output splits into its parts at every ``<`` and ``[``, and
unescaping gives back every text exactly.

The machine walks the roles of a conversation: ``state`` is the last role's state,
``error_turn`` (from 0) is the first turn that has no transition, and
``valid`` says that there is none and the last state accepts. Invalid
conversations are formatted too; the caller may filter them. Turns whose role
the template doesn't know (or null) get the ``other`` markers with the role's name.

:func:`format_conversations` returns per conversation the array ``segments``
(``text``, ``loss``): markers and escaped texts in order, the loss flag on assistant
texts only. ``formatted`` is their concatenation. :func:`read_back` parses the
formatted string alone.

Defined results: null texts are empty; turns stand in order of turn, then role, then text (nulls
first), repeated rows each count as a turn; the null conv_id is one conversation; an empty
table gives no rows; extra columns are not read. A conversation is one output
row, so its size is the only bound on what a task holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool = False


#: Markers by role; ``{role}`` in ``other`` stands for the escaped name.
TEMPLATE: dict[str, Role] = {
    "system": Role("<sys>", "</sys>\n"),
    "user": Role("[INST] ", " [/INST]"),
    "assistant": Role("<s>", "</s>\n", loss=True),
    "other": Role("<turn:{role}>", "</turn>\n"),
}
#: state -> role -> next state; a missing entry is an error.
TRANSITIONS: dict[str, dict[str, str]] = {
    "start": {"system": "told", "user": "asked"},
    "told": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
ACCEPTING = ("answered",)
ERROR = "error"

ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))


#: In the name of another role also the end of its marker.
NAME_ESCAPES = (*ESCAPES, (">", "\\3"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _by_role(role: Column, known, other: Column) -> Column:
    out = None
    for name, r in TEMPLATE.items():
        if name != "other":
            out = F.when(role == name, known(r)) if out is None else out.when(role == name, known(r))
    return out.otherwise(other)


def next_state(state: Column, role: Column) -> Column:
    """The machine's step; no way on leads to ``error``, which is kept for good."""
    out = F.lit(ERROR)
    for at, ways in TRANSITIONS.items():
        for name, to in ways.items():
            out = F.when((state == at) & (role == name), F.lit(to)).otherwise(out)
    return out


def format_conversations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``segments``, ``formatted``, ``valid``, ``error_turn`` of each conversation."""
    other = TEMPLATE["other"]
    start, end = other.before.split("{role}")
    row = turns.select(
        F.col(conv), F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    talk = row.groupBy(conv).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        before = _by_role(t["role"], lambda r: F.lit(r.before),
                          F.concat(F.lit(start), escape(F.coalesce(t["role"], F.lit("")), NAME_ESCAPES), F.lit(end)))
        after = _by_role(t["role"], lambda r: F.lit(r.after), F.lit(other.after))
        loss = _by_role(t["role"], lambda r: F.lit(r.loss), F.lit(other.loss))
        return F.array(segment(before, no), segment(escape(t["text"]), loss), segment(after, no))
    no = F.lit(False)
    walk = F.aggregate(
        F.col("turns.role"), F.struct(F.lit("start").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("error")),
        lambda a, r: F.struct(
            next_state(a["state"], r).alias("state"), (a["n"] + 1).alias("n"),
            F.when(a["error"].isNotNull(), a["error"]).when(next_state(a["state"], r) == ERROR, a["n"]).alias("error")))
    out = talk.select(
        conv, walk.alias("walk"),
        F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.select(
        conv, "segments", F.array_join("segments.text", "").alias("formatted"),
        (F.col("walk.error").isNull() & F.col("walk.state").isin(*ACCEPTING)).alias("valid"),
        F.col("walk.error").alias("error_turn"))


def read_back(formatted: Column) -> Column:
    """The turns (``role``, ``text``) that a formatted string holds."""
    parts = F.filter(F.split(formatted, r"(?=[<\[])"), lambda p: p != "")
    closing = [r.after.strip() for r in TEMPLATE.values()]
    opens = F.filter(parts, lambda p: ~_any(p, closing))
    start, end = TEMPLATE["other"].before.split("{role}")

    def turn(p: Column) -> Column:
        name, body = None, None
        for role, r in TEMPLATE.items():
            if role != "other":
                hit = p.startswith(r.before)
                # the user's closing marker begins with a space, which ends the text's part
                rest = F.substring(p, F.lit(len(r.before) + 1), F.length(p))
                lead = len(r.after) - len(r.after.lstrip(" "))
                if lead:
                    rest = F.substring(rest, F.lit(1), F.length(rest) - F.lit(lead))
                name = F.when(hit, F.lit(role)) if name is None else name.when(hit, F.lit(role))
                body = F.when(hit, rest) if body is None else body.when(hit, rest)
        cut = F.instr(p, end)
        name = name.otherwise(F.substring(p, F.lit(len(start) + 1), cut - F.lit(len(start) + 1)))
        body = body.otherwise(F.substring(p, cut + F.lit(len(end)), F.length(p)))
        return F.struct(unescape(name, NAME_ESCAPES).alias("role"), unescape(body).alias("text"))
    return F.transform(opens, turn)


def _any(p: Column, starts: list[str]) -> Column:
    out = F.lit(False)
    for s in starts:
        out = out | p.startswith(s)
    return out


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
