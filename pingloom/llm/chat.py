"""Chat formatting: a finite-state machine over roles, and a declarative template that yields text segments.

Everything is DataFrame and SQL functions. A template names the control strings, the roles whose text counts for
the loss, and the allowed moves from role to role.

Defined cases: a null role or text is empty; rows of equal turn are ordered by role and text, rows without a turn
come first; rows that repeat stay; a null ``conv_id`` is a conversation of its own; no rows give no rows. Columns
other than the four that are named are ignored. A conversation is one row of output, so one task holds one
conversation, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``before`` + role + ``between`` + text + ``after`` for each turn.

    ``moves`` maps the state (the role of the last turn, "" at the start) to the roles that may follow;
    ``final`` are the roles a conversation may end with, ``learned`` those whose text is under the loss mask.
    """

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    final: tuple[str, ...] = ("user", "assistant", "tool")
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user", "tool"),
        "tool": ("assistant",),
    })


CHATML = Template()

# "<|" opens a control string. Inside a text one backslash is put between the two characters, after those that are
# already there, so "<|" never occurs in an escaped text and taking one backslash away restores it.
_OPENING = r"<(\\*)\|"
_ESCAPED = r"<\\(\\*)\|"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPENING, r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "<$1|")


def _escape_role(role: Column) -> Column:
    """A role ends at the line break, so its backslashes and line breaks are written as ``\\b`` and ``\\n``."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _may_follow(state: Column, role: Column, template: Template) -> Column:
    allowed = F.lit(False)
    for before, after in template.moves.items():
        allowed = allowed | ((state == before) & role.isin(*after))
    return allowed


def order_check(turns: Column, template: Template = CHATML) -> Column:
    """Run the machine over the roles: (state, number of turns read, number of the first turn out of order, or null)."""
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("wrong"))

    def step(acc: Column, turn: Column) -> Column:
        ok = _may_follow(acc["state"], turn["role"], template)
        return F.struct(
            turn["role"].alias("state"),
            (acc["n"] + 1).alias("n"),
            F.coalesce(acc["wrong"], F.when(~ok, acc["n"])).alias("wrong"),
        )

    return F.aggregate(turns, start, step)


def format_chat(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (array of text and loss flag), ``formatted``, ``valid``, ``wrong_turn``.

    Conversations whose turns are out of order are formatted as they are and marked, not dropped.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("row"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    def segments(turn: Column) -> Column:
        role, text = _escape_role(turn["role"]), escape(turn["text"])
        return F.array(
            F.struct(F.concat(F.lit(template.before), role, F.lit(template.between)).alias("text"), F.lit(False).alias("loss")),
            F.struct(text.alias("text"), turn["role"].isin(*template.learned).alias("loss")),
            F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
        )

    checked = grouped.withColumn("check", order_check(F.col("turns"), template))
    return checked.select(
        "conv_id",
        F.flatten(F.transform("turns", segments)).alias("segments"),
        (F.col("check.wrong").isNull() & F.col("check.state").isin(*template.final)).alias("valid"),
        F.col("check.wrong").alias("wrong_turn"),
    ).select(
        "conv_id", "segments", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        "valid", "wrong_turn",
    )


def read_chat(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) written in a formatted conversation."""
    parts = F.filter(F.split(formatted, "\\Q" + template.before + "\\E"), lambda p: p != "")

    def turn(part: Column) -> Column:
        cut = F.instr(part, template.between)
        begin = cut + len(template.between)
        text = F.substring(part, begin, F.length(part) - begin - len(template.after) + 1)
        return F.struct(_unescape_role(F.substring(part, F.lit(1), cut - 1)).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))
