"""Chat formatting by a declarative template with a loss flag per segment.

A conversation's turns, in order, run through a finite-state machine over roles
and become segments: what opens a turn, its text, what closes it.  Only texts of
``loss_roles`` carry the loss flag.  Control strings cannot occur inside a role or
text: ``&`` and ``<|`` are escaped, and ``read_turns`` gives the turns back.

Defined cases: a null text or role is empty; turns sort by (turn, role, text), null
turns first; repeated rows are turns of their own; a null conv_id is a
conversation of its own; a conversation out of order is formatted all the same and
has valid = false; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow

ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&nl;"))


@dataclass(frozen=True)
class Template:
    """How turns are marked, which roles are learned, and which role may follow which."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, pairs=ESCAPES) -> Column:
    return _replaced(text, pairs)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(pairs)])


def valid_order(roles: Column, template: Template) -> Column:
    """Whether the machine accepts the roles: a move for each, ending in a final state."""
    moves = F.create_map(
        *(
            F.lit(part)
            for state, nexts in template.moves.items()
            for role in nexts
            for part in (f"{state}\n{role}", role)
        )
    )
    state = F.aggregate(
        roles,
        F.lit(template.start),
        lambda s, role: F.coalesce(
            F.try_element_at(moves, F.concat(s, F.lit("\n"), role)), F.lit("")
        ),
    )
    return state.isin(*template.final)


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """(conv_id, n_turns, valid, segments of (text, loss), formatted) per conversation."""
    turns = narrow(rows, conv_id="bigint", turn="bigint", role="string", text="string")
    turns = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("one"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))

    def parts(one: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        role = escape(one["role"], ROLE_ESCAPES)
        return F.array(
            segment(F.concat(F.lit(template.opening), role, F.lit(template.after_role)), F.lit(False)),
            segment(escape(one["text"]), one["role"].isin(*template.loss_roles)),
            segment(F.lit(template.closing), F.lit(False)),
        )

    formed = whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        valid_order(F.col("turns.role"), template).alias("valid"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    return formed.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:  # noqa: B008
    """The (role, text) turns of a formatted conversation."""
    pieces = F.split(formatted, re.escape(template.opening), -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, template.after_role, 1)
        first = F.char_length(role) + len(template.after_role) + 1
        length = F.char_length(piece) - F.char_length(role) - len(template.after_role)
        text = F.substring(piece, first, length - len(template.closing))
        return F.struct(
            unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text")
        )

    return F.transform(F.slice(pieces, 2, F.size(pieces)), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"])), "")
