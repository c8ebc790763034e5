"""Chat formatting: a role automaton and a declarative template.

A template names the markers around a turn, the roles the loss covers and the automaton's
edges. Each conversation becomes a list of segments ``(text, loss)``; joined, they are the
formatted text. Control strings inside texts are escaped, so markers occur only where the
template puts them, and ``read_turns`` gets every turn back.

Nulls: a null text or role is empty, a null conversation id is a conversation of its own.
Turns are ordered by turn (null first), then role and text, so repeated rows and ties have one
order; repeated rows are repeated turns. All conversations are formatted; ``valid`` and
``bad_turn`` (1-based position of the first turn the automaton refuses, else null) report on the
order of roles. Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REFUSED = "start", "refused"


@dataclass(frozen=True)
class Template:
    """``edges``: role -> roles that may follow; ``start`` stands before the first turn.
    ``final``: roles that may be last. ``opens`` and ``closes`` begin with the control prefix
    ``<|`` and surround a turn's role and text."""

    opens: str = "<|im_start|>"
    after_role: str = "\n"
    closes: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    edges: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    r"""Doubles every backslash, then writes ``<|`` as ``<\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    r"""Inverse of ``escape``. An inserted backslash stands between ``<`` and ``|``, where a
    doubled one never is alone, so the two replacements undo each other's work exactly."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def walk(turns: Column, template: Template) -> Column:
    """Runs the automaton: struct (state, at, bad) after the last turn."""
    edges = [(a, b) for a, following in template.edges.items() for b in following]
    table = F.create_map(*[F.lit(x) for a, b in edges for x in (f"{a}>{b}", b)])

    def step(seen: Column, turn: Column) -> Column:
        key = F.concat(seen["state"], F.lit(">"), turn["role"])
        state = F.coalesce(F.try_element_at(table, key), F.lit(REFUSED))
        at = seen["at"] + 1
        bad = F.coalesce(seen["bad"], F.when(state == REFUSED, at))
        return F.struct(state.alias("state"), at.alias("at"), bad.alias("bad"))

    first = F.struct(
        F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad")
    )
    return F.aggregate(turns, first, step)


def segments_of(turn: Column, template: Template) -> Column:
    """A turn's three segments. The role is URL-encoded, which leaves plain names as they are
    and keeps line ends and markers out of it."""
    head = F.concat(
        F.lit(template.opens), F.url_encode(turn["role"]), F.lit(template.after_role)
    )
    return F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(
            escape(turn["text"]).alias("text"),
            turn["role"].isin(*template.trained).alias("loss"),
        ),
        F.struct(F.lit(template.closes).alias("text"), F.lit(False).alias("loss")),
    )


def format_conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments, formatted, valid, bad_turn.

    A conversation is one record of the result, so its turns meet in one task.
    """
    turn = F.struct(
        rows["turn"].alias("turn"),
        F.coalesce(rows["role"], F.lit("")).alias("role"),
        F.coalesce(rows["text"], F.lit("")).alias("text"),
    )
    turns = rows.groupBy(rows["conv_id"].alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    walked = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: segments_of(t, template))).alias("segments"),
        walk(F.col("turns"), template).alias("walked"),
    )
    return walked.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("walked.bad").isNull() & F.col("walked.state").isin(*template.final)).alias("valid"),
        F.col("walked.bad").alias("bad_turn"),
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """Array of (role, text) parsed from a formatted text alone."""
    opens = "\\Q" + template.opens + "\\E"
    pieces = F.split(formatted, opens)
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, template.after_role)
        body = F.substr(piece, cut + len(template.after_role))
        kept = F.char_length(body) - len(template.closes)
        return F.struct(
            F.url_decode(F.substr(piece, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substr(body, F.lit(1), kept)).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")
