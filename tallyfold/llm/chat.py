"""Chat formatting: turn order by a finite-state machine, segments with loss flags, and back.

A template declares the markers around roles and texts, the roles whose texts carry loss, and the
allowed steps from role to role. Inside roles and texts, marker strings are escaped reversibly, so
that the formatted string can be read back. Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """Markers contain no backslash, and none is part of another one or overlaps its own copies."""

    turn: str = "<turn>"
    text: str = "<text>"
    end: str = "</turn>"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    steps: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user",)})
    finals: tuple[str, ...] = ("assistant",)

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.turn, self.text, self.end


CHAT = Template()


def escape(text: Column, template: Template) -> Column:
    r"""A backslash becomes two, the k-th marker string a backslash and the digit k."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for k, marker in enumerate(template.markers):
        text = F.replace(text, F.lit(marker), F.lit(f"\\{k}"))
    return text


def unescape(text: Column, template: Template) -> Column:
    """The text before ``escape``: what stands between double backslashes has only marker codes."""
    def codes(part: Column) -> Column:
        for k, marker in enumerate(template.markers):
            part = F.replace(part, F.lit(f"\\{k}"), F.lit(marker))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), codes), "\\")


def _walk(roles: Column, template: Template) -> Column:
    """Struct of the state after the last role and the index of the first refused turn (or null)."""
    steps = F.create_map(*[F.lit(x) for state, after in template.steps.items() for role in after
                           for x in (f"{state}\n{role}", role)])
    start = F.struct(F.lit(template.start).alias("state"), F.lit(None).cast("int").alias("bad"),
                     F.lit(0).alias("at"))

    def step(now: Column, role: Column) -> Column:
        after = F.try_element_at(steps, F.concat(now["state"], F.lit("\n"), role))
        return F.struct(
            F.coalesce(after, now["state"]).alias("state"),
            F.coalesce(now["bad"], F.when(after.isNull(), now["at"])).alias("bad"),
            (now["at"] + 1).alias("at"))

    return F.aggregate(roles, start, step)


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row for each conv_id: conv_id, segments, formatted, valid, first_bad_turn.

    rows: conv_id, turn, role, text; other columns are left out. Turns are ordered by turn (nulls
    first), then role, then text; repeated rows are turns of their own. A null role or text is
    empty, a null conv_id is a conversation. segments: (text, loss), which in order make up
    ``formatted``; a text has a segment of its own, whose loss flag is that of its role. valid: the
    machine accepts every role and ends in a final state; refused conversations are formatted too,
    and first_bad_turn (from 0) is the first turn that the machine refused, null if none.
    A conversation is one row and so one task's work, whatever its number of turns.
    """
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = rows.select("conv_id", turn.alias("one")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("one")).alias("turns"))

    def segments(one: Column) -> Column:
        opening = F.concat(F.lit(template.turn), escape(one["role"], template),
                           F.lit(template.text))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(one["text"], template).alias("text"),
                     one["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")))

    end = _walk(F.transform("turns", lambda t: t["role"]), template)
    made = grouped.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
                          end.alias("end"))
    return made.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("end.bad").isNull() & F.col("end.state").isin(*template.finals)).alias("valid"),
        F.col("end.bad").alias("first_bad_turn"))


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """``turns`` (role, text) parsed from ``formatted``, and ``loss_texts`` from ``segments``."""
    def pattern(marker: str) -> str:
        return re.escape(marker)

    def parse(chunk: Column) -> Column:
        body = F.substring(chunk, len(template.turn) + 1, 2 ** 31 - 1)
        halves = F.split(body, pattern(template.text), 2)
        return F.struct(unescape(halves[0], template).alias("role"),
                        unescape(halves[1], template).alias("text"))

    pieces = F.split("formatted", pattern(template.end), -1)  # the last one is empty
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parse)
    loss = F.transform(F.filter("segments", lambda s: s["loss"]),
                       lambda s: unescape(s["text"], template))
    return formatted.withColumns({"turns": turns, "loss_texts": loss})
