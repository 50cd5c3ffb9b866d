"""Spans of pattern matches as Spark expressions: positions, joined text, digests, masking.

Spark has no expression for match positions. Matches are put between marks, the text is split at the
marks, and the lengths of the pieces give the positions (code points, end exclusive).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\u0001"
#: Stands for MARK where a text has it; no pattern here matches either of them.
OTHER = "\u0002"
SPAN = "array<struct<start:int,kind:string,end:int,value:string>>"


def whole_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def matches(text: Column, kind: str, pattern: str, keep: Callable[[Column], Column], when: Column) -> Column:
    """Spans of the leftmost non-overlapping matches of ``pattern`` that ``keep`` accepts, by start.

    ``text`` is not null; ``when`` is a cheap test that every text with a match passes. The pattern must
    match the same with MARK as with any other character that it does not know.
    """
    clean = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, OTHER)).otherwise(text)
    marked = F.when(when, F.regexp_replace(clean, f"({pattern})", f"{MARK}$1{MARK}"))
    pieces = F.split(marked, MARK, -1)
    empty = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), empty.alias("found"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.char_length(piece)
        span = F.struct(
            state["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece.alias("value")
        )
        taken = state["hit"] & keep(piece)
        found = F.when(taken, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), (~state["hit"]).alias("hit"), found.alias("found"))

    return F.coalesce(F.aggregate(pieces, start, step, lambda state: state["found"]), empty)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans).cast("binary"), 256)


def masked(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """``text`` with each span replaced by ``label`` of it; of overlapping spans the first one counts,
    and the part of a later one that sticks out is removed with it."""
    ordered = F.array_sort(spans)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        more = F.when(s["start"] >= acc["at"], F.array(gap, label(s))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], more).alias("parts"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.lit(2147483647)))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, state, step, finish)).otherwise(text)
