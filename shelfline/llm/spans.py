"""Places of regular expressions in texts, with built-in functions only.

Spark has no function that returns match positions, but splitting a text at a pattern and extracting all matches
walk through the same matches: positions are running lengths of the pieces. Positions are code points, ends are
exclusive, matches are leftmost and do not overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,stop:bigint,kind:string,rank:int,value:string,part:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def match_spans(text: Column, pattern: Column | str, kind: str, rank: int, part: int = 0, guard: Column | None = None) -> Column:
    """Spans of all matches: start, stop, kind, rank of the kind, matched value and the group ``part``.

    ``guard`` is a cheap condition that every text with a match meets; other texts are not searched.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.regexp_extract_all(text, pattern, F.lit(part)) if part else values
    pieces = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("bigint"))
    rows = F.arrays_zip(values.alias("value"), parts.alias("part"), F.slice(pieces, F.lit(1), F.size(values)).alias("gap"))

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + row["gap"]
        stop = start + F.length(row["value"])
        span = F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                        row["value"].alias("value"), row["part"].alias("part"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    empty = F.struct(F.lit(0).cast("bigint").alias("at"), no_spans().alias("spans"))
    found = F.aggregate(rows, empty, step, lambda acc: acc["spans"])
    return F.when(F.coalesce(guard if guard is not None else F.regexp_like(text, pattern), F.lit(False)), found).otherwise(no_spans())


def by_start(spans: Column) -> Column:
    """Spans ordered by start, then kind."""
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"], s["value"], s["part"]))),
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"),
                           s["rank"].alias("rank"), s["value"].alias("value"), s["part"].alias("part")))


def by_kind(spans: Column) -> Column:
    """Spans ordered by kind, then start."""
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"], s["start"], s["stop"], s["kind"]))),
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans as they stand, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, mark) -> Column:
    """``text`` with its spans (ordered by start) replaced by ``mark(span)``; what overlaps is replaced once."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["stop"] > acc["at"]
        kept = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], kept, mark(s))).otherwise(acc["out"]).alias("out"))

    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, empty, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))))
