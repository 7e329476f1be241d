"""Text primitives over columns: regex matches with offsets, lines, windows around a match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches of a text that are folded together.
FOLD = 256
SPAN = "array<struct<start:int,end:int,text:string>>"


def matches(text: Column, pattern: Column | str) -> Column:
    """All leftmost non-overlapping matches as array of struct(start, end, text), offsets in code points from 0.

    The pattern may be a column, so that one join with a catalog covers all its rules. It must not match the empty string.
    A fold copies what it has at each step, so matches are folded in parts of FOLD, and then the parts."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    steps = F.filter(F.arrays_zip(F.regexp_extract_all(text, p, F.lit(0)).alias("m"), F.split(text, p, F.lit(-1)).alias("b")), lambda s: s["m"].isNotNull())
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(steps), F.lit(1)) - 1) / FOLD).cast("int")), lambda i: F.slice(steps, i * FOLD + 1, FOLD))
    empty = F.array().cast(SPAN)

    def span(start: Column, end: Column, found: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), found.alias("text"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["b"])
        end = start + F.length(s["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span(start, end, s["m"]))).alias("out"))

    def whole(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda x: span(acc["at"] + x["start"], acc["at"] + x["end"], x["text"]))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    folded = F.transform(parts, lambda part: F.aggregate(part, F.struct(F.lit(0).alias("at"), empty.alias("out")), step))
    found = F.flatten(F.aggregate(folded, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), whole, lambda acc: acc["out"]))
    return F.when(F.regexp_like(text, p), found).otherwise(empty)


def line_of(text: Column, offset: Column) -> Column:
    """Number of the line that holds the offset, from 1."""
    before = text.substr(F.lit(1), offset)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def window(text: Column, start: Column, end: Column, around: int) -> Column:
    """The text from around characters before start to around after end."""
    low = F.greatest(F.lit(0), start - around)
    return text.substr(low + 1, end + around - low)


def any_of(text: Column, words: list[str]) -> Column:
    """The words that the lower-cased text holds, in their order."""
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(text), w))


def choose(key: Column, catalog: dict, default=None) -> Column:
    """A small fixed mapping as an expression."""
    out = F.create_map(*[F.lit(x) for kv in catalog.items() for x in kv])[key]
    return out if default is None else F.coalesce(out, F.lit(default))
