"""Spans of regular expressions in texts, as DataFrame expressions.

Positions are code points, ends exclusive. The engine's pieces between matches
and the matches themselves alternate, so a match's start is the sum of the
lengths before it: one pass over the matches, no search from the start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def with_spans(df: DataFrame, name: str, pattern: str, possible: Column, valid: Callable[[Column], Column]) -> DataFrame:
    """Adds column ``name``: the valid ones of the leftmost non-overlapping
    matches in ``text``, in order. ``possible`` is a cheap necessary condition."""
    m, g = f"_{name}_m", f"_{name}_g"
    none = F.array().cast("array<string>")
    df = df.withColumn(m, F.when(possible, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.transform(F.split("text", pattern, -1), lambda x: F.char_length(x))))
    empty = F.array().cast(SPAN)

    def step(acc: Column, i: Column) -> Column:
        value = F.get(F.col(m), i)
        start = acc["at"] + F.get(F.col(g), i)
        end = start + F.char_length(value)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), value.alias("value")))
        return F.struct(end.alias("at"), F.when(valid(value), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return df.withColumn(name, F.when(F.size(m) > 0, found).otherwise(empty)).drop(m, g)


def labels(kind: str, spans: Column) -> Column:
    """kind:start:end of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def overlaps(start: Column, end: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def mask(text: Column, spans: Column) -> Column:
    """The text with each span (ordered, not overlapping; struct with start, end
    and tag) replaced by its tag."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, state, lambda acc, s: F.struct(
        s["end"].alias("at"), F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), s["tag"]).alias("out")),
        lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.char_length(text) - acc["at"])))
    return done
