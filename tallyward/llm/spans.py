"""Where a pattern matches in a text, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
SPAN = f"array<struct<start:int,end:int,value:string,before:string,after:string>>"


def with_located(df: DataFrame, text: str, pattern: str, name: str, if_any: Column | None = None) -> DataFrame:
    """Adds ``name``: the leftmost non-overlapping matches of ``pattern`` in ``text``, in order.

    Each has start and end (code points, end exclusive), value, and up to 40 characters of the text since the match before
    it (``before``) and until the next one (``after``). The matches and the gaps between them (the text split at the
    pattern) make up the text, so running lengths give the places. ``if_any`` is a cheap condition that every text with
    a match meets. A NULL text has no matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if if_any is not None:
        found = F.when(if_any, found)
    state = f"struct<at:int,out:{SPAN}>"

    def step(got: Column, i: Column) -> Column:
        value, gap = F.get(F.col("_found"), i), F.get(F.col("_gaps"), i)
        start = got["at"] + F.char_length(gap)
        end = start + F.char_length(value)
        one = F.struct(
            start.alias("start"),
            end.alias("end"),
            value.alias("value"),
            F.right(gap, F.lit(CONTEXT)).alias("before"),
            F.left(F.get(F.col("_gaps"), i + 1), F.lit(CONTEXT)).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(got["out"], F.array(one)).alias("out")).cast(state)

    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("out")).cast(state)
    places = F.aggregate(F.sequence(F.lit(0), F.size("_found") - 1), start, step, lambda got: got["out"])
    return (
        df.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
        .withColumn("_gaps", F.when(F.size("_found") > 0, F.split(text, pattern, -1)))
        .withColumn(name, F.when(F.size("_found") > 0, places).otherwise(none))
        .drop("_found", "_gaps")
    )


def labelled(spans: Column, kind: str, order: int) -> Column:
    """Spans as (order, start, end, text ``kind:start:end``)."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(order).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label"),
        ),
    )


def joined(spans: Column) -> Column:
    """The labels of an ordered array of labelled spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: s["label"]), ",")
