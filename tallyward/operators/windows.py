"""Counts per key over tumbling and sliding event-time windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.hashing import salt
from tallyward.functions.timing import (
    Span,
    filter_rows,
    first_window_end,
    floor_to,
    last_window_end,
    micros,
    span_micros,
    span_text,
)

# A slice of a sliding count covers this many window lengths of one key's timeline.
_WINDOWS_PER_SLICE = 24

# A task that counts or ranks gets about so many (row, window) pairs, of which a row of a long window counts at most _PAIRS.
_PAIRS_PER_TASK, _PAIRS = 4_000_000, 8

# With up to this many windows per row it is cheaper to copy the rows (one shuffle less).
_COPY_UP_TO = 4


def windowed_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: Span,
    slide: Span | None = None,
    where: Column | None = None,
    early: bool = False,
    pairs_per_task: int = _PAIRS_PER_TASK,
) -> DataFrame:
    """Rows per (key, window), non-empty windows only: ``keys, window_start, window_end, cnt``.

    ``early`` is for streams in update mode, which report a window before it is final. Large tables with sliding windows
    are dealt over more tasks than the session's number, so that a task has some ``pairs_per_task`` (row, window) pairs.
    """
    keys, size_us = list(keys), span_micros(size)
    slide_us = span_micros(slide) if slide is not None else size_us
    df = filter_rows(df, where, ts)
    if df.isStreaming:
        return _stream_counts(df, keys, ts, size_us, slide_us, early)
    if slide_us == size_us:
        end = last_window_end(micros(ts), size_us, size_us)
        counted = df.groupBy(*keys, end.alias("_end")).agg(F.count("*").alias("cnt"))
    else:
        spans = _spans(df, keys, ts, size_us, slide_us)
        parts = _more_parts(spans, size_us, slide_us, pairs_per_task)
        counted = span_counts(spans, keys, "_first", "_last", size_us, slide_us, parts=parts)
    return with_bounds(counted, size_us)


def _more_parts(spans: DataFrame, size_us: int, slide_us: int, pairs_per_task: int) -> int | None:
    """The number of tasks for a table that is too large for the session's number, else None."""
    parts = math.ceil(spans.count() * min(math.ceil(size_us / slide_us), _PAIRS) / pairs_per_task)
    return parts if parts > int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(df: DataFrame, parts: int | None, *by: str) -> DataFrame:
    return df.repartition(parts, *by) if parts else df


def _stream_counts(df, keys, ts, size_us, slide_us, early) -> DataFrame:
    size, slide = span_text(size_us), span_text(slide_us)
    if early or size_us <= _COPY_UP_TO * slide_us or size_us % slide_us:
        counted = df.groupBy(*keys, F.window(ts, size, slide).alias("window")).agg(F.count("*").alias("cnt"))
    else:
        # Count panes of one slide first: a pane, not each of its rows, is copied to its size / slide windows.
        panes = df.groupBy(*keys, F.window(ts, slide).alias("pane")).agg(F.count("*").alias("_n"))
        windows = F.window(F.window_time("pane"), size, slide)
        counted = panes.groupBy(*keys, windows.alias("window")).agg(F.sum("_n").alias("cnt"))
    return counted.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "cnt"
    )


def windowed_aggregates(
    df: DataFrame, keys: Sequence[str], ts: str, size: Span, slide: Span | None = None, **aggregates: Column
) -> DataFrame:
    """Any aggregate functions per (key, window), also grouped pandas UDFs and streams.

    Rows are copied to their windows. For plain counts over long windows with a short slide ``windowed_counts`` is
    much cheaper.
    """
    window = F.window(ts, span_text(size), span_text(slide if slide is not None else size))
    grouped = df.groupBy(*keys, window.alias("window"))
    result = grouped.agg(*[column.alias(name) for name, column in aggregates.items()])
    return result.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *aggregates,
    )


def with_bounds(counted: DataFrame, size_us: int) -> DataFrame:
    """Replace ``_end`` (microseconds) by ``window_start`` and ``window_end`` timestamps."""
    rest = [c for c in counted.columns if c not in ("_end", "cnt")]
    return counted.select(
        *rest,
        F.timestamp_micros(F.col("_end") - F.lit(size_us)).alias("window_start"),
        F.timestamp_micros("_end").alias("window_end"),
        "cnt",
    )


def span_counts(
    spans: DataFrame,
    keys: Sequence[str],
    first: str,
    last: str,
    size_us: int,
    slide_us: int,
    weight: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """How many rows cover each window end (``_end``), for rows covering the ends ``first .. last``.

    With ``weight`` a row stands for so many, with ``parts`` the shuffles go to so many tasks.
    """
    keys, slide = list(keys), F.lit(slide_us)
    if size_us <= _COPY_UP_TO * slide_us:
        ends = F.explode(F.sequence(F.col(first), F.col(last), slide)).alias("_end")
        copies = _dealt(spans.select(*keys, *([weight] if weight else []), ends), parts, *keys, "_end")
        return copies.groupBy(*keys, "_end").agg((F.sum(weight) if weight else F.count("*")).alias("cnt"))
    plateaus = span_plateaus(spans, keys, first, last, size_us, slide_us, weight, parts)
    ends = F.sequence(F.col("_at"), F.col("_until") - slide, slide)
    return plateaus.select(*keys, F.explode(ends).alias("_end"), "cnt")


def span_plateaus(
    spans: DataFrame,
    keys: Sequence[str],
    first: str,
    last: str,
    size_us: int,
    slide_us: int,
    weight: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Runs of window ends ``_at`` (inclusive) to ``_until`` (exclusive) that are covered by the same ``cnt`` rows.

    With ``weight`` a row stands for so many, with ``parts`` the shuffles go to so many tasks.

    A row covers up to size / slide windows (720 for an hour every five seconds). Instead of copying
    rows, equal spans are counted first (map-side), each span becomes one +n and one -n step, and a
    running sum over the steps gives the count between two steps. Timelines are cut into slices, so one (key, slice)
    group has at most 2 x slice / slide steps however many rows the key has.
    """
    keys = list(keys)
    # Slices are aligned to the grid of window ends, which all have the same offset to the slide.
    slice_us = slide_us * math.ceil(_WINDOWS_PER_SLICE * size_us / slide_us)
    offset = size_us % slide_us

    def slice_of(end: Column) -> Column:
        return floor_to(end - F.lit(offset), slice_us) + F.lit(offset)

    cells = _dealt(spans, parts, *keys, first, last).groupBy(*keys, first, last).agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    slices = F.sequence(slice_of(F.col(first)), slice_of(F.col(last)), F.lit(slice_us))
    sliced = cells.select(*keys, first, last, "_n", F.explode(slices).alias("_slice"))
    slice_end = F.col("_slice") + F.lit(slice_us)
    up = F.struct(F.greatest(F.col(first), F.col("_slice")).alias("_at"), F.col("_n").alias("_step"))
    down = F.struct(F.least(F.col(last) + F.lit(slide_us), slice_end).alias("_at"), (-F.col("_n")).alias("_step"))
    steps = _dealt(sliced.select(*keys, "_slice", F.inline(F.array(up, down))), parts, *keys, "_slice")
    timeline = Window.partitionBy(*keys, "_slice").orderBy("_at")
    return steps.select(
        *keys,
        F.col("_at"),
        F.sum("_step").over(timeline).alias("cnt"),
        F.lead("_at").over(timeline).alias("_until"),
    ).filter("_until > _at AND cnt > 0")


def window_plateaus(
    df: DataFrame, keys: Sequence[str], ts: str, size: Span, slide: Span, where: Column | None = None
) -> DataFrame:
    """Sliding counts in short form: ``keys, first_end, last_end, windows, cnt``.

    One row per run of windows with the same count, for questions such as the peak or the number of windows above a
    level. Its size follows the rows, not the windows. Batch only.
    """
    size_us, slide_us = span_micros(size), span_micros(slide)
    spans = _spans(filter_rows(df, where, ts), keys, ts, size_us, slide_us)
    plateaus = span_plateaus(spans, keys, "_first", "_last", size_us, slide_us)
    return plateaus.select(
        *keys,
        F.timestamp_micros("_at").alias("first_end"),
        F.timestamp_micros(F.col("_until") - F.lit(slide_us)).alias("last_end"),
        F.expr(f"(_until - _at) div {slide_us}").alias("windows"),
        "cnt",
    )


def with_spans(df: DataFrame, ts: str, size_us: int, slide_us: int) -> DataFrame:
    """Adds the first and last window end of each row (``_first`` is larger for a row in no window)."""
    us = micros(ts)
    return df.withColumns(
        {"_first": first_window_end(us, size_us, slide_us), "_last": last_window_end(us, size_us, slide_us)}
    )


def _spans(df: DataFrame, keys: Sequence[str], ts: str, size_us: int, slide_us: int) -> DataFrame:
    spans = with_spans(df, ts, size_us, slide_us).select(*keys, "_first", "_last")
    return spans.filter("_first <= _last") if slide_us > size_us else spans


def salted_window_counts(
    df: DataFrame, ts: str, size: Span, spread_by: Sequence[str], parts: int = 16, where: Column | None = None
) -> DataFrame:
    """Rows per window through an explicit salted first stage: ``window_end, cnt``.

    Spark's map-side partial count already absorbs a hot window; the salt additionally bounds what one
    reduce task (or, on a stream, one state partition) receives for it.
    """
    salted = df.withColumn("_salt", salt(parts, *spread_by))
    if df.isStreaming:
        rows = filter_rows(salted, where, ts)
        stage = rows.groupBy(F.window(ts, span_text(size)).alias("window"), "_salt").agg(F.count("*").alias("_n"))
        total = stage.groupBy(F.window("window", span_text(size)).alias("window")).agg(F.sum("_n").alias("cnt"))
        return total.select(F.col("window.end").alias("window_end"), "cnt")
    part = windowed_counts(salted, ["_salt"], ts, size, where=where)
    return part.groupBy("window_end").agg(F.sum("cnt").alias("cnt"))
