"""Which rows arrive too late for their windows, decided per record in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, first_window_end, floor_to, last_window_end, micros, span_micros
from tallyward.operators.windows import span_counts, with_bounds

# Out-of-orderness bound and allowed lateness of the page counts.
OUT_OF_ORDER = "1 minute"
ALLOWED_LATENESS = "1 minute"

#: Rows without an arrival number come neither before nor after others; they are in no window.
ON_TIME, LATE, UNNUMBERED = "on-time", "late", "unnumbered"

_MILLI = 1_000
# Blocks hold 2^20 arrival numbers.
_BLOCK_BITS = 20
# Rows without a number are dealt over this many blocks of their own.
_UNNUMBERED_BLOCKS = 1024


def running_max_before(
    df: DataFrame, order: str, value: Column, tie: Sequence[str] = (), bits: int = _BLOCK_BITS, levels: int = 2
) -> DataFrame:
    """Add ``_max_before``: the maximum of ``value`` over all rows earlier in ``order`` (a whole number).

    Rows without a number get NULL and do not count for others.

    A plain running window would sort the whole table in one task. Here the order is cut into blocks
    of 2^bits arrival numbers; the blocks' maxima are scanned the same way one level up, and each
    row takes the larger of "earlier in my block" and "all blocks before mine". With two levels the last,
    single-task scan sees one row per 2^(2 x bits) arrival numbers.
    """
    numbered = F.col(order).isNotNull()
    valued = df.withColumn("_value", F.when(numbered, value))
    if levels == 0:
        line = Window.orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
        return valued.withColumn("_max_before", F.max("_value").over(line)).drop("_value")
    block = f"_block{levels}"
    # Without NULLs no extra filters are inferred, and both levels share one scan for the maxima.
    own = -1 - F.pmod(F.xxhash64(value), F.lit(_UNNUMBERED_BLOCKS))
    blocked = valued.withColumn(block, F.coalesce(F.shiftright(F.col(order).cast("bigint"), bits), own))
    inside = Window.partitionBy(block).orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    maxima = blocked.groupBy(block).agg(F.max("_value").alias("_block_max"))
    scanned = running_max_before(maxima, block, F.col("_block_max"), (), bits, levels - 1)
    carried = scanned.select(block, F.col("_max_before").alias("_carry"))
    return (
        blocked.withColumn("_inside", F.max("_value").over(inside))
        .join(carried, block)
        .withColumn("_max_before", F.when(numbered, F.greatest("_inside", "_carry")))
        .drop("_value", "_inside", "_carry", block)
    )


def with_lateness(
    df: DataFrame,
    ts: str,
    seq: str,
    size: Span,
    slide: Span,
    delay: Span = OUT_OF_ORDER,
    lateness: Span = ALLOWED_LATENESS,
    tie: Sequence[str] = (),
    bits: int = _BLOCK_BITS,
    seen_until: int | None = None,
) -> DataFrame:
    """Add ``_first`` / ``_last`` (window ends still open to the row, microseconds) and ``channel``.

    The watermark at a row is the largest event time of the rows before it minus ``delay``. A window takes
    the row unless ``window end - 1 ms + lateness <= watermark``; a row that no window takes is ``late``, one without an arrival
    number is ``unnumbered`` and in no window.
    ``seen_until`` is the largest event time (microseconds) of rows that came before the whole table.
    """
    size_us, slide_us = span_micros(size), span_micros(slide)
    us = micros(ts)
    seen = running_max_before(df, seq, us, tie, bits)
    # Window ends up to this instant are closed; NULL before the first row.
    latest = F.greatest(F.col("_max_before"), F.lit(seen_until).cast("bigint"))
    closed = latest - F.lit(span_micros(delay)) + F.lit(_MILLI) - F.lit(span_micros(lateness))
    first, last = first_window_end(us, size_us, slide_us), last_window_end(us, size_us, slide_us)
    offset = size_us % slide_us
    after_closed = floor_to(closed - F.lit(offset), slide_us) + F.lit(slide_us + offset)
    return (
        seen.withColumn("_first", F.greatest(first, after_closed))
        .withColumn("_last", last)
        .withColumn(
            "channel",
            F.when(F.col(seq).isNull(), UNNUMBERED).when(F.col("_first") > F.col("_last"), LATE).otherwise(ON_TIME),
        )
        .drop("_max_before")
    )


def late_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("channel") == LATE).drop("_first", "_last", "channel")


def on_time_counts(marked: DataFrame, keys: Sequence[str], size: Span, slide: Span) -> DataFrame:
    """Final windowed counts of the rows that were not late, each in the windows still open to it."""
    size_us, slide_us = span_micros(size), span_micros(slide)
    counted = span_counts(marked.filter(F.col("channel") == ON_TIME), keys, "_first", "_last", size_us, slide_us)
    return with_bounds(counted, size_us)
