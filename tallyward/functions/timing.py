"""Event-time helpers. Operators compute on epoch microseconds (bigint)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

_FAR_PAST = "0001-01-02 00:00:00"

Span = str | int | timedelta


def span_micros(span: Span) -> int:
    """``"15 minutes"``, a ``timedelta`` or a microsecond count, as microseconds."""
    if isinstance(span, bool):
        raise TypeError("a span is a text, a timedelta or a number of microseconds")
    if isinstance(span, int):
        return span
    if isinstance(span, timedelta):
        return span // timedelta(microseconds=1)
    amount, unit = span.split()
    return int(amount) * _UNIT_MICROS[unit.lower().removesuffix("s")]


def span_text(span: Span) -> str:
    """Spark interval text for a span."""
    return f"{span_micros(span)} microseconds"


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def floor_to(us: Column, step: int) -> Column:
    return us - F.pmod(us, F.lit(step))


def first_window_end(us: Column, size: int, slide: int) -> Column:
    """End of the earliest sliding window holding ``us`` (starts are multiples of the slide)."""
    return floor_to(us - F.lit(size), slide) + F.lit(slide + size)


def last_window_end(us: Column, size: int, slide: int) -> Column:
    """End of the latest sliding window holding ``us``."""
    return floor_to(us, slide) + F.lit(size)


def business_day(ts: str | Column, zone: str) -> Column:
    """Calendar day of an instant in a business time zone."""
    return F.to_date(F.from_utc_timestamp((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"), zone))


def stamp_text(ts: str | Column) -> Column:
    """Timestamp as text with at least one fractional digit, e.g. ``2017-11-26 10:00:05.0``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S")


def filter_rows(df: DataFrame, where: Column | None, ts: str) -> DataFrame:
    """Filter a table, or a stream after its watermark. Rows without an event time are in no window and go as well.

    Spark pushes a plain filter below ``withWatermark``, where rows that fail it would no longer move time on. A
    predicate that mentions the time column stays above.
    """
    timed = F.col(ts).isNotNull()
    if where is None:
        return df.filter(timed)
    if df.isStreaming:
        where = F.when(F.col(ts) > F.lit(_FAR_PAST).cast("timestamp"), where)
    return df.filter(timed & where)


def as_wall_clock(df: DataFrame) -> DataFrame:
    """Every timestamp column as ``timestamp_ntz`` (session zone UTC: the same digits)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
