"""Repeated-failure rules over one key's events in (event time, arrival number) order.

Each rule looks at most ``within`` back or ahead, so all of them run per (key, time slot): no key is
ever held by a single task, and none joins a table with itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, span_micros
from tallyward.operators.slots import OWN, SLOT, US, with_slots

# The default limits and warning texts of the login rules.
PAIR_WITHIN = "2 seconds"
GROUP_WITHIN = "5 seconds"
PAIR_MESSAGE = "login fail in 2s for 2 times"
PATTERN_MESSAGE = "login fail"
TIMER_MESSAGE = "login in 2s "


def _timeline(key: str, seq: Sequence[str]):
    return Window.partitionBy(key, SLOT).orderBy(US, *seq)


def _stamp(us: str | Column) -> Column:
    return F.timestamp_micros(us)


def consecutive_pairs(
    df: DataFrame,
    key: str,
    ts: str,
    seq: Sequence[str],
    failed: Column,
    within: Span = PAIR_WITHIN,
    message: str = PAIR_MESSAGE,
) -> DataFrame:
    """A failure whose previous event of the same key also failed, at most ``within`` earlier (inclusive)."""
    span = span_micros(within)
    rows = with_slots(df.select(key, ts, *seq, failed.alias("_failed")), ts, back=span)
    line = _timeline(key, seq)
    paired = rows.select(
        key,
        OWN,
        US,
        "_failed",
        F.lag("_failed").over(line).alias("_prev_failed"),
        F.lag(US).over(line).alias("_prev_us"),
    ).filter(F.col(OWN) & F.col("_failed") & F.col("_prev_failed") & (F.col(US) - F.col("_prev_us") <= span))
    return paired.select(
        key, _stamp("_prev_us").alias("first_fail_ts"), _stamp(US).alias("last_fail_ts"), F.lit(message).alias("msg")
    )


def relaxed_times(
    df: DataFrame,
    key: str,
    ts: str,
    seq: Sequence[str],
    failed: Column,
    times: int = 3,
    within: Span = GROUP_WITHIN,
    message: str = PATTERN_MESSAGE,
) -> DataFrame:
    """``times`` failures in less than ``within``, other events in between ignored; overlapping matches all count."""
    span = span_micros(within)
    rows = with_slots(df.filter(failed).select(key, ts, *seq), ts, ahead=span)
    matched = rows.select(
        key, OWN, US, F.lead(US, times - 1).over(_timeline(key, seq)).alias("_last_us")
    ).filter(F.col(OWN) & (F.col("_last_us") - F.col(US) < span))
    return matched.select(
        key, _stamp(US).alias("first_fail_ts"), _stamp("_last_us").alias("last_fail_ts"), F.lit(message).alias("msg")
    )


def strict_times(
    df: DataFrame,
    key: str,
    ts: str,
    seq: Sequence[str],
    failed: Column,
    times: int = 3,
    within: Span = GROUP_WITHIN,
    message: str = PATTERN_MESSAGE,
) -> DataFrame:
    """``times`` failures directly after one another in less than ``within``."""
    span = span_micros(within)
    rows = with_slots(df.select(key, ts, *seq, failed.alias("_failed")), ts, ahead=span)
    line = _timeline(key, seq)
    # Failures among this event and the next times - 1 events of the key.
    run = F.sum(F.col("_failed").cast("int")).over(line.rowsBetween(0, times - 1))
    matched = rows.select(key, OWN, US, run.alias("_run"), F.lead(US, times - 1).over(line).alias("_last_us")).filter(
        F.col(OWN) & (F.col("_run") == times) & (F.col("_last_us") - F.col(US) < span)
    )
    return matched.select(
        key, _stamp(US).alias("first_fail_ts"), _stamp("_last_us").alias("last_fail_ts"), F.lit(message).alias("msg")
    )
