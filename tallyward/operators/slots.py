"""Splitting a key's timeline into slots.

Rules that look a bounded time back or ahead need not hold a key's whole history in one
task. Rows are keyed by (key, time slot), and the rows within reach of a slot's edge are copied
to the neighbouring slot as context. A key that holds a third of all rows is then spread over as
many tasks as its history has slots. Slots are at least ``SLOT_FACTOR`` times as long as the reach, so at most
about one row in ``SLOT_FACTOR`` is copied per direction; for short reaches ``MIN_SLOT`` makes copies rarer still.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.timing import floor_to, micros

SLOT_FACTOR = 4
MIN_SLOT = 60_000_000

US, SLOT, OWN = "_us", "_slot", "_own"


def slot_width(reach: int) -> int:
    return max(SLOT_FACTOR * reach, MIN_SLOT)


def with_slots(df: DataFrame, ts: str, back: int = 0, ahead: int = 0, width: int | None = None) -> DataFrame:
    """Replace ``ts`` by ``_us`` (event time in microseconds), ``_slot`` (start of the slot) and ``_own``.

    ``ts`` is a timestamp column, or ``_us`` itself where that is already there.

    A row is placed in its own slot (``_own``) and, as context, in each other slot that needs it: a
    slot sees the rows up to ``back`` before its start and up to ``ahead`` after its end, inclusive.
    """
    width = width or slot_width(max(back, ahead))
    if width < max(back, ahead):
        raise ValueError("a slot must be at least as long as the reach")
    us = F.col(US)
    slots = F.sequence(floor_to(us - F.lit(ahead), width), floor_to(us + F.lit(back), width), F.lit(width))
    timed = df if ts == US else df.withColumn(US, micros(ts)).drop(ts)
    return timed.withColumn(SLOT, F.explode(slots)).withColumn(OWN, F.col(SLOT) == floor_to(us, width))
