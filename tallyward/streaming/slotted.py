"""Rules that look a bounded time back or ahead, on streams: per (key, time slot) instead of per key.

A slot is a sliding window whose overlap is what the rule looks at beyond it, so Spark's windowed aggregation holds the rows,
hands them out once the watermark has passed the slot, and drops them. A hot key is as many groups as it has slots, spread over
all state partitions. Closed slots are evaluated many at a time in numpy: one sort, then comparisons of whole columns.
Answers come when a slot closes: at most ``slot`` and the rule's reach after the event.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.timing import filter_rows, micros, span_text

#: A slot is so many times as long as what the rule looks at, so that few rows are in two slots.
SLOT_SPANS = 4

OTHER, FIRST, SECOND = 0, 1, 2


class Events:
    """Events of many slots in order: their slot (a number), time, kind, and whether they are the slot's own."""

    def __init__(self, slot: np.ndarray, us: np.ndarray, kind: np.ndarray, own: np.ndarray) -> None:
        self.slot, self.us, self.kind, self.own = slot, us, kind, own

    def only(self, kept: np.ndarray) -> Events:
        return Events(self.slot[kept], self.us[kept], self.kind[kept], self.own[kept])


#: Gives the slots of the answers and their columns (numpy, or Arrow where there are NULLs).
Rule = Callable[[Events], tuple[np.ndarray, list]]


def pairs(within: int) -> Rule:
    """A FIRST event directly after another one, at most ``within`` later."""

    def found(e: Events):
        if len(e.us) < 2:
            return np.empty(0, np.int64), [np.empty(0, np.int64)] * 2
        both = (e.kind[1:] == FIRST) & (e.kind[:-1] == FIRST) & (e.slot[1:] == e.slot[:-1]) & e.own[1:]
        last = np.flatnonzero(both & (e.us[1:] - e.us[:-1] <= within)) + 1
        return e.slot[last], [e.us[last - 1], e.us[last]]

    return found


def repeated(within: int, times: int, strict: bool) -> Rule:
    """``times`` FIRST events in less than ``within``; ``strict``: directly after one another."""

    def found(e: Events):
        if not strict:
            e = e.only(e.kind == FIRST)
        last = np.arange(times - 1, len(e.us))
        first = last - (times - 1)
        near = (e.slot[last] == e.slot[first]) & (e.us[last] - e.us[first] < within) & e.own[last]
        if strict:
            seen = np.r_[0, np.cumsum(e.kind == FIRST)]
            near &= seen[last + 1] - seen[first] == times
        return e.slot[last[near]], [e.us[first[near]], e.us[last[near]]]

    return found


def followed(within: int, in_time: str, too_late: str) -> Rule:
    """Each FIRST event with the next SECOND one in less than ``within``, else alone."""

    def found(e: Events):
        first, second = np.flatnonzero((e.kind == FIRST) & e.own), np.flatnonzero(e.kind == SECOND)
        place = np.searchsorted(second, first)
        there = place < len(second)
        then = second[np.minimum(place, max(len(second) - 1, 0))] if len(second) else first
        good = there & (e.slot[then] == e.slot[first]) & (e.us[then] - e.us[first] < within)
        channels = np.where(good, in_time, too_late)
        return e.slot[first], [e.us[first], pa.array(e.us[then], mask=~good), pa.array(channels.tolist(), pa.string())]

    return found


def _evaluate(rule: Rule, n_keys: int, back: int, slot: int, names: Sequence[str]):
    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts = batch.column(n_keys + 1), batch.column(n_keys).to_numpy()
            values = rows.flatten()
            us, seq, kind = (values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            slots = np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
            order = np.lexsort((kind, seq, us, slots))
            us, kind, slots = us[order], kind[order], slots[order]
            from_own = starts[slots] + back
            own = (us >= from_own) & (us < from_own + slot)
            at, columns = rule(Events(slots, us, kind, own))
            keys = [c.take(pa.array(at)) for c in batch.columns[:n_keys]]
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(c) if isinstance(c, np.ndarray) else c for c in columns]], list(names))

    return evaluate


def apply_in_slots(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    kind: Column,
    rule: Rule,
    schema: str,
    back: int = 0,
    ahead: int = 0,
    kinds: Sequence[int] | None = None,
    slot: int | None = None,
) -> DataFrame:
    """Run a rule over a watermarked stream (or a table); time columns (``_us``) of the result are timestamps.

    ``back`` and ``ahead`` (microseconds) are how far the rule looks from an event of its own, ``kinds`` the kinds it looks at.
    Events of one time are in the order of ``seq``. Events without a time have no place in the order and are left out.
    """
    slot = slot or max(1, SLOT_SPANS * max(back, ahead))
    kept = filter_rows(events, None if kinds is None else kind.isin(list(kinds)), ts)
    types = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    offset = -back % slot
    windows = F.window(ts, span_text(back + slot + ahead), span_text(slot), span_text(offset))
    row = F.struct(micros(ts).alias("us"), F.col(seq).cast("bigint").alias("seq"), kind.cast("int").alias("kind"))
    held = kept.groupBy(*keys, windows.alias("_slot")).agg(F.collect_list(row).alias("_rows"))
    slim = held.select(*keys, micros(F.col("_slot.start")).alias("_start"), "_rows")
    out = ", ".join([f"`{k}` {types[k]}" for k in keys] + [schema])
    names = [*keys, *[f.split()[0] for f in schema.split(", ")]]
    found = slim.mapInArrow(_evaluate(rule, len(keys), back, slot, names), out)
    return found.select(
        *[F.timestamp_micros(c).alias(c.removesuffix("_us") + "_ts") if c.endswith("_us") else F.col(c) for c in found.columns]
    )


def _matches(within: int, back: int, slot: int, channels: tuple[str, str, str], names: Sequence[str]):
    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts = batch.column(1), batch.column(0).to_numpy()
            values = rows.flatten()
            us, side = (values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            slots = np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
            # One axis for all slots, with gaps wider than the reach between them.
            axis = slots * np.int64(2 * back + slot + 2 * within + 1) + (us - starts[slots])
            own = (us >= starts[slots] + back) & (us < starts[slots] + back + slot)
            sides = []
            for number in (0, 1):
                held = np.flatnonzero(side == number)
                sides.append(held[np.argsort(axis[held], kind="stable")])
            reach = []
            for mine, others in (sides, sides[::-1]):
                low = np.searchsorted(axis[others], axis[mine] - within, side="left")
                reach.append((low, np.searchsorted(axis[others], axis[mine] + within, side="right") - low))
            (left, right), (low, n), alone = sides, reach[0], []
            n = np.where(own[left], n, 0)  # a pair belongs to the slot of its left row
            one = np.repeat(left, n)
            other = right[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(right) else one[:0]
            for held, (_, found) in zip(sides, reach):
                alone.append(held[own[held] & (found == 0)])
            none = [np.zeros(len(x), bool) for x in (one, alone[0], alone[1])]
            at_left = pa.array(np.r_[one, alone[0], alone[1] * 0], mask=np.r_[none[0], none[1], ~none[2]])
            at_right = pa.array(np.r_[other, alone[0] * 0, alone[1]], mask=np.r_[none[0], ~none[1], none[2]])
            channel = np.repeat(np.array(channels, object), [len(one), len(alone[0]), len(alone[1])])
            columns = [values.field(2).take(at_left), values.field(3).take(at_right), pa.array(channel, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, list(names))

    return evaluate


def match_in_slots(
    both: DataFrame, on: str, ts: str, side: str, rows: Sequence[str], within: int, channels: tuple[str, str, str], names: Sequence[str]
) -> DataFrame:
    """Pairs of rows of two sides (0 and 1) with equal ``on`` at most ``within`` apart, and the rows of either side without one.

    ``rows`` are the columns with the row of each side; ``channels`` names pairs and singles. Both sides come as one watermarked
    stream. Rows without a key or a time are left out.
    """
    slot = max(1, SLOT_SPANS * within)
    kept = filter_rows(both, F.col(on).isNotNull(), ts)
    windows = F.window(ts, span_text(2 * within + slot), span_text(slot), span_text(-within % slot))
    row = F.struct(micros(ts).alias("us"), F.col(side).cast("int").alias("side"), *rows)
    held = kept.groupBy(on, windows.alias("_slot")).agg(F.collect_list(row).alias("_rows"))
    kinds = [both.schema[x].dataType.simpleString() for x in rows]
    schema = f"`{names[0]}` {kinds[0]}, `{names[1]}` {kinds[1]}, channel string"
    slim = held.select(micros(F.col("_slot.start")).alias("_start"), "_rows")
    return slim.mapInArrow(_matches(within, within, slot, channels, [*names, "channel"]), schema)
