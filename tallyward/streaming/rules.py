"""Event rules as small state machines, and the stateful processor that feeds them in event-time order.

A rule sees the events of one key one after the other: ``step`` takes an event, ``expire`` is called once event
time is past the memory's ``deadline``. The memory is a flat tuple kept in the state store. That is for rules whose answer
may depend on all of a key's past; those that look a bounded time back or ahead run in time slots (``slotted``).
The batch operators give the same rows; these are their twins for unbounded input.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyward.functions.timing import Span, filter_rows, micros, span_micros
from tallyward.operators import anchored, failures, matching, orders
from tallyward.streaming import slotted

_WARNING = "first_us bigint, last_us bigint"


@dataclass(frozen=True)
class Event:
    us: int
    seq: int
    kind: int


# How long an answered order waits for a correction.
REMEMBER = "30 days"

# Events handed to the state store at a time.
_CHUNK = 10_000

# Groups of keys whose state is read and written together.
BUCKETS = 1024

# Kinds of an event as seen by a rule.
OTHER, FIRST, SECOND = slotted.OTHER, slotted.FIRST, slotted.SECOND

# Times within a key keep their microseconds.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# States of an order: nothing reported, reported once without its other half, complete.
WAITING, ANSWERED, DONE = 0, 1, 2


@dataclass(frozen=True)
class AnchoredRule:
    """A timer from the first failure; at its end ``times`` failures are reported, another event cancels."""

    within: int
    times: int
    memory_schema = "anchor bigint, last bigint, seen bigint"
    output_schema = _WARNING

    def step(self, memory, event):
        if event.kind != FIRST:
            return None, []
        if memory is None:
            return (event.us, event.us, 1), []
        return (memory[0], event.us, memory[2] + 1), []

    def deadline(self, memory):
        return memory[0] + self.within

    def expire(self, memory):
        return None, [(memory[0], memory[1])] if memory[2] >= self.times else []


@dataclass(frozen=True)
class LifeCycleRule:
    """First create and first pay of an order, in any order; waits ``hold`` beyond the limit for the other one.

    A small marker of the order stays, so that the other one, when it comes after that, corrects the answer (version 1)
    instead of starting a second order. ``remember`` limits how long (after that a half is an order of its own); without it the
    marker stays for good.
    """

    within: int
    hold: int
    remember: int | None = None
    memory_schema = "create_us bigint, pay_us bigint, state int"
    output_schema = "create_us bigint, pay_us bigint, channel string, version int"

    def step(self, memory, event):
        create, pay, state = memory or (None, None, WAITING)
        if state == DONE or event.kind not in (FIRST, SECOND):
            return memory, []
        if event.kind == FIRST and create is None:
            create = event.us
        if event.kind == SECOND and pay is None:
            pay = event.us
        if create is None or pay is None:
            return (create, pay, state), []
        channel = orders.PAYED if pay - create < self.within else orders.LATE_PAY
        return (create, pay, DONE), [(create, pay, channel, int(state == ANSWERED))]

    def deadline(self, memory):
        create, pay, state = memory
        since = max(us for us in (create, pay) if us is not None) + self.within + self.hold
        if state == WAITING:
            return since
        return None if self.remember is None else since + self.remember

    def expire(self, memory):
        create, pay, state = memory
        if state != WAITING:
            return None, []
        return (create, pay, ANSWERED), [(create, pay, orders.TIMEOUT if pay is None else orders.NO_CREATE, 0)]


@dataclass(frozen=True)
class ReconcileRule:
    """One-to-one matching of left (FIRST) and right (SECOND) rows at most ``within`` apart."""

    within: int
    # The two sides' numbers have nothing to do with each other: at one instant left rows come first, as in batch.
    side_first = True
    memory_schema = "us bigint, seq bigint, kind int"
    output_schema = "left_seq bigint, left_us bigint, right_seq bigint, right_us bigint, channel string"

    @staticmethod
    def _single(memory):
        us, seq, kind = memory
        if kind == FIRST:
            return (seq, us, None, None, matching.SINGLE_LEFT)
        return (None, None, seq, us, matching.SINGLE_RIGHT)

    def step(self, memory, event):
        waits = (event.us, event.seq, event.kind)
        if memory is None:
            return waits, []
        if memory[2] != event.kind and event.us - memory[0] <= self.within:
            left, right = (memory, waits) if event.kind == SECOND else (waits, memory)
            return None, [(left[1], left[0], right[1], right[0], matching.MATCHED)]
        return waits, [self._single(memory)]

    def deadline(self, memory):
        return memory[0] + self.within

    def expire(self, memory):
        return None, [self._single(memory)]


class OrderedProcessor(StatefulProcessor):
    """Holds events back until the watermark has passed them, then feeds the rule key by key in (time, arrival) order.

    A group is a bucket of keys: a call of the state store costs as much as many events, so the events that wait and the
    memories of a bucket are read and written as a whole. Arriving events are only appended.
    """

    def __init__(self, rule):
        self.rule = rule
        self.names = ["key_text", *[f.split()[0] for f in rule.output_schema.split(", ")]]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "events binary")
        self.memory = handle.getValueState("memory", "memories binary")
        self.taken: dict = {}  # bucket -> the time up to which this task has taken its events

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for part in rows:
            seq = [None if n is None else int(n) for n in part["seq"]]
            events = list(zip(part["key_text"], part["us"].tolist(), seq, part["kind"].tolist()))
            self._wait(events)
            first = int(part["us"].min())
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake_after(earliest)
        return iter(())

    def _wait(self, events: list[tuple]) -> None:
        for low in range(0, len(events), _CHUNK):
            self.waiting.appendValue((pickle.dumps(events[low : low + _CHUNK]),))

    def _wake_after(self, us: int) -> None:
        """One timer for the next event is enough: when it fires, everything the watermark has passed is taken."""
        self.handle.registerTimer(us // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
        if self.taken.get(key, passed - 1) >= passed:
            return
        self.taken[key] = passed
        ready, rest = defaultdict(list), []
        for (chunk,) in self.waiting.get():
            for event in pickle.loads(chunk):
                if event[1] < passed:
                    ready[event[0]].append(event[1:])
                else:
                    rest.append(event)
        before = pickle.loads(self.memory.get()[0]) if self.memory.exists() else {}
        memories, out, order = {}, [], self._by_side if getattr(self.rule, "side_first", False) else None
        for one in [*ready, *(k for k in before if k not in ready)]:
            memory = before.get(one)
            for event in sorted(ready.get(one, ()), key=order):
                memory, made = self._expired(memory, event[0])
                out += [(one, *values) for values in made]
                memory, made = self.rule.step(memory, Event(*event))
                out += [(one, *values) for values in made]
            memory, made = self._expired(memory, passed)
            out += [(one, *values) for values in made]
            if memory is not None:
                memories[one] = memory
        if ready:
            self.waiting.clear()
            self._wait(rest)
        if memories != before:
            if memories:
                self.memory.update((pickle.dumps(memories),))
            else:
                self.memory.clear()
        deadlines = (self.rule.deadline(memory) for memory in memories.values())
        wake = min((us for us in (*(event[1] for event in rest), *deadlines) if us is not None), default=None)
        if wake is not None:
            self._wake_after(wake)
        if out:
            yield pd.DataFrame(out, columns=self.names, dtype=object)

    @staticmethod
    def _by_side(event):
        return event[0], event[2], event[1]

    def _expired(self, memory, now: int):
        out = []
        while memory is not None:
            deadline = self.rule.deadline(memory)
            if deadline is None or deadline >= now:
                break
            memory, made = self.rule.expire(memory)
            out += made
        return memory, out

    def close(self) -> None:
        pass


def apply_rule(
    events: DataFrame, keys: tuple[str, ...], ts: str, seq: str, kind, rule, buckets: int = BUCKETS
) -> DataFrame:
    """Run a rule per key over a watermarked stream; time columns of the result are timestamps.

    Keys are dealt over ``buckets`` groups; a stream keeps the number it was started with. A batch reads and writes the state
    of the buckets that it touches. Events without a time have no place in the order and are left out.
    """
    events = filter_rows(events, None, ts)
    fields = ", ".join(f"`{k}` {events.schema[k].dataType.simpleString()}" for k in keys)
    # Keys and arrival numbers go through Python as text, which has every NULL and every digit.
    slim = events.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"),
        F.to_json(F.struct(*keys), _EXACT).alias("key_text"),
        ts,
        micros(ts).alias("us"),
        F.col(seq).cast("bigint").cast("string").alias("seq"),
        F.coalesce(kind.cast("int"), F.lit(OTHER)).alias("kind"),
    )
    schema = f"key_text string, {rule.output_schema}"
    found = slim.groupBy("_bucket").transformWithStateInPandas(OrderedProcessor(rule), schema, "Append", "EventTime")
    made = [c for c in found.columns if c != "key_text"]
    return found.withColumn("key_text", F.from_json("key_text", fields, _EXACT)).select(
        *[F.col("key_text")[k].alias(k) for k in keys],
        *[
            F.timestamp_micros(c).alias(c.removesuffix("_us") + "_ts") if c.endswith("_us") else F.col(c)
            for c in made
        ],
    )


def _fail_kind(failed):
    return F.when(failed, FIRST).otherwise(OTHER)


def _warnings(found: DataFrame, key: str, message: str) -> DataFrame:
    return found.select(
        key,
        F.col("first_ts").alias("first_fail_ts"),
        F.col("last_ts").alias("last_fail_ts"),
        F.lit(message).alias("msg"),
    )


def consecutive_pairs(events, key, ts, seq, failed, within: Span = failures.PAIR_WITHIN) -> DataFrame:
    span = span_micros(within)
    found = slotted.apply_in_slots(events, (key,), ts, seq, _fail_kind(failed), slotted.pairs(span), _WARNING, back=span)
    return _warnings(found, key, failures.PAIR_MESSAGE)


def repeated_failures(
    events, key, ts, seq, failed, times: int = 3, within: Span = failures.GROUP_WITHIN, strict: bool = False
) -> DataFrame:
    span = span_micros(within)
    rule, kinds = slotted.repeated(span, times, strict), None if strict else [FIRST]
    found = slotted.apply_in_slots(events, (key,), ts, seq, _fail_kind(failed), rule, _WARNING, back=span, kinds=kinds)
    return _warnings(found, key, failures.PATTERN_MESSAGE)


def anchored_groups(
    events, key, ts, seq, failed, times: int = anchored.MIN_TIMES, within: Span = failures.GROUP_WITHIN
) -> DataFrame:
    found = apply_rule(events, (key,), ts, seq, _fail_kind(failed), AnchoredRule(span_micros(within), times))
    return _warnings(found, key, failures.TIMER_MESSAGE)


def _order_kind(create, pay):
    return F.when(create, FIRST).when(pay, SECOND).otherwise(OTHER)


def followed_by(events, key, ts, seq, create, pay, within: Span = orders.PAY_WITHIN) -> DataFrame:
    span = span_micros(within)
    rule = slotted.followed(span, orders.PAYED, orders.TIMEOUT)
    schema, kind = "create_us bigint, pay_us bigint, channel string", _order_kind(create, pay)
    found = slotted.apply_in_slots(events, (key,), ts, seq, kind, rule, schema, ahead=span, kinds=[FIRST, SECOND])
    in_time = F.col("channel") == orders.PAYED
    return found.withColumn(
        "result_msg",
        F.when(in_time, orders.keyed_text(orders.PAYED_TEXT, key)).otherwise(
            orders.keyed_text(orders.TIMEOUT_TEXT, key)
        ),
    )


def life_cycle(
    events,
    keys,
    ts,
    seq,
    create,
    pay,
    within: Span = orders.PAY_WITHIN,
    hold: Span = orders.PAY_WITHIN,
    remember: Span | None = REMEMBER,
) -> DataFrame:
    """One row per order, and a second one (``version`` 1) if its other half comes after the answer.

    An order is remembered for ``remember`` of event time after its answer, then its state is dropped.

    The row with the highest version is the order's state: ``sinks.newest_rows(log, keys, "version")``.
    """
    kept = None if remember is None else span_micros(remember)
    rule = LifeCycleRule(span_micros(within), span_micros(hold), kept)
    found = apply_rule(filter_rows(events, create | pay, ts), tuple(keys), ts, seq, _order_kind(create, pay), rule)
    return found.withColumn("result_msg", orders.lifecycle_text("channel"))


def reconcile(left, right, on, ts, seq, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    """Both sides as one stream of (FIRST, SECOND) events; one watermark covers the two.

    Rows without a key or a time match nothing and are singles at once.
    """
    both = left.select(on, ts, seq, F.lit(FIRST).alias("side")).unionByName(
        right.select(on, ts, seq, F.lit(SECOND).alias("side"))
    )
    return reconcile_sided(both, on, ts, seq, "side", within)


def reconcile_sided(both, on, ts, seq, side: str, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    """``reconcile`` for a stream that has both sides already, told apart by the column ``side``."""
    matchable = F.col(on).isNotNull() & F.col(ts).isNotNull()
    found = apply_rule(
        filter_rows(both, F.col(on).isNotNull(), ts), (on,), ts, seq, F.col(side), ReconcileRule(span_micros(within))
    )
    is_left = F.col(side) == FIRST
    number, time = F.col(seq).cast("bigint"), F.col(ts)
    alone = both.filter(~matchable).select(
        on,
        F.when(is_left, number).alias("left_seq"),
        F.when(is_left, time).alias("left_ts"),
        F.when(~is_left, number).alias("right_seq"),
        F.when(~is_left, time).alias("right_ts"),
        F.when(is_left, matching.SINGLE_LEFT).otherwise(matching.SINGLE_RIGHT).alias("channel"),
    )
    return found.unionByName(alone)
