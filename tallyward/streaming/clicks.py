"""Daily click cap on streams: rows pass in arrival order until the cap, then one warning per key and day.

``capped_clicks`` is a job of its own: each batch is ranked with the ranks cut in its map tasks, so a bot's clicks never come
together anywhere, and a keyed table by day remembers how many have passed. ``click_cap`` is the state machine, for other
operators to follow in the same query; there a key's rows of a batch go through one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyward.functions.timing import business_day, micros
from tallyward.operators import click_cap as batch_cap
from tallyward.operators.click_cap import BLACKLISTED, BUSINESS_ZONE, MAX_CLICKS, PASSED
from tallyward.streaming import sinks, store
from tallyward.streaming.jobs import run

_DAY_MILLIS = 86_400_000


class CapProcessor(StatefulProcessor):
    """Counts the rows of one (key, day) up to the cap + 1; the state is dropped a day after its last row.

    Rows of one batch have no order of their own after the shuffle; the earliest ones are taken first. Only as
    many as can still pass are held.
    """

    def __init__(self, max_clicks: int, columns: Sequence[str], seq: str):
        self.max_clicks = max_clicks
        self.seq = seq
        self.out = Row(*columns, "channel")
        self.columns = tuple(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("clicks", "seen bigint, last_us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, last = self.state.get() if self.state.exists() else (0, None)
        latest = [last or 0]

        def watched():
            for row in rows:
                latest[0] = max(latest[0], row["_us"])
                yield row

        room = self.max_clicks + 1 - seen
        for row in heapq.nsmallest(room, watched(), key=lambda row: (row["_us"], row[self.seq])):
            seen += 1
            channel = PASSED if seen <= self.max_clicks else BLACKLISTED
            yield self.out(*[row[c] for c in self.columns], channel)
        last = latest[0]
        self.state.update((seen, last))
        self.handle.registerTimer(last // 1000 + _DAY_MILLIS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists() and self.state.get()[1] // 1000 + _DAY_MILLIS <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def click_cap(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    max_clicks: int = MAX_CLICKS,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """The watermarked stream's rows up to the cap with their ``channel``; windowed counts can follow it."""
    columns = events.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    dated = events.withColumn("_day", business_day(ts, zone)).withColumn("_us", micros(ts))
    processor = CapProcessor(max_clicks, columns, seq)
    return dated.groupBy(*keys, "_day").transformWithState(
        processor, f"{fields}, channel string", "Append", "EventTime", eventTimeColumnName=ts
    )


_PART = "day_number"


def _seen(spark: SparkSession, path: str, kinds: dict[str, str], every: int) -> store.KeyedTable:
    schema = ", ".join(f"`{k}` {kind}" for k, kind in kinds.items())
    fold = store.added_up([*kinds, _PART], "seen")
    return store.KeyedTable(spark, f"{path}/seen", f"{schema}, seen bigint, {_PART} int", _PART, fold, every)


def capped_clicks(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    seq: str,
    max_clicks: int = MAX_CLICKS,
    zone: str = BUSINESS_ZONE,
    also: Callable[[DataFrame, int], None] | None = None,
    keep_days: int = 7,
    once: bool = False,
    every: int = 8,
) -> StreamingQuery:
    """Starts the job: the rows up to the cap and the one beyond it go to ``path``/rows with ``day`` and ``channel``.

    Batches pass in their order, rows of a batch by time and ``seq``. A batch that is run again sees the counts before it and
    replaces its own. ``also`` gets each batch's rows that passed. Counts of days more than ``keep_days`` before the
    latest day of a batch are dropped, so the state does not grow with time. Rows without a time have no day and are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    keys, limit = list(keys), max_clicks + 1

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = _seen(spark, path, {k: kinds[k] for k in keys}, every)
        ranked = batch_cap.click_cap(batch.filter(F.col(ts).isNotNull()), keys, ts, [seq], max_clicks, zone)
        ranked = ranked.drop("channel").withColumn(_PART, F.unix_date("day")).persist()
        try:
            days = sorted(r[0] for r in ranked.select(_PART).distinct().collect())  # bounded by the calendar
            by = [*keys, _PART]
            matches = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in by]
            place = F.coalesce("s.seen", F.lit(0)) + F.col("c.row_num")
            placed = ranked.alias("c").join(table.read(days, before=batch_id).alias("s"), matches, "left")
            rows = placed.select("c.*", place.alias("_place")).filter(F.col("_place") <= limit)
            channel = F.when(F.col("_place") <= max_clicks, PASSED).otherwise(BLACKLISTED)
            rows = rows.withColumn("channel", channel).drop("row_num", "_place").persist()
            try:
                sinks.write_batch(rows.drop(_PART), f"{path}/rows", batch_id)
                table.put(rows.groupBy(*by).agg(F.count("*").alias("seen")), batch_id, days)
                if also is not None:
                    also(rows.filter(F.col("channel") == PASSED).select(events.columns), batch_id)
                if days:
                    table.forget(days[-1] - keep_days)
            finally:
                rows.unpersist()
        finally:
            ranked.unpersist()

    return run(events, take, checkpoint, once=once)


def capped_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ``capped_clicks`` let through or warned of."""
    return sinks.read_log(spark, f"{path}/rows").drop(sinks.BATCH)
