"""Windows that report before they are final, and windows that hand all their rows to a function of one's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.timing import Span, filter_rows, floor_to, last_window_end, micros, span_micros, span_text
from tallyward.streaming import sinks, store
from tallyward.streaming.jobs import run

_PART = "day_number"
_DAY = 86_400_000_000
_WHOLE = ("byte", "short", "integer", "long", "boolean")


def day_of(us: Column) -> Column:
    return (floor_to(us, _DAY) / F.lit(_DAY)).cast("bigint")


class EarlyVisitors:
    """The tables of ``early_visitors`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key_type: str, every: int = 8) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        schema = f"_end bigint, visitor {key_type}, n bigint, {_PART} bigint"
        self.seen = store.KeyedTable(spark, f"{self.path}/seen", schema, _PART, store.added_up(["_end", "visitor", _PART], "n"), every)

    def firings(self) -> DataFrame:
        """window_end, cnt_rows (rows of the window so far) and cnt (visitors so far) of every firing."""
        return sinks.read_log(self.spark, f"{self.path}/firings").drop(sinks.BATCH)

    def totals(self) -> DataFrame:
        """The current rows and visitors of every window."""
        totals = self.seen.read().groupBy("_end").agg(F.sum("n").alias("cnt_rows"), F.count("*").alias("cnt"))
        return totals.select(F.timestamp_micros("_end").alias("window_end"), "cnt_rows", "cnt")


def early_visitors(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    ts: str,
    seq: str,
    size: Span,
    per_firing: int = 1,
    where: Column | None = None,
    keep_days: int = 7,
    once: bool = False,
    every: int = 8,
) -> StreamingQuery:
    """Starts the job: unique visitors per window, reported after every ``per_firing`` rows of a window and then forgotten.

    What a firing has reported is not held any longer: a window keeps a number per visitor in a keyed table by day, and a batch
    reads the days it touches. Batches come in their order, rows of a batch by time and ``seq``. Days more than
    ``keep_days`` before the latest one of a batch are dropped. A NULL key is no visitor, a row without a time in no window.
    """
    kind = rows.schema[key].dataType.simpleString()
    size_us = span_micros(size)
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()

    def take(batch: DataFrame, batch_id: int) -> None:
        tables = EarlyVisitors(batch.sparkSession, path, kind, every)
        end = last_window_end(micros(ts), size_us, size_us)
        held = batch.filter(known if where is None else known & where)
        held = held.select(end.alias("_end"), F.col(key).alias("visitor"), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"))
        held = held.withColumn(_PART, day_of(F.col("_end"))).persist()
        try:
            days = sorted(r[0] for r in held.select(_PART).distinct().collect())  # bounded by the calendar
            before = tables.seen.read(days, before=batch_id)
            totals = before.groupBy("_end").agg(F.sum("n").alias("_rows"), F.count("*").alias("_visitors"))
            line, again = Window.partitionBy("_end").orderBy("_ts", "_seq"), Window.partitionBy("_end", "visitor").orderBy("_ts", "_seq")
            fresh = held.withColumn("_turn", F.row_number().over(again)).join(
                before.select("_end", "visitor", F.lit(True).alias("_old")), ["_end", "visitor"], "left"
            )
            first = ((F.col("_turn") == 1) & F.col("_old").isNull()).cast("bigint")
            counted = fresh.join(totals, "_end", "left").select(
                "_end",
                (F.coalesce("_rows", F.lit(0)) + F.row_number().over(line)).alias("cnt_rows"),
                (F.coalesce("_visitors", F.lit(0)) + F.sum(first).over(line.rowsBetween(Window.unboundedPreceding, 0))).alias("cnt"),
            )
            fired = counted.filter(F.pmod("cnt_rows", F.lit(per_firing)) == 0)
            sinks.write_batch(fired.select(F.timestamp_micros("_end").alias("window_end"), "cnt_rows", "cnt"), f"{path}/firings", batch_id)
            tables.seen.put(held.groupBy("_end", "visitor", _PART).agg(F.count("*").alias("n")), batch_id, days)
            if days:
                tables.seen.forget(days[-1] - keep_days)
        finally:
            held.unpersist()

    return run(rows, take, checkpoint, once=once)


def window_rows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: Span,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    slide: Span | None = None,
) -> DataFrame:
    """Hands all rows of each (key, window) to ``function`` once the window is final; on tables and watermarked streams.

    ``function`` gets a frame with the rows and the constant columns ``window_start`` and ``window_end``, and gives rows of
    ``schema``. The rows of a window are held by Spark's windowed aggregation until the watermark has passed it. A window must
    fit in a task's memory; rows without a time are in none.
    """
    rows = F.collect_list(F.struct(*df.columns)).alias("_rows")
    windows = F.window(ts, span_text(size), span_text(slide if slide is not None else size))
    held = filter_rows(df, None, ts).groupBy(*keys, windows.alias("_window")).agg(rows)
    columns = df.columns
    # A column of whole numbers with NULLs reaches pandas as fractions; these go as numbers and marks.
    whole = [f.name for f in df.schema.fields if f.nullable and f.dataType.typeName() in _WHOLE]

    def frame(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        for place, name in enumerate(whole):
            empty = rows[f"_null{place}"]
            if empty.any():
                known = rows[name].astype(object if rows[name].dtype == bool else float)
                rows[name] = None if empty.all() else known.where(~empty, None)
        return rows[[*columns, "window_start", "window_end"]]

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        for batch in batches:
            cuts = np.flatnonzero(batch["_place"].to_numpy() == 0)
            for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(batch)]):
                if parts and low < len(batch) and batch["_place"].iat[low] == 0:
                    yield function(frame(parts))
                    parts = []
                if low < high:
                    parts.append(batch.iloc[low:high])
        if parts:
            yield function(frame(parts))

    # The rows of a window follow one another, so Python holds one window and one batch of rows at a time.
    flat = held.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), F.posexplode("_rows").alias("_place", "_row")
    )
    zeros = {name: F.lit(0).cast(df.schema[name].dataType) for name in whole}
    values = [F.coalesce(F.col("_row")[c], zeros[c]).alias(c) if c in zeros else F.col("_row")[c].alias(c) for c in columns]
    marks = [F.col("_row")[name].isNull().alias(f"_null{place}") for place, name in enumerate(whole)]
    return flat.select("window_start", "window_end", "_place", *values, *marks).mapInPandas(call, schema)
