"""Rankings of sliding windows that are corrected with every micro-batch, with the late rows beside them.

A row lies in the window ends ``_first`` to ``_last``. Rows with the same key and span are one cell; cells are kept by the hour of
their last end in a keyed table (``store``) to which a batch adds its counts. The windows that a batch changes are runs of
ends; only the hours around them are read, and only those ends are unfolded and ranked again. So a batch costs what it
changed, at any slide: a row is a cell, never size / slide copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.timing import Span, floor_to, micros, span_micros
from tallyward.operators import lateness, topn
from tallyward.operators.windows import span_counts, span_plateaus, with_bounds, with_spans
from tallyward.streaming import sinks, store
from tallyward.streaming.jobs import run

_HOUR = 3_600_000_000
_PART = "hour"
_SPAN = ["_first", "_last"]


def hour_of(us: Column) -> Column:
    return (floor_to(us, _HOUR) / F.lit(_HOUR)).cast("bigint")


class CountedWindows:
    """Counts per key and sliding window, as cells in a keyed table below ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], size: Span, slide: Span, every: int = 8) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.size_us, self.slide_us = span_micros(size), span_micros(slide)
        self.kinds = ", ".join(f"`{k}` {kind}" for k, kind in keys.items())
        self.cells = store.KeyedTable(
            spark,
            f"{self.path}/counts",
            f"{self.kinds}, _first bigint, _last bigint, cnt bigint, {_PART} bigint",
            _PART,
            store.added_up([*self.keys, *_SPAN, _PART], "cnt"),
            every,
        )

    def cells_of(self, rows: DataFrame) -> DataFrame:
        """The cells of rows that have their first and last window end."""
        inside = rows.filter("_first <= _last")
        return inside.groupBy(*self.keys, *_SPAN).agg(F.count("*").alias("cnt")).withColumn(_PART, hour_of(F.col("_last")))

    def add(self, rows: DataFrame, ts: str, batch_id: int) -> None:
        """Counts the rows of a batch in all their windows; rows without a time are in none."""
        cells = self.cells_of(with_spans(rows.filter(F.col(ts).isNotNull()), ts, self.size_us, self.slide_us)).persist()
        try:
            self.cells.put(cells, batch_id, [r[0] for r in cells.select(_PART).distinct().collect()])
        finally:
            cells.unpersist()

    def counts(self) -> DataFrame:
        """The current counts of all windows: keys, window_start, window_end, cnt."""
        counted = span_counts(self.cells.read(), self.keys, *_SPAN, self.size_us, self.slide_us, weight="cnt")
        return with_bounds(counted, self.size_us)


class RankedWindows(CountedWindows):
    """The tables of a ranking below ``path``: counts (cells), ranks, late, progress."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], size: Span, slide: Span, every: int = 8) -> None:
        super().__init__(spark, path, keys, size, slide, every)
        self.ranked = store.KeyedTable(
            spark,
            f"{self.path}/ranks",
            f"{self.kinds}, window_end timestamp, cnt bigint, row_num int, {_PART} bigint",
            _PART,
            store.last_group(["window_end"]),
            every,
        )

    def ranks(self) -> DataFrame:
        """The current ranking of every window."""
        return self.ranked.read().drop(_PART)

    def side_rows(self, schema=None) -> DataFrame:
        """The rows that were in no window any more, with their ``channel``."""
        return sinks.read_log(self.spark, f"{self.path}/late", schema).drop(sinks.BATCH)


def _pieces(runs: DataFrame, slide_us: int) -> DataFrame:
    """Runs of ends, cut at the hours."""
    hours = F.sequence(hour_of(F.col("_at")), hour_of(F.col("_until") - F.lit(slide_us)))
    cut = runs.withColumn(_PART, F.explode(hours))
    from_hour, to_hour = F.col(_PART) * F.lit(_HOUR), (F.col(_PART) + 1) * F.lit(_HOUR)
    # The first end of an hour is not at its start unless slide and offset make it so.
    step, at, until = F.lit(slide_us), F.col("_at"), F.col("_until")

    def first_from(bound: Column) -> Column:
        return at + F.greatest(F.ceil((bound - at) / step), F.lit(0)).cast("bigint") * step

    return cut.withColumns({"_at": first_from(from_hour), "_until": F.least(until, first_from(to_hour))}).filter("_at < _until")


def _changed_runs(cells: DataFrame, size_us: int, slide_us: int) -> DataFrame:
    """The window ends of some cells as longest runs within an hour."""
    runs = _pieces(span_plateaus(cells, [], *_SPAN, size_us, slide_us).select("_at", "_until"), slide_us)
    line = Window.partitionBy(_PART).orderBy("_at")
    begins = F.coalesce((F.lag("_until").over(line) < F.col("_at")).cast("int"), F.lit(1))
    islands = runs.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(line))
    return islands.groupBy(_PART, "_island").agg(F.min("_at").alias("_from"), F.max("_until").alias("_to")).drop("_island")


def _changed_counts(tables: RankedWindows, cells: DataFrame) -> tuple[DataFrame, list[int]]:
    """Counts per key of all windows that ``cells`` lie in, and the hours of their ends."""
    size_us, slide_us = tables.size_us, tables.slide_us
    ends = F.explode(F.sequence(hour_of(F.col("_first")), hour_of(F.col("_last"))))
    hours = sorted(r[0] for r in cells.select(ends.alias(_PART)).distinct().collect())  # bounded by the calendar
    # A cell of a later hour may reach back by less than a window.
    beyond = range(-(-size_us // _HOUR) + 1)
    held = tables.cells.read(sorted({h + i for h in hours for i in beyond}))
    runs = span_plateaus(held, tables.keys, *_SPAN, size_us, slide_us, weight="cnt")
    near = _pieces(runs, slide_us).join(_changed_runs(cells, size_us, slide_us), _PART)
    near = near.filter("_at < _to AND _from < _until")
    step = F.lit(slide_us)
    unfolded = F.sequence(F.greatest("_at", "_from"), F.least("_until", "_to") - step, step)
    counts = near.select(*tables.keys, F.explode(unfolded).alias("_end"), "cnt")
    return with_bounds(counts, size_us).drop("window_start"), hours


def ranked_windows(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    n: int,
    size: Span,
    slide: Span,
    where: Column | None = None,
    seq: str | None = None,
    delay: Span = lateness.OUT_OF_ORDER,
    allowed: Span = lateness.ALLOWED_LATENESS,
    tie: Sequence[str] = (),
    ts: str = "ts",
    once: bool = False,
    every: int = 8,
) -> StreamingQuery:
    """Starts the job: the ``n`` largest keys per window, ranked early and corrected by every batch that touches a window.

    With ``seq`` (arrival numbers) a row is late if all its windows closed before it came (``lateness.with_lateness``); it then
    goes to the late rows instead, and a row that is late for some windows counts in the others. ``where`` is asked after
    that, as every row moves time on. Without ``seq`` all rows count. Each batch is read once. Read the results with
    ``RankedWindows``; rows without a time are in no window.
    """
    size_us, slide_us = span_micros(size), span_micros(slide)
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    wanted = F.lit(True) if where is None else where

    def marked(batch: DataFrame, tables: RankedWindows, batch_id: int) -> DataFrame:
        if seq is None:
            return with_spans(batch, ts, size_us, slide_us).withColumn("channel", F.lit(lateness.ON_TIME))
        before = None
        if batch_id > 0:
            before = tables.spark.read.parquet(f"{tables.path}/progress/{sinks.BATCH}={batch_id - 1}").head()[0]
        return lateness.with_lateness(batch, ts, seq, size, slide, delay, allowed, tie, seen_until=before).withColumn(
            "_seen", F.greatest(F.when(F.col(seq).isNotNull(), micros(ts)), F.lit(before).cast("bigint"))
        )

    def take(batch: DataFrame, batch_id: int) -> None:
        tables = RankedWindows(batch.sparkSession, path, {k: kinds[k] for k in keys}, size_us, slide_us, every)
        held = marked(batch, tables, batch_id).persist()
        try:
            on_time = held.filter((F.col("channel") == lateness.ON_TIME) & F.col(ts).isNotNull() & wanted)
            cells = tables.cells_of(on_time).persist()
            try:
                parts = [r[0] for r in cells.select(_PART).distinct().collect()]
                tables.cells.put(cells, batch_id, parts)
                if parts:
                    counts, hours = _changed_counts(tables, cells)
                    ranked = topn.top_n(counts, n, keys).withColumn(_PART, hour_of(micros("window_end")))
                    tables.ranked.put(ranked, batch_id, hours)
            finally:
                cells.unpersist()
            if seq is not None:
                late = held.filter((F.col("channel") != lateness.ON_TIME) & wanted).drop(*_SPAN, "_seen")
                sinks.write_batch(late, f"{tables.path}/late", batch_id)
                sinks.write_batch(held.agg(F.max("_seen").alias("seen_until")), f"{tables.path}/progress", batch_id)
        finally:
            held.unpersist()

    return run(rows, take, checkpoint, once=once)
