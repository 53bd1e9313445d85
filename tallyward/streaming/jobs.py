"""Starting the jobs on unbounded input.

``run`` starts any streaming DataFrame with an idempotent sink. Operators of ``tallyward.operators`` that accept
streams are used as they are; rankings, late rows and rules have the twins below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward.functions.timing import Span, micros, span_text
from tallyward.operators import lateness, topn
from tallyward.plans import jobs
from tallyward.streaming import sinks

# Fixed value: events come in order. Spark drops rows at the watermark itself, so it has to trail by a tick for a row
# with the time of the latest one to be kept when it comes a batch later.
IN_ORDER = "1 millisecond"


def watermarked(df: DataFrame, delay: Span = IN_ORDER, ts: str = "ts") -> DataFrame:
    return df.withWatermark(ts, span_text(delay))


def run(
    df: DataFrame,
    writer: sinks.BatchWriter,
    checkpoint: str,
    mode: str = "append",
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query; ``once`` processes what is there in as many batches as the source gives, then stops."""
    stream = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(writer)
    if name:
        stream = stream.queryName(name)
    return (stream.trigger(availableNow=True) if once else stream).start()


def flush_row(df: DataFrame, at: str, ts: str = "ts", **values) -> DataFrame:
    """A row far in the future, to be sent last in a finite replay: it moves the watermark past all real rows.

    Its own window stays open, so it never shows up in a result.
    """
    columns = []
    for field in df.schema.fields:
        value = F.lit(at) if field.name == ts else F.lit(values.get(field.name))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.sparkSession.range(1).select(*columns)


# --- rankings ---------------------------------------------------------------------------------------------


def hot_items(
    behaviors: DataFrame, path: str, checkpoint: str, n: int = jobs.HOT_ITEMS, once: bool = False, **settings
) -> StreamingQuery:
    """Rank each window when it is final. All counts of a window end become final in the same batch."""
    counts = jobs.item_counts(behaviors, **settings)
    return run(counts, sinks.log_writer(path, lambda batch: topn.top_n(batch, n, ["item_id"])), checkpoint, once=once)


def top_pages(
    log: DataFrame,
    counts_path: str,
    ranks_path: str,
    checkpoint: str,
    n: int = jobs.HOT_PAGES,
    once: bool = False,
    **settings,
) -> StreamingQuery:
    """Rank early and correct later: every batch ranks the windows whose counts changed again."""
    writer = sinks.ranked_update_writer(
        counts_path, ranks_path, lambda counts: topn.top_n(counts, n, ["url"]), ["url"]
    )
    return run(jobs.page_counts(log, early=True, **settings), writer, checkpoint, "update", once)


# --- late rows --------------------------------------------------------------------------------------------


def late_split(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    seq: str,
    size: Span = jobs.PAGE_SIZE,
    slide: Span = jobs.PAGE_SLIDE,
    delay: Span = lateness.OUT_OF_ORDER,
    allowed: Span = lateness.ALLOWED_LATENESS,
    tie: Sequence[str] = (),
    ts: str = "ts",
    once: bool = False,
) -> StreamingQuery:
    """Split arriving rows into ``on-time`` and ``late`` sub-folders before any stateful operator drops them.

    The largest event time so far is one number per batch, kept next to the output. A batch reads the number of the
    batch before it, also when it runs again.
    """
    rows_path, progress_path = f"{path}/rows", f"{path}/progress"

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{progress_path}/{sinks.BATCH}={batch_id - 1}").head()[0]
        marked = lateness.with_lateness(batch, ts, seq, size, slide, delay, allowed, tie, seen_until=before)
        sinks.write_batch(marked.drop("_first", "_last"), rows_path, batch_id, ["channel"])
        reached = batch.agg(F.greatest(F.max(micros(ts)), F.lit(before).cast("bigint")).alias("seen_until"))
        sinks.write_batch(reached, progress_path, batch_id)

    return run(rows, split, checkpoint, once=once)
