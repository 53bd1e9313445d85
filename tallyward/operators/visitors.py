"""Unique visitors per tumbling window: exact, bitmap and sketch forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.hashing import BITMAP_BITS, POLY_BASE, poly_offset
from tallyward.functions.timing import Span, filter_rows, last_window_end, micros, span_micros, span_text

SKETCH_LG_K = 12


def _with_end(df: DataFrame, ts: str, size: Span) -> DataFrame:
    size_us = span_micros(size)
    return df.withColumn("window_end", F.timestamp_micros(last_window_end(micros(ts), size_us, size_us)))


def _known(key: str, where: Column | None = None) -> Column:
    known = F.col(key).isNotNull()
    return known if where is None else known & where


def unique_visitors(df: DataFrame, key: str, ts: str, size: Span, where: Column | None = None) -> DataFrame:
    """Exact distinct keys per window: ``window_end, cnt``. A NULL key is no visitor.

    Two steps, (window, key) then window, so a hot window is spread over all its keys and the
    second step counts map-side. The same two steps run on a stream, where ``count_distinct`` is not allowed.
    """
    df = filter_rows(df, _known(key, where), ts)
    if df.isStreaming:
        text = span_text(size)
        seen = df.groupBy(F.window(ts, text).alias("window"), key).agg(F.count("*").alias("_hits"))
        total = seen.groupBy(F.window("window", text).alias("window")).agg(F.count("*").alias("cnt"))
        return total.select(F.col("window.end").alias("window_end"), "cnt")
    return _with_end(df, ts, size).groupBy("window_end").agg(F.count_distinct(F.col(key)).alias("cnt"))


def first_sightings(df: DataFrame, key: str, ts: str, size: Span, where: Column | None = None) -> DataFrame:
    """Each key that is not NULL once per window, on first sight: ``window_end, <key>``. Runs on batches and streams.

    ``window_end`` carries the watermark of ``ts`` on a stream, so state is dropped with its window.
    """
    df = filter_rows(df, _known(key, where), ts)
    window = F.window(ts, span_text(size))
    return df.select(window["end"].alias("window_end"), key).dropDuplicates(["window_end", key])


def visitor_bitmaps(
    df: DataFrame, key: str, ts: str, size: Span, base: int = POLY_BASE, bits: int = BITMAP_BITS
) -> DataFrame:
    """One bit per visitor: ``window_end, bucket, bitmap`` (4 KiB of bits per row).

    Bitmaps of the same bucket merge with ``bitmap_or_agg``; a window needs at most 2^bits / 32768 rows.
    Equal bits are removed first, so a much seen visitor is shuffled once per map task. The remaining positions
    are then brought together by bucket: positions are shuffled, never half-empty bitmaps.
    """
    offset = poly_offset(key, base, bits)
    if df.isStreaming:
        timed = filter_rows(df, _known(key), ts).withColumn("_offset", offset)
        bucket = F.bitmap_bucket_number("_offset").alias("bucket")
        found = timed.groupBy(F.window(ts, span_text(size)).alias("window"), bucket).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_offset")).alias("bitmap")
        )
        return found.select("window", F.col("window.end").alias("window_end"), "bucket", "bitmap")
    bits_set = _with_end(filter_rows(df, _known(key), ts), ts, size).select("window_end", offset.alias("_offset")).distinct()
    return (
        bits_set.select(
            "window_end",
            F.bitmap_bucket_number("_offset").alias("bucket"),
            F.bitmap_bit_position("_offset").alias("_position"),
        )
        .repartition("window_end", "bucket")
        .groupBy("window_end", "bucket")
        .agg(F.bitmap_construct_agg("_position").alias("bitmap"))
    )


def bitmap_totals(bitmaps: DataFrame, size: Span = "1 hour") -> DataFrame:
    """Set bits per window: ``window_end, cnt``. Never more than the exact count. ``size`` is needed on streams."""
    if bitmaps.isStreaming:
        # The window column carries the watermark.
        again = F.window("window", span_text(size)).alias("w")
        total = bitmaps.groupBy(again).agg(F.sum(F.bitmap_count("bitmap")).alias("cnt"))
        return total.select(F.col("w.end").alias("window_end"), "cnt")
    return bitmaps.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("cnt"))


def visitor_sketches(df: DataFrame, key: str, ts: str, size: Span, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A mergeable distinct-count sketch per window: ``window_end, sketch`` (a few KiB, any row count)."""
    if df.isStreaming:
        window = F.window(ts, span_text(size)).alias("window")
        found = filter_rows(df, None, ts).groupBy(window).agg(F.hll_sketch_agg(key, F.lit(lg_k)).alias("sketch"))
        return found.select(F.col("window.end").alias("window_end"), "sketch")
    return _with_end(filter_rows(df, None, ts), ts, size).groupBy("window_end").agg(F.hll_sketch_agg(key, F.lit(lg_k)).alias("sketch"))


def sketch_totals(sketches: DataFrame) -> DataFrame:
    """Estimated visitors per window: ``window_end, cnt``."""
    return sketches.select("window_end", F.hll_sketch_estimate("sketch").alias("cnt"))


def merge_sketches(sketches: DataFrame, ts: str, size: Span) -> DataFrame:
    """Roll window sketches up to a longer tumbling window without reading the rows again."""
    size_us = span_micros(size)
    # A sketch belongs to the instant just before its window end.
    longer = last_window_end(micros(ts) - F.lit(1), size_us, size_us)
    return sketches.groupBy(F.timestamp_micros(longer).alias("window_end")).agg(
        F.hll_union_agg("sketch").alias("sketch")
    )
