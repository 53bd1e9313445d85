"""Order payment rules: create followed by pay, and the four-way order life cycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, micros, span_micros
from tallyward.operators.slots import OWN, SLOT, US, with_slots

# Payment limit, channel names and result texts.
PAY_WITHIN = "15 minutes"
PAYED, TIMEOUT, LATE_PAY, NO_CREATE = "payed", "timeout", "payed-but-timeout", "data not found"
PAYED_TEXT = "订单{}已经支付"
TIMEOUT_TEXT = "订单{}已经延迟支付"
LIFECYCLE_TEXTS = {
    PAYED: "payed successfully",
    LATE_PAY: "payed-but-timeout",
    TIMEOUT: "timeout",
    NO_CREATE: "payed not find created",
}


def keyed_text(template: str, key: str) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), F.col(key).cast("string"), F.lit(after))


def lifecycle_text(channel: str) -> Column:
    texts = F.create_map(*[F.lit(word) for pair in LIFECYCLE_TEXTS.items() for word in pair])
    return texts[F.col(channel)]


def followed_by(
    df: DataFrame,
    key: str,
    ts: str,
    seq: Sequence[str],
    first: Column,
    then: Column,
    within: Span = PAY_WITHIN,
) -> DataFrame:
    """Per ``first`` event, the next ``then`` event of the key if it comes in less than ``within``.

    One row per ``first`` event: ``key, create_ts, pay_ts, channel, result_msg`` with channel ``payed`` or
    ``timeout`` (``pay_ts`` NULL). A ``then`` event without a ``first`` event before it is ignored.
    """
    span = span_micros(within)
    steps = df.filter(first | then).select(key, ts, *seq, first.alias("_first"), then.alias("_then"))
    rows = with_slots(steps, ts, ahead=span)
    # Read backwards, the nearest later payment is a running value (linear in the slot's rows).
    later = (
        Window.partitionBy(key, SLOT)
        .orderBy(F.desc(US), *[F.desc(c) for c in seq])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    next_pay = F.last(F.when(F.col("_then"), F.col(US)), ignorenulls=True).over(later)
    found = rows.select(key, OWN, US, "_first", next_pay.alias("_pay")).filter(F.col(OWN) & F.col("_first"))
    in_time = F.coalesce(F.col("_pay") - F.col(US) < span, F.lit(False))
    return found.select(
        key,
        F.timestamp_micros(US).alias("create_ts"),
        F.when(in_time, F.timestamp_micros("_pay")).alias("pay_ts"),
        F.when(in_time, PAYED).otherwise(TIMEOUT).alias("channel"),
        F.when(in_time, keyed_text(PAYED_TEXT, key)).otherwise(keyed_text(TIMEOUT_TEXT, key)).alias("result_msg"),
    )


def life_cycle(
    df: DataFrame, keys: Sequence[str], ts: str, create: Column, pay: Column, within: Span = PAY_WITHIN
) -> DataFrame:
    """One row per order from its first create and first pay: ``keys, create_ts, pay_ts, channel, result_msg``.

    Two conditional minima per order, combined in the map tasks: a much repeated order id costs one row per task.
    """
    us = micros(ts)
    firsts = (
        df.filter(create | pay)
        .groupBy(*keys)
        .agg(F.min(F.when(create, us)).alias("_create"), F.min(F.when(pay, us)).alias("_pay"))
    )
    created, payed = F.col("_create"), F.col("_pay")
    channel = (
        F.when(created.isNull(), NO_CREATE)
        .when(payed.isNull(), TIMEOUT)
        .when(payed - created < span_micros(within), PAYED)
        .otherwise(LATE_PAY)
    )
    return firsts.withColumn("channel", channel).select(
        *keys,
        F.timestamp_micros("_create").alias("create_ts"),
        F.timestamp_micros("_pay").alias("pay_ts"),
        "channel",
        lifecycle_text("channel").alias("result_msg"),
    )
