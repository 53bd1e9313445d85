"""The jobs as streams over folders of text files, as the command line starts them.

A stream has no arrival numbers: rows of one key at one moment are in the order of their kind. ``delay`` is how far rows may be
behind the latest one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyward import schemas
from tallyward.functions.timing import Span
from tallyward.plans import jobs
from tallyward.sources import lines
from tallyward.streaming import clicks, rankings, rules, sinks
from tallyward.streaming import jobs as streams

_SEQ = "seq"

Start = Callable[[SparkSession, Sequence[str], str, Span, bool], StreamingQuery]


def _records(spark: SparkSession, path: str, schema, delay: Span, unit: str = lines.SECONDS) -> DataFrame:
    rows = lines.parsed_only(lines.parse_records(lines.read_lines(spark, path, streaming=True), schema, unit))
    return streams.watermarked(rows, delay).withColumn(_SEQ, F.lit(0).cast("bigint"))


def _logged(schema, job: Callable[[DataFrame], DataFrame], unit: str = lines.SECONDS) -> Start:
    """A job in append mode: its rows go to ``output``/rows, batch by batch."""

    def start(spark, paths, output, delay, once):
        result = job(_records(spark, paths[0], schema, delay, unit))
        return streams.run(result, sinks.log_writer(f"{output}/rows"), f"{output}/checkpoint", once=once)

    return start


def _payments(job: Callable[[DataFrame, DataFrame], DataFrame]) -> Start:
    def start(spark, paths, output, delay, once):
        pays = _records(spark, paths[0], schemas.ORDER, delay).filter(F.col("tx_id") != "")
        result = job(pays, _records(spark, paths[1], schemas.RECEIPT, delay))
        return streams.run(result, sinks.log_writer(f"{output}/rows"), f"{output}/checkpoint", once=once)

    return start


def _hot_items(spark, paths, output, delay, once):
    behaviors = _records(spark, paths[0], schemas.USER_BEHAVIOR, delay)
    return streams.hot_items(behaviors, f"{output}/rows", f"{output}/checkpoint", once=once)


def _top_pages(spark, paths, output, delay, once):
    """Rankings are corrected by every batch; read them with ``rankings.RankedWindows``."""
    log = lines.parsed_only(lines.parse_web_log(lines.read_lines(spark, paths[0], streaming=True)))
    settings = {"size": jobs.PAGE_SIZE, "slide": jobs.PAGE_SLIDE, "where": F.col("method") == jobs.GET}
    return rankings.ranked_windows(log, output, f"{output}/checkpoint", ["url"], jobs.HOT_PAGES, once=once, **settings)


def _capped_clicks(spark, paths, output, delay, once):
    rows = _records(spark, paths[0], schemas.AD_CLICK, delay)
    return clicks.capped_clicks(rows, output, f"{output}/checkpoint", ["user_id", "ad_id"], "ts", _SEQ, once=once)


def _logins(rule: Callable, **settings) -> Start:
    return _logged(schemas.LOGIN, lambda rows: rule(rows, "user_id", "ts", _SEQ, F.col("event_type") == jobs.FAIL, **settings))


def _orders(rule: Callable, key) -> Start:
    def ruled(rows: DataFrame) -> DataFrame:
        return rule(rows, key, "ts", _SEQ, F.col("event_type") == jobs.CREATE, F.col("event_type") == jobs.PAY)

    return _logged(schemas.ORDER, ruled)


def starts() -> dict[str, Start]:
    return {
        "hot_items": _hot_items,
        "page_views": _logged(schemas.USER_BEHAVIOR, jobs.page_views),
        "unique_visitors": _logged(schemas.USER_BEHAVIOR, jobs.unique_visitors),
        "top_pages": _top_pages,
        "channel_counts": _logged(schemas.MARKETING, jobs.channel_counts, lines.MILLIS),
        "capped_clicks": _capped_clicks,
        "login_pairs": _logins(rules.consecutive_pairs),
        "login_times": _logins(rules.repeated_failures),
        "login_strict": _logins(rules.repeated_failures, strict=True),
        "login_anchored": _logins(rules.anchored_groups),
        "order_payments": _orders(rules.followed_by, "order_id"),
        "order_life_cycle": _orders(rules.life_cycle, ["order_id"]),
        "pay_receipt_join": _payments(jobs.pay_receipt_join),
        "pay_receipt_pairs": _payments(jobs.pay_receipt_pairs),
    }
