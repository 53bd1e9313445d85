"""The analytics jobs: operators put together over the record types of ``tallyward.schemas``.

Defaults are the jobs' usual settings. Inputs are batch tables; jobs marked "also on streams" take a
watermarked stream as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.timing import Span, span_text, stamp_text
from tallyward.operators import anchored, click_cap, failures, lateness, matching, orders, topn, visitors, windows

# Event names and settings of the jobs.
VIEW = "pv"
GET = "GET"
UNINSTALL = "UNINSTALL"
FAIL = "fail"
CREATE, PAY = "create", "pay"
HOT_ITEMS, HOT_PAGES = 5, 3
HOUR = "1 hour"
ITEM_SLIDE = "5 minutes"
PAGE_SIZE, PAGE_SLIDE = "10 minutes", "5 seconds"
CHANNEL_SLIDE = "5 seconds"


# --- user behaviour ---------------------------------------------------------------------------------------


def item_counts(behaviors: DataFrame, size: Span = HOUR, slide: Span = ITEM_SLIDE, view: str = VIEW) -> DataFrame:
    """Views per item and sliding window; also on streams."""
    counted = windows.windowed_counts(behaviors, ["item_id"], "ts", size, slide, F.col("behavior") == view)
    return counted.select("item_id", "cnt", "window_end")


def hot_items(
    behaviors: DataFrame, n: int = HOT_ITEMS, size: Span = HOUR, slide: Span = ITEM_SLIDE, view: str = VIEW
) -> DataFrame:
    """The ``n`` most viewed items of every sliding window."""
    return topn.top_n(item_counts(behaviors, size, slide, view), n, ["item_id"])


def hot_items_report(behaviors: DataFrame, n: int = HOT_ITEMS, **settings) -> DataFrame:
    return topn.ranking_report(hot_items(behaviors, n, **settings), "item_id", topn.ITEM_REPORT)


def hot_items_sql(
    behaviors: DataFrame,
    n: int = HOT_ITEMS,
    size: Span = HOUR,
    slide: Span = ITEM_SLIDE,
    view: str = VIEW,
) -> DataFrame:
    """The same ranking in SQL text; tables and values are arguments, so no view of that name is left behind."""
    spark = behaviors.sparkSession
    # The spans are made from numbers: a window's size must be a literal.
    spans = f"'{span_text(size)}', '{span_text(slide)}'"
    counts = spark.sql(
        f"""SELECT item_id, count(item_id) AS cnt, w.end AS window_end
            FROM (SELECT item_id, window(ts, {spans}) AS w FROM {{behaviors}} WHERE behavior = :view)
            GROUP BY item_id, w""",
        args={"view": view},
        behaviors=behaviors.select("item_id", "behavior", "ts"),
    )
    return spark.sql(
        """SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
                FROM {counts})
            WHERE row_num <= :n""",
        args={"n": int(n)},
        counts=counts,
    )


def page_views(behaviors: DataFrame, size: Span = HOUR, view: str = VIEW) -> DataFrame:
    """Views per tumbling window; also on streams."""
    counted = windows.windowed_counts(behaviors, [], "ts", size, where=F.col("behavior") == view)
    return counted.select("window_end", "cnt")


def page_views_salted(
    behaviors: DataFrame, spread_by: Sequence[str] = ("user_id", "item_id", "ts"), size: Span = HOUR, view: str = VIEW
) -> DataFrame:
    """Views per tumbling window through a salted first stage; also on streams."""
    return windows.salted_window_counts(behaviors, "ts", size, spread_by, where=F.col("behavior") == view)


def unique_visitors(behaviors: DataFrame, size: Span = HOUR, view: str = VIEW) -> DataFrame:
    """Exact visitors per tumbling window; also on streams."""
    return visitors.unique_visitors(behaviors, "user_id", "ts", size, F.col("behavior") == view)


def unique_visitors_bitmap(behaviors: DataFrame, size: Span = HOUR, view: str = VIEW) -> DataFrame:
    """Visitors per tumbling window from a bitmap of hashed ids (collisions undercount)."""
    views = behaviors.filter(F.col("behavior") == view)
    return visitors.bitmap_totals(visitors.visitor_bitmaps(views, "user_id", "ts", size))


def unique_visitors_sketch(behaviors: DataFrame, size: Span = HOUR, view: str = VIEW) -> DataFrame:
    """Estimated visitors per tumbling window from a mergeable sketch."""
    views = behaviors.filter(F.col("behavior") == view)
    return visitors.sketch_totals(visitors.visitor_sketches(views, "user_id", "ts", size))


# --- web traffic ------------------------------------------------------------------------------------------


def page_counts(
    log: DataFrame, size: Span = PAGE_SIZE, slide: Span = PAGE_SLIDE, method: str = GET, early: bool = False
) -> DataFrame:
    """Requests per URL and sliding window; also on streams, with ``early`` for update mode."""
    counted = windows.windowed_counts(log, ["url"], "ts", size, slide, F.col("method") == method, early)
    return counted.select("url", "cnt", "window_end")


def top_pages(
    log: DataFrame, n: int = HOT_PAGES, size: Span = PAGE_SIZE, slide: Span = PAGE_SLIDE, method: str = GET
) -> DataFrame:
    return topn.top_n(page_counts(log, size, slide, method), n, ["url"])


def top_pages_report(log: DataFrame, n: int = HOT_PAGES, **settings) -> DataFrame:
    return topn.ranking_report(top_pages(log, n, **settings), "url", topn.PAGE_REPORT)


def marked_requests(
    log: DataFrame,
    seq: str,
    tie: Sequence[str] = (),
    size: Span = PAGE_SIZE,
    slide: Span = PAGE_SLIDE,
    delay: Span = lateness.OUT_OF_ORDER,
    allowed: Span = lateness.ALLOWED_LATENESS,
    method: str = GET,
) -> DataFrame:
    """Requests in arrival order with their lateness. Every row moves the watermark, then the method is filtered."""
    marked = lateness.with_lateness(log, "ts", seq, size, slide, delay, allowed, tie)
    return marked.filter(F.col("method") == method)


def late_requests(log: DataFrame, seq: str, **settings) -> DataFrame:
    """Requests too late for all of their windows."""
    return lateness.late_rows(marked_requests(log, seq, **settings))


def top_pages_in_arrival_order(
    log: DataFrame, seq: str, n: int = HOT_PAGES, size: Span = PAGE_SIZE, slide: Span = PAGE_SLIDE, **settings
) -> DataFrame:
    """Final page ranking when late requests are left out."""
    marked = marked_requests(log, seq, size=size, slide=slide, **settings)
    counted = lateness.on_time_counts(marked, ["url"], size, slide)
    return topn.top_n(counted.select("url", "cnt", "window_end"), n, ["url"])


# --- marketing --------------------------------------------------------------------------------------------


def channel_counts(
    marketing: DataFrame, size: Span = HOUR, slide: Span = CHANNEL_SLIDE, dropped: str = UNINSTALL
) -> DataFrame:
    """Actions per channel and behaviour and sliding window; also on streams."""
    return windows.windowed_counts(
        marketing, ["channel", "behavior"], "ts", size, slide, F.col("behavior") != dropped
    ).select("window_start", "window_end", "channel", "behavior", "cnt")


def channel_peaks(
    marketing: DataFrame, size: Span = HOUR, slide: Span = CHANNEL_SLIDE, dropped: str = UNINSTALL
) -> DataFrame:
    """Per channel and behaviour: non-empty sliding windows, their largest count and the sum of their counts."""
    runs = windows.window_plateaus(
        marketing, ["channel", "behavior"], "ts", size, slide, F.col("behavior") != dropped
    )
    return runs.groupBy("channel", "behavior").agg(
        F.sum("windows").alias("windows"),
        F.max("cnt").alias("peak"),
        F.sum(F.col("windows") * F.col("cnt")).alias("total"),
    )


def capped_clicks(
    clicks: DataFrame, seq: Sequence[str], max_clicks: int = click_cap.MAX_CLICKS, zone: str = click_cap.BUSINESS_ZONE
) -> DataFrame:
    return click_cap.click_cap(clicks, ["user_id", "ad_id"], "ts", seq, max_clicks, zone)


def ad_blacklist(clicks: DataFrame, seq: Sequence[str], **settings) -> DataFrame:
    """One warning per (user, ad, business day) that goes over the cap."""
    return click_cap.warnings(capped_clicks(clicks, seq, **settings), ["user_id", "ad_id"], "ts")


def province_counts(
    clicks: DataFrame, seq: Sequence[str], size: Span = HOUR, slide: Span = CHANNEL_SLIDE, **settings
) -> DataFrame:
    """Clicks per province and sliding window, counting only clicks under the cap."""
    kept = click_cap.passed(capped_clicks(clicks, seq, **settings))
    counted = windows.windowed_counts(kept, ["province"], "ts", size, slide)
    return counted.select("window_end", stamp_text("window_end").alias("window_end_str"), "province", "cnt")


# --- logins -----------------------------------------------------------------------------------------------


def login_pairs(logins: DataFrame, seq: Sequence[str], within: Span = failures.PAIR_WITHIN, fail: str = FAIL):
    return failures.consecutive_pairs(logins, "user_id", "ts", seq, F.col("event_type") == fail, within)


def login_times(
    logins: DataFrame, seq: Sequence[str], times: int = 3, within: Span = failures.GROUP_WITHIN, fail: str = FAIL
) -> DataFrame:
    return failures.relaxed_times(logins, "user_id", "ts", seq, F.col("event_type") == fail, times, within)


def login_strict(
    logins: DataFrame, seq: Sequence[str], times: int = 3, within: Span = failures.GROUP_WITHIN, fail: str = FAIL
) -> DataFrame:
    return failures.strict_times(logins, "user_id", "ts", seq, F.col("event_type") == fail, times, within)


def login_anchored(
    logins: DataFrame,
    seq: Sequence[str],
    times: int = anchored.MIN_TIMES,
    within: Span = failures.GROUP_WITHIN,
    fail: str = FAIL,
) -> DataFrame:
    return anchored.anchored_groups(logins, "user_id", "ts", seq, F.col("event_type") == fail, times, within)


# --- orders and payments ----------------------------------------------------------------------------------


def order_payments(
    order_events: DataFrame, seq: Sequence[str], within: Span = orders.PAY_WITHIN, create: str = CREATE, pay: str = PAY
) -> DataFrame:
    kind = F.col("event_type")
    return orders.followed_by(order_events, "order_id", "ts", seq, kind == create, kind == pay, within)


def order_life_cycle(
    order_events: DataFrame,
    keys: Sequence[str] = ("order_id",),
    within: Span = orders.PAY_WITHIN,
    create: str = CREATE,
    pay: str = PAY,
) -> DataFrame:
    kind = F.col("event_type")
    return orders.life_cycle(order_events, keys, "ts", kind == create, kind == pay, within)


def payments(order_events: DataFrame) -> DataFrame:
    """Order events that carry a transaction id."""
    return order_events.filter(F.col("tx_id") != "")


def pay_receipt_join(
    pays: DataFrame, receipts: DataFrame, lower: Span = matching.JOIN_LOWER, upper: Span = matching.JOIN_UPPER
) -> DataFrame:
    """Payment and receipt pairs of one transaction, near in time; also on streams."""
    return matching.interval_join(pays, receipts, "tx_id", "ts", "ts", lower, upper)


def pay_receipt_pairs(pays: DataFrame, receipts: DataFrame, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    """All near pairs and the singles of both sides; also on streams."""
    return matching.reconcile_pairs(pays, receipts, "tx_id", "ts", "ts", within)


def pay_receipt_reconcile(
    pays: DataFrame, receipts: DataFrame, seq: str, within: Span = matching.RECONCILE_WITHIN
) -> DataFrame:
    """One-to-one reconciliation with unmatched payments and receipts."""
    return matching.reconcile(pays, receipts, "tx_id", "ts", "ts", seq, seq, within)


def single_pays(pays: DataFrame, receipts: DataFrame, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    return matching.left_without_partner(pays, receipts, "tx_id", "ts", "ts", within)


def single_receipts(pays: DataFrame, receipts: DataFrame, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    return matching.right_without_partner(pays, receipts, "tx_id", "ts", "ts", within)


def pays_with_receipt(pays: DataFrame, receipts: DataFrame, within: Span = matching.RECONCILE_WITHIN) -> DataFrame:
    return matching.left_with_partner(pays, receipts, "tx_id", "ts", "ts", within)
