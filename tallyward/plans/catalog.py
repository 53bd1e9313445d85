"""Named queries over the given tables, each with the SQL that must give the same rows.

The tables are sparse (one event every few minutes), so time limits are longer than the jobs' defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.functions.hashing import BITMAP_BITS, POLY_BASE
from tallyward.functions.timing import as_wall_clock
from tallyward.operators import visitors, windows
from tallyward.plans import jobs, tables
from tallyward.sources import lines

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    """Add a query; its timestamps are returned as wall-clock (UTC) values like the tables' own."""

    def add(build: Query) -> Query:
        CATALOG[name] = Entry(lambda spark, sf_dir: as_wall_clock(build(spark, sf_dir)), sql)
        return build

    return add


# --- SQL fragments ----------------------------------------------------------------------------------------


def _sliding(source: str, keys: str, size: str, slide: str, where: str = "true") -> str:
    """Counts per key and sliding window by copying each row to its windows."""
    bucket = f"time_bucket(interval {slide}, ts)"
    return f"""SELECT {keys}, window_end, count(*) AS cnt
        FROM (SELECT {keys}, unnest(generate_series({bucket} + interval {slide}, {bucket} + interval {size},
                     interval {slide})) AS window_end
              FROM {source} WHERE {where})
        GROUP BY ALL"""


def _ranked(counts: str, key: str, n: int) -> str:
    return f"""SELECT {key}, cnt, window_end, row_num FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS row_num FROM ({counts}))
        WHERE row_num <= {n}"""


_TOPIC = "(props ->> '$.k')"
_BEHAVIORS = "(SELECT user_id, user_id AS item_id, event_type, ts FROM events)"
_LOG = f"(SELECT event_id, ts, event_type, '/page/' || {_TOPIC} AS url FROM events)"
_MARKETING = f"(SELECT {_TOPIC} AS channel, event_type AS behavior, ts FROM events)"
_SHIPMENTS = "(SELECT l_partkey AS item_id, l_shipdate AS ts FROM lineitem)"
_HOT_ITEMS = _ranked(_sliding(_BEHAVIORS, "item_id", "60 minute", "5 minute", "event_type = 'view'"), "item_id", 5)
_TOP_PAGES = _ranked(_sliding(_LOG, "url", "10 minute", "1 minute", "event_type = 'view'"), "url", 3)


def _report(ranked: str, key: str, rank_end: str, label: str, dashes: int) -> str:
    return f"""SELECT window_end,
        '窗口结束时间：' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
        || string_agg('NO.' || row_num || '{rank_end}' || chr(9) || ' {label} = ' || {key} || chr(9)
                      || ' 热门度 = ' || cnt || chr(10), '' ORDER BY row_num)
        || chr(10) || ' {"=" * dashes} ' || chr(10) || chr(10) AS report
        FROM ({ranked}) GROUP BY window_end"""


_HOUR_END = "time_bucket(interval 1 hour, ts) + interval 1 hour"


# --- user behaviour ---------------------------------------------------------------------------------------


@register("hot_items_topn", _HOT_ITEMS)
def hot_items_topn(spark, sf_dir):
    return jobs.hot_items(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register("hot_items_sql", _HOT_ITEMS)
def hot_items_sql(spark, sf_dir):
    return jobs.hot_items_sql(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register("hot_items_report", _report(_HOT_ITEMS, "item_id", ": ", "商品ID", 33))
def hot_items_report(spark, sf_dir):
    return jobs.hot_items_report(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register("hot_parts_weekly", _ranked(_sliding(_SHIPMENTS, "item_id", "7 day", "1 day"), "item_id", 5))
def hot_parts_weekly(spark, sf_dir):
    return jobs.hot_items(tables.shipments_as_behaviors(spark, sf_dir), size="7 days", slide="1 day")


_PV = f"SELECT {_HOUR_END} AS window_end, count(*) AS cnt FROM events WHERE event_type = 'view' GROUP BY ALL"


@register("pv_hourly", _PV)
def pv_hourly(spark, sf_dir):
    return jobs.page_views(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register("pv_hourly_salted", _PV)
def pv_hourly_salted(spark, sf_dir):
    return jobs.page_views_salted(tables.behaviors(tables.events(spark, sf_dir)), ("event_id",), view="view")


_UV = f"""SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS cnt
    FROM events WHERE event_type = 'view' GROUP BY ALL"""


@register("uv_hourly", _UV)
def uv_hourly(spark, sf_dir):
    return jobs.unique_visitors(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register(
    "uv_hourly_bitmap",
    f"""SELECT {_HOUR_END} AS window_end, count(DISTINCT list_reduce(
            list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''), lambda z: ascii(z)::bigint)),
            lambda a, z: (a * {POLY_BASE} + z) & {(1 << BITMAP_BITS) - 1})) AS cnt
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
)
def uv_hourly_bitmap(spark, sf_dir):
    return jobs.unique_visitors_bitmap(tables.behaviors(tables.events(spark, sf_dir)), view="view")


# At the size this is checked on, windows hold few enough visitors for the sketch to be exact.
@register("uv_hourly_approx", _UV)
def uv_hourly_approx(spark, sf_dir):
    return jobs.unique_visitors_sketch(tables.behaviors(tables.events(spark, sf_dir)), view="view")


@register(
    "uv_daily_merged_approx",
    """SELECT time_bucket(interval 1 day, ts) + interval 1 day AS window_end, count(DISTINCT user_id) AS cnt
       FROM events WHERE event_type = 'view' GROUP BY ALL""",
)
def uv_daily_merged_approx(spark, sf_dir):
    """Hourly sketches rolled up to days."""
    views = tables.events(spark, sf_dir).filter(F.col("event_type") == "view")
    hourly = visitors.visitor_sketches(views, "user_id", "ts", "1 hour")
    return visitors.sketch_totals(visitors.merge_sketches(hourly, "window_end", "1 day"))


@register(
    "uv_first_sightings",
    f"SELECT DISTINCT {_HOUR_END} AS window_end, user_id FROM events WHERE event_type = 'view'",
)
def uv_first_sightings(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    return visitors.first_sightings(events, "user_id", "ts", "1 hour", F.col("event_type") == "view")


# --- web traffic ------------------------------------------------------------------------------------------


@register("top_pages", _TOP_PAGES)
def top_pages(spark, sf_dir):
    return jobs.top_pages(tables.web_log(tables.events(spark, sf_dir)), slide="1 minute")


@register("page_report", _report(_TOP_PAGES, "url", ":", "页面 URL", 35))
def page_report(spark, sf_dir):
    return jobs.top_pages_report(tables.web_log(tables.events(spark, sf_dir)), slide="1 minute")


_LATE_SETTINGS = {"size": "10 minutes", "slide": "5 minutes", "delay": "1 hour", "allowed": "1 hour"}
_ARRIVALS = f"""arrivals AS (
    SELECT *, max(ts) OVER (ORDER BY seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - interval 1 hour AS watermark,
           time_bucket(interval 5 minute, ts) + interval 10 minute AS last_end
    FROM (SELECT event_id, ts, event_type, '/page/' || {_TOPIC} AS url,
                 event_id + (event_id * 7919) % 50 AS seq FROM events))"""
_IS_LATE = "coalesce({end} - interval 1 millisecond + interval 1 hour <= watermark, false)"


@register(
    "late_split",
    f"""WITH {_ARRIVALS}
        SELECT event_id, ts, url, CASE WHEN {_IS_LATE.format(end="last_end")} THEN 'late' ELSE 'on-time' END AS channel
        FROM arrivals WHERE event_type = 'view'""",
)
def late_split(spark, sf_dir):
    log = tables.disordered_web_log(tables.events(spark, sf_dir))
    return jobs.marked_requests(log, "seq", ["event_id"], **_LATE_SETTINGS).select("event_id", "ts", "url", "channel")


@register(
    "late_requests",
    f"""WITH {_ARRIVALS}
        SELECT event_id, ts, url FROM arrivals WHERE event_type = 'view' AND {_IS_LATE.format(end="last_end")}""",
)
def late_requests(spark, sf_dir):
    log = tables.disordered_web_log(tables.events(spark, sf_dir))
    return jobs.late_requests(log, "seq", tie=["event_id"], **_LATE_SETTINGS).select("event_id", "ts", "url")


@register(
    "top_pages_in_arrival_order",
    f"""WITH {_ARRIVALS},
        copies AS (SELECT url, watermark, unnest([last_end - interval 5 minute, last_end]) AS window_end
                   FROM arrivals WHERE event_type = 'view'),
        counts AS (SELECT url, window_end, count(*) AS cnt FROM copies
                   WHERE NOT {_IS_LATE.format(end="window_end")} GROUP BY ALL)
        {_ranked("SELECT * FROM counts", "url", 3)}""",
)
def top_pages_in_arrival_order(spark, sf_dir):
    log = tables.disordered_web_log(tables.events(spark, sf_dir))
    return jobs.top_pages_in_arrival_order(log, "seq", tie=["event_id"], **_LATE_SETTINGS)


# --- marketing --------------------------------------------------------------------------------------------


@register(
    "channel_counts",
    f"""SELECT window_end - interval 1 hour AS window_start, window_end, channel, behavior, cnt
        FROM ({_sliding(_MARKETING, "channel, behavior", "60 minute", "5 minute", "behavior <> 'error'")})""",
)
def channel_counts(spark, sf_dir):
    return jobs.channel_counts(tables.marketing(tables.events(spark, sf_dir)), slide="5 minutes", dropped="error")


_FINE = _sliding(_MARKETING, "channel, behavior", "3600 second", "5 second", "behavior <> 'error'")


@register(
    "channel_peaks",
    f"""SELECT channel, behavior, count(*) AS windows, max(cnt) AS peak, CAST(sum(cnt) AS BIGINT) AS total
        FROM ({_FINE}) GROUP BY ALL""",
)
def channel_peaks(spark, sf_dir):
    """All one-hour windows every five seconds, summed up per channel and behaviour."""
    return jobs.channel_peaks(tables.marketing(tables.events(spark, sf_dir)), dropped="error")


_FINE_CLICKS = f"""SELECT province, count(*) AS windows, CAST(sum(cnt) AS BIGINT) AS total
    FROM ({_sliding("clicks", "province", "3600 second", "5 second", "place <= 2")}) GROUP BY ALL"""


_CLICKS = f"""clicks AS (
    SELECT event_id, user_id, event_type AS ad_id, {_TOPIC} AS province, ts,
           row_number() OVER (PARTITION BY user_id, event_type, CAST(ts + interval 8 hour AS DATE)
                              ORDER BY ts, event_id) AS place
    FROM events)"""


@register("ad_capped", f"WITH {_CLICKS} SELECT event_id, user_id, ad_id, province, ts FROM clicks WHERE place <= 2")
def ad_capped(spark, sf_dir):
    capped = jobs.capped_clicks(tables.ad_clicks(tables.events(spark, sf_dir)), ["event_id"], max_clicks=2)
    return capped.filter(F.col("channel") == "passed").select("event_id", "user_id", "ad_id", "province", "ts")


@register("ad_blacklist", f"WITH {_CLICKS} SELECT user_id, ad_id, ts, '超过点击上限' AS msg FROM clicks WHERE place = 3")
def ad_blacklist(spark, sf_dir):
    clicks = tables.ad_clicks(tables.events(spark, sf_dir))
    return jobs.ad_blacklist(clicks, ["event_id"], max_clicks=2).select("user_id", "ad_id", "ts", "msg")


@register(
    "ad_counts",
    f"""WITH {_CLICKS}
        SELECT window_end, strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' AS window_end_str, province, cnt
        FROM ({_sliding("clicks", "province", "60 minute", "5 minute", "place <= 2")})""",
)
def ad_counts(spark, sf_dir):
    clicks = tables.ad_clicks(tables.events(spark, sf_dir))
    return jobs.province_counts(clicks, ["event_id"], slide="5 minutes", max_clicks=2)


@register("ad_counts_fine", f"WITH {_CLICKS} {_FINE_CLICKS}")
def ad_counts_fine(spark, sf_dir):
    """All one-hour windows every five seconds, unfolded, summed up per province."""
    counted = jobs.province_counts(tables.ad_clicks(tables.events(spark, sf_dir)), ["event_id"], max_clicks=2)
    return counted.groupBy("province").agg(F.count("*").alias("windows"), F.sum("cnt").alias("total"))


# --- logins -----------------------------------------------------------------------------------------------

_LINE = "(PARTITION BY user_id ORDER BY ts, event_id)"


@register(
    "login_pair",
    f"""SELECT user_id, prev_ts AS first_fail_ts, ts AS last_fail_ts, 'login fail in 2s for 2 times' AS msg
        FROM (SELECT *, lag(event_type) OVER {_LINE} AS prev_type, lag(ts) OVER {_LINE} AS prev_ts FROM events)
        WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts <= interval 6 hour""",
)
def login_pair(spark, sf_dir):
    logins = tables.logins(tables.events(spark, sf_dir))
    return jobs.login_pairs(logins, ["event_id"], "6 hours", fail="error")


@register(
    "login_times3",
    f"""SELECT user_id, ts AS first_fail_ts, third AS last_fail_ts, 'login fail' AS msg
        FROM (SELECT *, lead(ts, 2) OVER {_LINE} AS third FROM events WHERE event_type = 'error')
        WHERE third - ts < interval 24 hour""",
)
def login_times3(spark, sf_dir):
    logins = tables.logins(tables.events(spark, sf_dir))
    return jobs.login_times(logins, ["event_id"], 3, "24 hours", fail="error")


@register(
    "login_strict3",
    f"""SELECT user_id, ts AS first_fail_ts, third AS last_fail_ts, 'login fail' AS msg
        FROM (SELECT *, lead(ts, 2) OVER {_LINE} AS third, lead(event_type) OVER {_LINE} AS type2,
                     lead(event_type, 2) OVER {_LINE} AS type3 FROM events)
        WHERE event_type = 'error' AND type2 = 'error' AND type3 = 'error' AND third - ts < interval 24 hour""",
)
def login_strict3(spark, sf_dir):
    logins = tables.logins(tables.events(spark, sf_dir))
    return jobs.login_strict(logins, ["event_id"], 3, "24 hours", fail="error")


@register(
    "login_anchored",
    f"""WITH RECURSIVE
        line AS (SELECT user_id, ts, event_type = 'error' AS failed, row_number() OVER {_LINE} AS place,
                        count(*) OVER (PARTITION BY user_id) AS places FROM events),
        walk AS (
            SELECT user_id, place, places, ts, CASE WHEN failed THEN ts END AS anchor, CASE WHEN failed THEN ts END AS last,
                   CASE WHEN failed THEN 1 ELSE 0 END AS k,
                   NULL::TIMESTAMP AS out_first, NULL::TIMESTAMP AS out_last
            FROM line WHERE place = 1
            UNION ALL
            SELECT n.user_id, n.place, n.places, n.ts,
                   CASE WHEN NOT n.failed THEN NULL
                        WHEN w.anchor IS NULL OR n.ts > w.anchor + interval 24 hour THEN n.ts ELSE w.anchor END,
                   CASE WHEN n.failed THEN n.ts END,
                   CASE WHEN NOT n.failed THEN 0
                        WHEN w.anchor IS NULL OR n.ts > w.anchor + interval 24 hour THEN 1 ELSE w.k + 1 END,
                   CASE WHEN n.ts > w.anchor + interval 24 hour AND w.k >= 2 THEN w.anchor END,
                   CASE WHEN n.ts > w.anchor + interval 24 hour AND w.k >= 2 THEN w.last END
            FROM walk w JOIN line n ON n.user_id = w.user_id AND n.place = w.place + 1)
        SELECT user_id, first_fail_ts, last_fail_ts, 'login in 2s ' AS msg FROM (
            SELECT user_id, out_first AS first_fail_ts, out_last AS last_fail_ts FROM walk WHERE out_first IS NOT NULL
            UNION ALL
            SELECT user_id, anchor, last FROM walk WHERE place = places AND anchor IS NOT NULL AND k >= 2)""",
)
def login_anchored(spark, sf_dir):
    logins = tables.logins(tables.events(spark, sf_dir))
    return jobs.login_anchored(logins, ["event_id"], 2, "24 hours", fail="error")


# --- orders and payments ----------------------------------------------------------------------------------


@register(
    "order_followed_by",
    """SELECT order_id, create_ts, CASE WHEN pay_ts - create_ts < interval 24 hour THEN pay_ts END AS pay_ts,
              CASE WHEN pay_ts - create_ts < interval 24 hour THEN 'payed' ELSE 'timeout' END AS channel,
              '订单' || order_id || CASE WHEN pay_ts - create_ts < interval 24 hour THEN '已经支付' ELSE '已经延迟支付' END
                  AS result_msg
       FROM (SELECT user_id AS order_id, ts AS create_ts, event_type,
                    min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
                        PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_ts
             FROM events)
       WHERE event_type = 'signup'""",
)
def order_followed_by(spark, sf_dir):
    orders = tables.order_events(tables.events(spark, sf_dir))
    return jobs.order_payments(orders, ["event_id"], "24 hours", create="signup", pay="purchase")


def _life_cycle(firsts: str, limit: str) -> str:
    return f"""SELECT *, CASE channel WHEN 'payed' THEN 'payed successfully' WHEN 'data not found' THEN
            'payed not find created' ELSE channel END AS result_msg
        FROM (SELECT *, CASE WHEN create_ts IS NULL THEN 'data not found' WHEN pay_ts IS NULL THEN 'timeout'
                             WHEN pay_ts - create_ts < interval {limit} THEN 'payed' ELSE 'payed-but-timeout' END AS channel
              FROM ({firsts}))"""


@register(
    "order_lifecycle",
    _life_cycle(
        """SELECT user_id AS order_id, strftime(ts, '%Y-%m-%d') AS day,
                  min(ts) FILTER (event_type = 'signup') AS create_ts,
                  min(ts) FILTER (event_type = 'purchase') AS pay_ts
           FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY ALL""",
        "4 hour",
    ),
)
def order_lifecycle(spark, sf_dir):
    orders = tables.order_events(tables.events(spark, sf_dir)).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return jobs.order_life_cycle(orders, ("order_id", "day"), "4 hours", create="signup", pay="purchase")


@register(
    "shipment_lifecycle",
    _life_cycle(
        """SELECT order_id, min(ts) FILTER (kind = 'create') AS create_ts, min(ts) FILTER (kind = 'pay') AS pay_ts
           FROM (SELECT o_orderkey AS order_id, 'create' AS kind, o_orderdate AS ts FROM orders
                 UNION ALL SELECT l_orderkey, 'pay', l_shipdate FROM lineitem) GROUP BY ALL""",
        "60 day",
    ),
)
def shipment_lifecycle(spark, sf_dir):
    return jobs.order_life_cycle(tables.order_and_shipments(spark, sf_dir), within="60 days")


@register(
    "shipment_followed_by",
    """SELECT order_id, create_ts, pay_ts, CASE WHEN pay_ts IS NULL THEN 'timeout' ELSE 'payed' END AS channel,
              '订单' || order_id || CASE WHEN pay_ts IS NULL THEN '已经延迟支付' ELSE '已经支付' END AS result_msg
       FROM (SELECT o_orderkey AS order_id, o_orderdate AS create_ts, min(l_shipdate) AS pay_ts
             FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate
                  AND l_shipdate - o_orderdate < interval 60 day GROUP BY ALL)""",
)
def shipment_followed_by(spark, sf_dir):
    return jobs.order_payments(tables.order_and_shipments(spark, sf_dir), ["event_id"], "60 days")


def _near(low: str, high: str) -> str:
    return f"r.ts BETWEEN p.ts - interval {low} AND p.ts + interval {high}"


_SIDES = """p AS (SELECT event_id, user_id::varchar AS tx_id, ts FROM events WHERE event_type = 'click'),
    r AS (SELECT event_id, user_id::varchar AS tx_id, ts FROM events WHERE event_type = 'purchase')"""
_NEAR = f"p.tx_id = r.tx_id AND {_near('5 hour', '5 hour')}"


def _flat_pairs(matched: DataFrame) -> DataFrame:
    return matched.select(
        F.coalesce("pay.tx_id", "receipt.tx_id").alias("tx_id"),
        F.col("pay.event_id").alias("pay_id"),
        F.col("receipt.event_id").alias("receipt_id"),
        *[c for c in matched.columns if c not in ("pay", "receipt")],
    )


def _both_sides(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    return tables.pays(events), tables.receipts(events)


@register(
    "pay_interval_join",
    f"""WITH {_SIDES} SELECT p.tx_id, p.event_id AS pay_id, r.event_id AS receipt_id
        FROM p JOIN r ON p.tx_id = r.tx_id AND {_near("3 hour", "5 hour")}""",
)
def pay_interval_join(spark, sf_dir):
    return _flat_pairs(jobs.pay_receipt_join(*_both_sides(spark, sf_dir), "-3 hours", "5 hours"))


@register(
    "pay_reconcile",
    f"""WITH {_SIDES} SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.event_id AS pay_id, r.event_id AS receipt_id,
            CASE WHEN r.tx_id IS NULL THEN 'single-pay' WHEN p.tx_id IS NULL THEN 'single-receipt' ELSE 'matched' END
                AS channel
        FROM p FULL OUTER JOIN r ON {_NEAR}""",
)
def pay_reconcile(spark, sf_dir):
    return _flat_pairs(jobs.pay_receipt_pairs(*_both_sides(spark, sf_dir), "5 hours"))


@register(
    "pay_reconcile_once",
    f"""WITH {_SIDES},
        line AS (SELECT *, coalesce(lag(side) OVER w <> side AND ts - lag(ts) OVER w <= interval 5 hour, false) AS linked,
                        lag(event_id) OVER w AS before
                 FROM (SELECT 0 AS side, * FROM p UNION ALL SELECT 1, * FROM r)
                 WINDOW w AS (PARTITION BY tx_id ORDER BY ts, side, event_id)),
        chains AS (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY tx_id ORDER BY ts, side, event_id)
                       AS chain FROM line),
        places AS (SELECT *, (row_number() OVER w - 1) % 2 = 1 AS pairs,
                          coalesce(lead(linked) OVER (PARTITION BY tx_id ORDER BY ts, side, event_id), false) AS links_on
                   FROM chains WINDOW w AS (PARTITION BY tx_id, chain ORDER BY ts, side, event_id))
        SELECT tx_id, CASE WHEN side = 0 THEN event_id WHEN pairs THEN before END AS pay_id,
               CASE WHEN side = 1 THEN event_id WHEN pairs THEN before END AS receipt_id,
               CASE WHEN pairs THEN 'matched' WHEN side = 0 THEN 'single-pay' ELSE 'single-receipt' END AS channel
        FROM places WHERE pairs OR NOT links_on""",
)
def pay_reconcile_once(spark, sf_dir):
    return _flat_pairs(jobs.pay_receipt_reconcile(*_both_sides(spark, sf_dir), "event_id", "5 hours"))


@register(
    "single_pay",
    f"WITH {_SIDES} SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_NEAR})",
)
def single_pay(spark, sf_dir):
    return jobs.single_pays(*_both_sides(spark, sf_dir), "5 hours")


@register(
    "single_receipt",
    f"WITH {_SIDES} SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM p WHERE {_NEAR})",
)
def single_receipt(spark, sf_dir):
    return jobs.single_receipts(*_both_sides(spark, sf_dir), "5 hours")


@register(
    "pay_with_receipt",
    f"WITH {_SIDES} SELECT * FROM p WHERE EXISTS (SELECT 1 FROM r WHERE {_NEAR})",
)
def pay_with_receipt(spark, sf_dir):
    return jobs.pays_with_receipt(*_both_sides(spark, sf_dir), "5 hours")


@register(
    "shipment_interval_join",
    """SELECT o_orderkey AS tx_id, o_orderdate AS order_ts, l_shipdate AS ship_ts, l_partkey AS part_id
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey
            AND l_shipdate BETWEEN o_orderdate - interval 30 day AND o_orderdate + interval 50 day""",
)
def shipment_interval_join(spark, sf_dir):
    pays, ships = tables.order_pays(spark, sf_dir), tables.shipment_receipts(spark, sf_dir)
    return jobs.pay_receipt_join(pays, ships, "-30 days", "50 days").select(
        F.col("pay.tx_id").alias("tx_id"),
        F.col("pay.ts").alias("order_ts"),
        F.col("receipt.ts").alias("ship_ts"),
        F.col("receipt.part_id").alias("part_id"),
    )


# --- sources ----------------------------------------------------------------------------------------------


def _behavior_rows(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.col("event_id").alias("item_id"),
        tables.topic(events).cast("int").alias("category_id"),
        F.col("event_type").alias("behavior"),
        F.date_trunc("second", "ts").alias("ts"),
    )


@register(
    "encode_value",
    f"""SELECT concat_ws(',', user_id, event_id, {_TOPIC}, event_type, CAST(floor(epoch(ts)) AS BIGINT)) AS value
        FROM events""",
)
def encode_value(spark, sf_dir):
    return lines.encode_records(_behavior_rows(tables.events(spark, sf_dir)), schemas.USER_BEHAVIOR)


_BROKEN = "event_type = 'error'"


@register(
    "parse_csv",
    f"""SELECT user_id, event_id AS item_id, CAST({_TOPIC} AS INTEGER) AS category_id, event_type AS behavior,
               date_trunc('second', ts) AS ts FROM events WHERE NOT {_BROKEN}""",
)
def parse_csv(spark, sf_dir):
    """Round trip through message values; ``error`` lines lose their last field and are left out."""
    return lines.parsed_only(lines.parse_records(_cut_values(spark, sf_dir), schemas.USER_BEHAVIOR))


@register(
    "parse_malformed",
    f"""SELECT concat_ws(',', user_id, event_id, {_TOPIC}, event_type) AS value FROM events WHERE {_BROKEN}""",
)
def parse_malformed(spark, sf_dir):
    return lines.malformed_only(lines.parse_records(_cut_values(spark, sf_dir), schemas.USER_BEHAVIOR))


def _cut_values(spark, sf_dir) -> DataFrame:
    rows = _behavior_rows(tables.events(spark, sf_dir))
    whole = lines.encode_records(rows, schemas.USER_BEHAVIOR)
    return whole.select(
        F.when(F.col("value").contains(",error,"), F.substring_index("value", ",", 4))
        .otherwise(F.col("value"))
        .alias("value")
    )


def _round_trip(rows: DataFrame, schema) -> DataFrame:
    """Through message values and back."""
    return lines.parsed_only(lines.parse_records(lines.encode_records(rows, schema), schema))


_SECOND = "date_trunc('second', ts) AS ts"


@register(
    "parse_ad",
    f"""SELECT user_id, event_id AS ad_id, 'province' || {_TOPIC} AS province, event_type AS city, {_SECOND} FROM events""",
)
def parse_ad(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    province = F.concat(F.lit("province"), tables.topic(events)).alias("province")
    rows = events.select("user_id", F.col("event_id").alias("ad_id"), province, F.col("event_type").alias("city"), "ts")
    return _round_trip(rows, schemas.AD_CLICK)


@register(
    "parse_login", f"SELECT user_id, '10.0.0.' || {_TOPIC} AS ip, event_type, {_SECOND} FROM events"
)
def parse_login(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    ip = F.concat(F.lit("10.0.0."), tables.topic(events)).alias("ip")
    return _round_trip(events.select("user_id", ip, "event_type", "ts"), schemas.LOGIN)


_ORDER_TX = "CASE WHEN event_type = 'purchase' THEN 'tx' || event_id ELSE '' END"


def _order_rows(events: DataFrame) -> DataFrame:
    tx = F.when(F.col("event_type") == "purchase", F.concat(F.lit("tx"), F.col("event_id").cast("string"))).otherwise("")
    return events.select(F.col("user_id").alias("order_id"), "event_type", tx.alias("tx_id"), "ts")


@register("parse_order", f"SELECT user_id AS order_id, event_type, {_ORDER_TX} AS tx_id, {_SECOND} FROM events")
def parse_order(spark, sf_dir):
    """Orders without a transaction keep their empty one."""
    return _round_trip(_order_rows(tables.events(spark, sf_dir)), schemas.ORDER)


@register(
    "payments",
    f"SELECT user_id AS order_id, event_type, {_ORDER_TX} AS tx_id, ts FROM events WHERE event_type = 'purchase'",
)
def payments(spark, sf_dir):
    return jobs.payments(_order_rows(tables.events(spark, sf_dir)))


@register("parse_receipt", f"SELECT 'tx' || event_id AS tx_id, event_type AS pay_channel, {_SECOND} FROM events")
def parse_receipt(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    tx = F.concat(F.lit("tx"), F.col("event_id").cast("string")).alias("tx_id")
    return _round_trip(events.select(tx, F.col("event_type").alias("pay_channel"), "ts"), schemas.RECEIPT)


@register(
    "values_per_window",
    f"""SELECT event_type, time_bucket(interval 1 hour, ts) AS window_start, {_HOUR_END} AS window_end,
               max(event_id) AS last_id, count(DISTINCT user_id) AS users, min({_TOPIC}::bigint) AS lowest
        FROM events GROUP BY ALL""",
)
def values_per_window(spark, sf_dir):
    """Aggregates of one's own per key and window."""
    events = tables.events(spark, sf_dir)
    return windows.windowed_aggregates(
        events,
        ["event_type"],
        "ts",
        "1 hour",
        last_id=F.max("event_id"),
        users=F.count_distinct("user_id"),
        lowest=F.min(tables.topic(events).cast("bigint")),
    )


_HOLED = """(SELECT event_type, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events)"""


def _holed(events: DataFrame) -> DataFrame:
    """Events of which some have no visitor and some no time."""
    return events.select(
        "event_type",
        F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"),
    )


@register(
    "pv_without_time",
    f"""SELECT {_HOUR_END} AS window_end, count(*) AS cnt FROM {_HOLED} WHERE event_type = 'view' AND ts IS NOT NULL
        GROUP BY ALL""",
)
def pv_without_time(spark, sf_dir):
    rows = _holed(tables.events(spark, sf_dir)).withColumnRenamed("event_type", "behavior")
    return jobs.page_views(rows, view="view")


@register(
    "uv_without_visitor",
    f"""SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS cnt FROM {_HOLED}
        WHERE event_type = 'view' AND ts IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL""",
)
def uv_without_visitor(spark, sf_dir):
    rows = _holed(tables.events(spark, sf_dir)).withColumnRenamed("event_type", "behavior")
    return jobs.unique_visitors(rows, view="view")


@register("top_pages_fine", _ranked(_sliding(_LOG, "url", "10 minute", "5 second", "event_type = 'view'"), "url", 3))
def top_pages_fine(spark, sf_dir):
    """Pages at the job's own slide of five seconds."""
    return jobs.top_pages(tables.web_log(tables.events(spark, sf_dir)))


@register(
    "parse_log",
    f"""SELECT '10.0.0.' || {_TOPIC} AS ip, user_id::varchar AS user_id, date_trunc('second', ts) AS ts,
               CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method, '/item/' || event_id AS url
        FROM events""",
)
def parse_log(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    log = events.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), tables.topic(events)),
            F.col("user_id").cast("string"),
            F.lit("-"),
            F.date_format("ts", lines.LOG_TIME_PATTERN),
            F.lit("+0000"),
            F.when(F.col("event_type") == "view", "GET").otherwise("POST"),
            F.concat(F.lit("/item/"), F.col("event_id").cast("string")),
        ).alias("value")
    )
    return lines.parsed_only(lines.parse_web_log(log))
