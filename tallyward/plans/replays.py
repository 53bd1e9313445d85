"""Streaming twins replayed over the given tables to the end, checked by the same SQL as the batch queries.

The table is read as a file stream, followed by one flush row that lets the watermark pass the last real row.
Results go to a folder under the cluster's shared checkpoint folder and are read back from there.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.timing import filter_rows, stamp_text
from tallyward.operators import click_cap, matching, visitors
from tallyward.plans import jobs, tables
from tallyward.plans.catalog import CATALOG, _flat_pairs, register
from tallyward.session import ROCKSDB_STORE
from tallyward.streaming import clicks, firing, rankings, rules, sinks, store
from tallyward.streaming import jobs as streams

_END = "2030-01-01 00:00:00"


@contextmanager
def _replay_settings(spark: SparkSession):
    """State in RocksDB, one state partition per core: a query keeps the settings it was started with."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STORE,
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _table_stream(
    spark: SparkSession, sf_dir: str, schema, name: str = "events", per_batch: int | None = None
) -> DataFrame:
    """A table as a file stream, be it one file or a folder of part files (a plain path would not take a file).

    With ``per_batch``, a micro-batch takes so many files at most, in the order in which they were written.
    """
    path = f"{sf_dir}/{name}.parque[t]"
    if not spark.read.schema(schema).parquet(path).inputFiles():
        raise FileNotFoundError(path)
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(path)


def event_stream(spark: SparkSession, sf_dir: str, folder: str, delay=streams.IN_ORDER, **flush) -> DataFrame:
    """The events table as a watermarked stream that ends with a flush row."""
    events = tables.events(spark, sf_dir)
    stored = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    values = {"event_id": (1 << 62), "user_id": -1, "event_type": "flush", "props": "{}", **flush}
    streams.flush_row(events, _END, **values).write.mode("overwrite").parquet(f"{folder}/flush")
    rows = _table_stream(spark, sf_dir, stored)
    last = spark.readStream.schema(events.schema).parquet(f"{folder}/flush")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.watermarked(rows.unionByName(last), delay)


def replayed(spark: SparkSession, folder: str, result: DataFrame) -> DataFrame:
    return _replayed_log(spark, folder, result).drop(sinks.BATCH)


def _replayed_log(spark: SparkSession, folder: str, result: DataFrame, mode: str = "append") -> DataFrame:
    with _replay_settings(spark):
        writer = sinks.log_writer(f"{folder}/out")
        streams.run(result, writer, f"{folder}/checkpoint", mode, once=True).awaitTermination()
    return sinks.read_log(spark, f"{folder}/out", result.schema)


def _replay(name: str, same_as: str):
    """Register ``stream_<name>``: a function from the event stream to a result in append mode.

    ``same_as`` is a batch query with the same SQL, or the SQL itself.
    """

    def add(build: Callable[[DataFrame], DataFrame]):
        def run(spark, sf_dir):
            folder = sinks.shared_folder(spark, name)
            return replayed(spark, folder, build(event_stream(spark, sf_dir, folder)))

        register(f"stream_{name}", CATALOG[same_as].sql if same_as in CATALOG else same_as)(run)
        return build

    return add


@_replay("pv_hourly", "pv_hourly")
def pv_hourly(events):
    return jobs.page_views(tables.behaviors(events), view="view")


@_replay("pv_hourly_salted", "pv_hourly")
def pv_hourly_salted(events):
    return jobs.page_views_salted(tables.behaviors(events), ("event_id",), view="view")


@_replay("uv_hourly", "uv_hourly")
def uv_hourly(events):
    return jobs.unique_visitors(tables.behaviors(events), view="view")


@_replay("uv_first_sightings", "uv_first_sightings")
def uv_first_sightings(events):
    return visitors.first_sightings(events, "user_id", "ts", "1 hour", F.col("event_type") == "view")


@_replay("channel_counts", "channel_counts")
def channel_counts(events):
    return jobs.channel_counts(tables.marketing(events), slide="5 minutes", dropped="error")


def _capped(spark, sf_dir, name: str, also=None) -> tuple[str, DataFrame]:
    """The cap's job over the events; its folder and what it let through or warned of."""
    folder = sinks.shared_folder(spark, name)
    rows = _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    events = tables.ad_clicks(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    with _replay_settings(spark):
        query = clicks.capped_clicks(
            events, folder, f"{folder}/checkpoint", ["user_id", "ad_id"], "ts", "event_id", 2, also=also and also(folder), once=True
        )
        query.awaitTermination()
    return folder, clicks.capped_rows(spark, folder)


@register("stream_ad_capped", CATALOG["ad_capped"].sql)
def ad_capped(spark, sf_dir):
    return _capped(spark, sf_dir, "ad_capped")[1].filter("channel = 'passed'").drop("channel", "day")


@register("stream_ad_counts", CATALOG["ad_counts"].sql)
def ad_counts(spark, sf_dir):
    """The whole job: clicks under the cap, counted per province in sliding hours."""

    def counted(folder):
        return rankings.CountedWindows(spark, folder, {"province": "string"}, "1 hour", "5 minutes")

    folder, _ = _capped(spark, sf_dir, "ad_counts", lambda folder: lambda rows, n: counted(folder).add(rows, "ts", n))
    counts = counted(folder).counts()
    return counts.select("window_end", stamp_text("window_end").alias("window_end_str"), "province", "cnt")


@register("stream_ad_blacklist", CATALOG["ad_blacklist"].sql)
def ad_blacklist(spark, sf_dir):
    over = _capped(spark, sf_dir, "ad_blacklist")[1]
    return click_cap.warnings(over, ["user_id", "ad_id"], "ts").select("user_id", "ad_id", "ts", "msg")


@_replay("uv_hourly_bitmap", "uv_hourly_bitmap")
def uv_hourly_bitmap(events):
    views = filter_rows(events, F.col("event_type") == "view", "ts")
    return visitors.bitmap_totals(visitors.visitor_bitmaps(views, "user_id", "ts", "1 hour"), "1 hour")


@register("stream_uv_hourly_approx", CATALOG["uv_hourly_approx"].sql)
def uv_hourly_approx(spark, sf_dir):
    """Sketches in update mode, upserted by window end into a keyed table that is read back."""
    folder = sinks.shared_folder(spark, "uv_hourly_approx")
    views = filter_rows(event_stream(spark, sf_dir, folder), F.col("event_type") == "view", "ts")
    counts = visitors.sketch_totals(visitors.visitor_sketches(views, "user_id", "ts", "1 hour"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema.fields)
    table = store.KeyedTable(spark, f"{folder}/out", f"{kinds}, day int", "day", store.last_row(["window_end", "day"]))

    def upsert(batch, batch_id):
        rows = batch.withColumn("day", F.unix_date(F.to_date("window_end"))).persist()
        table.put(rows, batch_id, [r[0] for r in rows.select("day").distinct().collect()])
        rows.unpersist()

    with _replay_settings(spark):
        streams.run(counts, upsert, f"{folder}/checkpoint", "update", once=True).awaitTermination()
    return table.read().drop("day")


@register(
    "stream_uv_early",
    """WITH views AS (SELECT ts, event_id, time_bucket(interval 1 hour, ts) + interval 1 hour AS window_end, user_id FROM events
            WHERE event_type = 'view' AND ts IS NOT NULL AND user_id IS NOT NULL),
        seen AS (SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) = 1 AS fresh FROM views)
        SELECT window_end, row_number() OVER line AS cnt_rows, CAST(sum(fresh::int) OVER line AS BIGINT) AS cnt FROM seen
        WINDOW line AS (PARTITION BY window_end ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def uv_early(spark, sf_dir):
    """Unique visitors of each hour, reported with every view."""
    folder = sinks.shared_folder(spark, "uv_early")
    rows = _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    with _replay_settings(spark):
        firing.early_visitors(
            rows, folder, f"{folder}/checkpoint", "user_id", "ts", "event_id", "1 hour", where=F.col("event_type") == "view", once=True
        ).awaitTermination()
    return firing.EarlyVisitors(spark, folder, "bigint").firings()


def _lasting(rows):
    """The longest pause between the events of a window and who ended it."""
    times = rows.sort_values(["ts", "event_id"])
    pause = times["ts"].diff().max()
    at = times["ts"].diff().argmax() if len(times) > 1 else 0
    return times.iloc[[at]].assign(pause_us=0 if len(times) < 2 else int(pause.value // 1000))[
        ["event_type", "window_end", "pause_us", "event_id"]
    ]


@_replay(
    "longest_pauses",
    """WITH e AS (SELECT event_type, event_id, ts, time_bucket(interval 1 hour, ts) + interval 1 hour AS window_end FROM events),
        p AS (SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type, window_end ORDER BY ts, event_id)), -1)
            AS pause FROM e),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_type, window_end ORDER BY pause DESC, ts, event_id) AS place FROM p)
        SELECT event_type, window_end, greatest(pause, 0) AS pause_us, event_id FROM r WHERE place = 1""",
)
def longest_pauses(events):
    """A function of one's own over all rows of a window."""
    rows = events.select("event_type", "event_id", "ts")
    schema = "event_type string, window_end timestamp, pause_us bigint, event_id bigint"
    return firing.window_rows(rows, ["event_type"], "ts", "1 hour", _lasting, schema)


@_replay("login_pair", "login_pair")
def login_pair(events):
    failed = F.col("event_type") == "error"
    return rules.consecutive_pairs(events, "user_id", "ts", "event_id", failed, "6 hours")


@_replay("login_times3", "login_times3")
def login_times3(events):
    failed = F.col("event_type") == "error"
    return rules.repeated_failures(events, "user_id", "ts", "event_id", failed, 3, "24 hours")


@_replay("login_strict3", "login_strict3")
def login_strict3(events):
    failed = F.col("event_type") == "error"
    return rules.repeated_failures(events, "user_id", "ts", "event_id", failed, 3, "24 hours", strict=True)


@_replay("login_anchored", "login_anchored")
def login_anchored(events):
    failed = F.col("event_type") == "error"
    return rules.anchored_groups(events, "user_id", "ts", "event_id", failed, 2, "24 hours")


@_replay("order_followed_by", "order_followed_by")
def order_followed_by(events):
    create, pay = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    return rules.followed_by(tables.order_events(events), "order_id", "ts", "event_id", create, pay, "24 hours")


@register("stream_order_lifecycle", CATALOG["order_lifecycle"].sql)
def order_lifecycle(spark, sf_dir):
    """Per order and day, with the default hold: the newest version of each order."""
    folder, keys = sinks.shared_folder(spark, "order_lifecycle"), ["order_id", "day"]
    create, pay = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    orders = tables.order_events(event_stream(spark, sf_dir, folder)).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    states = replayed(spark, folder, rules.life_cycle(orders, keys, "ts", "event_id", create, pay, "4 hours"))
    return sinks.newest_rows(states, keys, "version")


@register("stream_shipment_lifecycle", CATALOG["shipment_lifecycle"].sql)
def shipment_lifecycle(spark, sf_dir):
    """Orders and their shipments as one stream; shipments come up to months after the limit."""
    folder = sinks.shared_folder(spark, "shipment_lifecycle")
    batch = tables.order_and_shipments(spark, sf_dir)
    creates, ships = (
        _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/{name}.parquet").schema, name)
        for name in ("orders", "lineitem")
    )
    streams.flush_row(batch, _END, order_id=-1, event_type="flush", event_id=0).write.mode("overwrite").parquet(
        f"{folder}/flush"
    )
    rows = creates.select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("create").alias("event_type"),
        F.lit(0).alias("event_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    ).unionByName(
        ships.select(
            F.col("l_orderkey").alias("order_id"),
            F.lit("pay").alias("event_type"),
            F.lit(1).alias("event_id"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
        )
    )
    rows = rows.unionByName(spark.readStream.schema(batch.schema).parquet(f"{folder}/flush"))
    create, pay = F.col("event_type") == "create", F.col("event_type") == "pay"
    # The tables are in order of keys, not of time, and the halves of an order may be years apart: the watermark trails by more
    # than their whole span, and orders are remembered as long.
    states = rules.life_cycle(
        streams.watermarked(rows, "4000 days"), ("order_id",), "ts", "event_id", create, pay, "60 days", remember="4000 days"
    )
    return sinks.newest_rows(replayed(spark, folder, states), ["order_id"], "version")


@_replay("pay_reconcile_once", "pay_reconcile_once")
def pay_reconcile_once(events):
    # One stream with both sides, so that one watermark covers them.
    kind = F.when(F.col("event_type") == "click", rules.FIRST).when(F.col("event_type") == "purchase", rules.SECOND)
    sided = events.withColumn("tx_id", F.col("user_id").cast("string")).withColumn("side", kind)
    sided = filter_rows(sided, F.col("side").isNotNull(), "ts")
    found = rules.reconcile_sided(sided, "tx_id", "ts", "event_id", "side", "5 hours")
    return found.select("tx_id", F.col("left_seq").alias("pay_id"), F.col("right_seq").alias("receipt_id"), "channel")


def _sides(spark, sf_dir, folder):
    """Two streams over the same table; each gets a flush row of its own kind."""
    pays = tables.pays(event_stream(spark, sf_dir, f"{folder}/pays", event_type="click"))
    receipts = tables.receipts(event_stream(spark, sf_dir, f"{folder}/receipts", event_type="purchase", user_id=-2))
    return pays, receipts


@register("stream_pay_interval_join", CATALOG["pay_interval_join"].sql)
def pay_interval_join(spark, sf_dir):
    folder = sinks.shared_folder(spark, "pay_interval_join")
    joined = jobs.pay_receipt_join(*_sides(spark, sf_dir, folder), "-3 hours", "5 hours")
    return replayed(spark, folder, _flat_pairs(joined))


@register("stream_pay_reconcile", CATALOG["pay_reconcile"].sql)
def pay_reconcile(spark, sf_dir):
    folder = sinks.shared_folder(spark, "pay_reconcile")
    matched = jobs.pay_receipt_pairs(*_sides(spark, sf_dir, folder), "5 hours")
    return replayed(spark, folder, _flat_pairs(matched))


def _single(name: str, column: str, channel: str):
    @register(f"stream_{name}", CATALOG[name].sql)
    def run(spark, sf_dir):
        folder = sinks.shared_folder(spark, name)
        matched = jobs.pay_receipt_pairs(*_sides(spark, sf_dir, folder), "5 hours")
        return replayed(spark, folder, matched.filter(F.col("channel") == channel).select(f"{column}.*"))

    return run


single_pay = _single("single_pay", "pay", matching.SINGLE_LEFT)
single_receipt = _single("single_receipt", "receipt", matching.SINGLE_RIGHT)


@register("stream_pay_with_receipt", CATALOG["pay_with_receipt"].sql)
def pay_with_receipt(spark, sf_dir):
    folder = sinks.shared_folder(spark, "pay_with_receipt")
    pays, receipts = _sides(spark, sf_dir, folder)
    other = receipts.select(F.col("tx_id").alias("_tx"), F.col("ts").alias("_ts"))
    near = F.expr("tx_id = _tx AND _ts >= ts - INTERVAL 5 HOURS AND _ts <= ts + INTERVAL 5 HOURS")
    return replayed(spark, folder, pays.join(other, near, "left_semi"))


@register("stream_hot_items", CATALOG["hot_items_topn"].sql)
def hot_items(spark, sf_dir):
    folder = sinks.shared_folder(spark, "hot_items")
    behaviors = tables.behaviors(event_stream(spark, sf_dir, folder))
    with _replay_settings(spark):
        streams.hot_items(behaviors, f"{folder}/out", f"{folder}/checkpoint", once=True, view="view").awaitTermination()
    ranked = CATALOG["hot_items_topn"].run(spark, sf_dir).schema
    return sinks.read_log(spark, f"{folder}/out", ranked).drop(sinks.BATCH)


@register("stream_top_pages", CATALOG["top_pages"].sql)
def top_pages(spark, sf_dir):
    """Rankings with corrections: the newest version of each window."""
    folder = sinks.shared_folder(spark, "top_pages")
    log = tables.web_log(event_stream(spark, sf_dir, folder, delay="2 minutes"))
    with _replay_settings(spark):
        query = streams.top_pages(
            log, f"{folder}/counts", f"{folder}/out", f"{folder}/checkpoint", once=True, slide="1 minute"
        )
        query.awaitTermination()
    return sinks.newest_groups(sinks.read_log(spark, f"{folder}/out"), ["window_end"])


def _ranked_pages(spark, folder: str, log: DataFrame, **settings) -> rankings.RankedWindows:
    with _replay_settings(spark):
        query = rankings.ranked_windows(
            log, folder, f"{folder}/checkpoint", ["url"], jobs.HOT_PAGES, where=F.col("method") == "GET", once=True, **settings
        )
        query.awaitTermination()
    return rankings.RankedWindows(spark, folder, {"url": "string"}, settings["size"], settings["slide"])


@register("stream_top_pages_fine", CATALOG["top_pages_fine"].sql)
def top_pages_fine(spark, sf_dir):
    """Ten minutes every five seconds, corrected by every batch."""
    folder = sinks.shared_folder(spark, "top_pages_fine")
    rows = _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema, per_batch=1)
    log = tables.web_log(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    return _ranked_pages(spark, folder, log, size=jobs.PAGE_SIZE, slide=jobs.PAGE_SLIDE).ranks()


@register(
    "stream_top_pages_and_late",
    f"""SELECT 'ranked' AS kind, url, window_end AS at, cnt, row_num, NULL::bigint AS event_id
        FROM ({CATALOG["top_pages_in_arrival_order"].sql})
        UNION ALL SELECT 'late', url, ts, NULL, NULL, event_id FROM ({CATALOG["late_requests"].sql})""",
)
def top_pages_and_late(spark, sf_dir):
    """One job: rankings with corrections, and the requests that came too late for all of their windows."""
    folder = sinks.shared_folder(spark, "top_pages_and_late")
    rows = _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    log = tables.disordered_web_log(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    late = {"size": "10 minutes", "slide": "5 minutes", "delay": "1 hour", "allowed": "1 hour", "tie": ["event_id"]}
    found = _ranked_pages(spark, folder, log, seq="seq", **late)
    none = {"event_id": F.lit(None).cast("bigint")}
    ranked = found.ranks().select(F.lit("ranked").alias("kind"), "url", F.col("window_end").alias("at"), "cnt", "row_num")
    rest = found.side_rows().select(F.lit("late").alias("kind"), "url", F.col("ts").alias("at"), "event_id")
    return ranked.withColumns(none).unionByName(rest, allowMissingColumns=True)


@register("stream_late_split", CATALOG["late_split"].sql)
def late_split(spark, sf_dir):
    folder = sinks.shared_folder(spark, "late_split")
    rows = _table_stream(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    log = tables.disordered_web_log(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    streams.late_split(
        log,
        folder,
        f"{folder}/checkpoint",
        "seq",
        size="10 minutes",
        slide="5 minutes",
        delay="1 hour",
        allowed="1 hour",
        tie=["event_id"],
        once=True,
    ).awaitTermination()
    split = sinks.read_log(spark, f"{folder}/rows")
    return split.filter(F.col("method") == "GET").select("event_id", "ts", "url", "channel")
