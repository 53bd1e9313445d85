"""Operators against plain-Python definitions on random inputs with ties, bursts and hot keys."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyward.operators import anchored, click_cap, failures, lateness, matching, orders, topn, windows


def failed():
    return F.col("kind") == "fail"


# keys, events, time span in seconds, share of the first kind, share of rows on the hot key
SHAPES = [
    (4, 600, 300, 0.5, 0.4),
    (3, 800, 5000, 0.9, 0.6),
    (1, 900, 400, 1.0, 1.0),
    (1, 700, 20000, 0.98, 1.0),
    (150, 700, 100, 0.7, 0.3),
]


def random_events(shape, kinds, seed):
    keys, count, span, share, hot = shape
    rnd = random.Random(seed)
    return [
        (
            0 if rnd.random() < hot else rnd.randrange(keys),
            rnd.randrange(span),
            seq,
            kinds[0] if rnd.random() < share else rnd.choice(kinds[1:]),
        )
        for seq in range(count)
    ]


def frame(spark, events):
    return (
        spark.createDataFrame(events, "key bigint, t bigint, seq bigint, kind string")
        .withColumn("ts", F.timestamp_seconds("t"))
        .repartition(5, "seq")
    )


def warned(df):
    rows = df.select("key", F.unix_seconds("first_fail_ts"), F.unix_seconds("last_fail_ts")).collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("within", [3, 40])
def test_failure_rules(spark, shape, within):
    events = random_events(shape, ["fail", "success"], within)
    df, span = frame(spark, events), f"{within} seconds"
    assert warned(failures.consecutive_pairs(df, "key", "ts", ["seq"], failed(), span)) == brute.pairs(events, within)
    assert warned(failures.relaxed_times(df, "key", "ts", ["seq"], failed(), 3, span)) == brute.relaxed(events, 3, within)
    assert warned(failures.strict_times(df, "key", "ts", ["seq"], failed(), 3, span)) == brute.strict(events, 3, within)


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("within, times", [(20, 2), (45, 3), (25, 1)])
def test_anchored_groups(spark, shape, within, times):
    events = random_events(shape, ["fail", "success"], within)
    found = anchored.anchored_groups(frame(spark, events), "key", "ts", ["seq"], failed(), times, f"{within} seconds")
    assert warned(found) == brute.anchored(events, times, within)


@pytest.mark.parametrize("block_slots", [1, 2, 7])
@pytest.mark.parametrize("shape", [SHAPES[1], SHAPES[2]])
def test_anchored_groups_over_block_edges(spark, monkeypatch, shape, block_slots):
    """Slots of one reach and blocks of a few slots: chains run over many edges of both."""
    monkeypatch.setattr(anchored, "slot_width", lambda reach: reach)
    events = random_events(shape, ["fail", "success"], block_slots)
    args = ("key", "ts", ["seq"], failed())
    found = anchored.anchored_groups(frame(spark, events), *args, 2, "20 seconds", block_slots=block_slots)
    assert warned(found) == brute.anchored(events, 2, 20)


def test_block_summaries_do_not_grow_with_a_slot(spark):
    """Ten times the failures of a hot key, at random times: the walk over blocks sees hardly more rows."""
    walked = []
    for step in (10, 1):
        rows = spark.range(0, 60_000, step).select(
            F.lit(0).alias("key"),
            F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(18_000_000)) / 1000).alias("ts"),
            F.col("id").alias("seq"),
            F.lit(True).alias("failed"),
        )
        span, width = 5_000_000, anchored.slot_width(5_000_000)
        marked = anchored._marked_failures(rows, "key", "ts", ["seq"], F.col("failed"), 2, span)
        slots = anchored.with_slots(marked, "_us", ahead=span, width=width)
        held = slots.repartition("key", "_slot").sortWithinPartitions("key", "_slot", "_us", "seq")
        edges = held.select("key", "_slot", "_us", "seq", "_own", "_sure").mapInPandas(
            lambda it: anchored._edge_summaries(it, "key", width, span), "key int, _slot bigint, _from bigint, _to bigint"
        )
        blocked = edges.withColumn("_block", F.col("_slot") - F.pmod(F.col("_slot"), F.lit(width * 64)))
        composed = blocked.repartition("key", "_block").sortWithinPartitions("key", "_block", "_slot", F.asc_nulls_first("_from"))
        columns = "key int, _block bigint, _first_slot bigint, _last_slot bigint, _from bigint, _to bigint"
        walked.append(composed.mapInPandas(lambda it: anchored._composed(it, "key", width, span), columns).count())
    assert walked[1] < 3 * walked[0]


def test_anchored_groups_over_batch_edges(spark):
    """Key and slot groups that are cut by Arrow batches."""
    events = random_events((2, 1200, 900, 0.97, 0.7), ["fail", "success"], 1)
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get(
        "spark.sql.execution.arrow.maxRecordsPerBatch"
    )
    spark.conf.set(key, "7")
    try:
        found = anchored.anchored_groups(frame(spark, events), "key", "ts", ["seq"], failed(), 2, "16 seconds")
        assert warned(found) == brute.anchored(events, 2, 16)
    finally:
        spark.conf.set(key, before)


def test_anchored_groups_with_text_keys(spark):
    events = random_events(SHAPES[0], ["fail", "success"], 9)
    df = frame(spark, events).withColumn("key", F.concat(F.lit("u"), F.col("key").cast("string")))
    found = anchored.anchored_groups(df, "key", "ts", ["seq"], failed(), 2, "20 seconds")
    assert warned(found) == sorted((f"u{k}", a, b) for k, a, b in brute.anchored(events, 2, 20))


def test_failure_limits(spark):
    """Exactly at the limit: inside for the pair rule and the timer, outside for the patterns."""
    events = [(1, 100, 0, "fail"), (1, 102, 1, "fail"), (1, 105, 2, "fail")]
    df = frame(spark, events)
    assert warned(failures.consecutive_pairs(df, "key", "ts", ["seq"], failed(), "2 seconds")) == [(1, 100, 102)]
    assert warned(failures.relaxed_times(df, "key", "ts", ["seq"], failed(), 3, "5 seconds")) == []
    assert warned(failures.relaxed_times(df, "key", "ts", ["seq"], failed(), 3, "6 seconds")) == [(1, 100, 105)]
    assert warned(anchored.anchored_groups(df, "key", "ts", ["seq"], failed(), 3, "5 seconds")) == [(1, 100, 105)]


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("within", [20, 300])
def test_followed_by(spark, shape, within):
    events = random_events(shape, ["create", "pay", "other"], within)
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    found = orders.followed_by(frame(spark, events), "key", "ts", ["seq"], create, pay, f"{within} seconds")
    rows = found.select("key", F.unix_seconds("create_ts"), F.unix_seconds("pay_ts"), "channel").collect()
    assert sorted(map(tuple, rows), key=str) == brute.followed_by(events, within)


def test_order_limits(spark):
    """Exactly at the limit is too late; pay before create is in time."""
    events = [(1, 0, 0, "create"), (1, 900, 1, "pay"), (2, 50, 2, "pay"), (2, 60, 3, "create"), (3, 5, 4, "pay")]
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    df = frame(spark, [*events, (4, 7, 5, "create")])
    found = orders.life_cycle(df, ["key"], "ts", create, pay).select("key", "channel", "result_msg").collect()
    assert {r.key: (r.channel, r.result_msg) for r in found} == {
        1: ("payed-but-timeout", "payed-but-timeout"),
        2: ("payed", "payed successfully"),
        3: ("data not found", "payed not find created"),
        4: ("timeout", "timeout"),
    }
    steps = orders.followed_by(df, "key", "ts", ["seq"], create, pay).select("key", "channel").collect()
    assert sorted(map(tuple, steps)) == [(1, "timeout"), (2, "timeout"), (4, "timeout")]


@pytest.mark.parametrize(
    "shape, size, slide",
    [
        (SHAPES[0], 60, 60),
        (SHAPES[1], 60, 20),
        (SHAPES[2], 60, 7),
        (SHAPES[3], 3600, 5),
        (SHAPES[4], 10, 25),
        (SHAPES[3], 60, 7),
    ],
)
def test_window_counts(spark, shape, size, slide):
    events = random_events(shape, ["a"], size) if shape[3] == 1.0 else random_events(shape, ["a", "b"], size)
    counted = windows.windowed_counts(frame(spark, events), ["key"], "ts", f"{size} seconds", f"{slide} seconds")
    rows = counted.select("key", F.unix_seconds("window_end"), "cnt", F.unix_seconds("window_start")).collect()
    expected = brute.window_counts(events, size, slide)
    assert len(rows) == len(expected)
    assert {(k, end): cnt for k, end, cnt, _ in rows} == expected
    assert all(end - start == size for _, end, _, start in rows)
    ranked = topn.top_n(counted, 2, ["key"])
    found = ranked.select(F.unix_seconds("window_end"), "row_num", "key", "cnt").collect()
    assert set(map(tuple, found)) == brute.top_n(expected, 2)


def test_window_mass(spark):
    """Every row is counted in size / slide windows."""
    events = random_events(SHAPES[1], ["a", "b"], 3)
    total = windows.windowed_counts(frame(spark, events), [], "ts", "1 hour", "5 seconds").agg(F.sum("cnt")).head()[0]
    assert total == len(events) * 720


def test_window_edges(spark):
    events = [(1, 0, 0, "a"), (1, 59, 1, "a"), (1, 60, 2, "a")]
    counted = windows.windowed_counts(frame(spark, events), ["key"], "ts", "1 minute").select(
        F.unix_seconds("window_end"), "cnt"
    )
    assert sorted(map(tuple, counted.collect())) == [(60, 2), (120, 1)]


def test_window_plateaus(spark):
    events = random_events(SHAPES[1], ["a", "b"], 4)
    runs = windows.window_plateaus(frame(spark, events), ["key"], "ts", "60 seconds", "5 seconds")
    found = {}
    for row in runs.select("key", F.unix_seconds("first_end"), F.unix_seconds("last_end"), "windows", "cnt").collect():
        key, first, last, count, cnt = row
        ends = range(first, last + 1, 5)
        assert len(ends) == count and not any((key, end) in found for end in ends)
        found.update({(key, end): cnt for end in ends})
    assert found == brute.window_counts(events, 60, 5)


def test_windowed_aggregates(spark):
    """Any aggregate per window; counts agree with the counting operator."""
    df = frame(spark, random_events(SHAPES[0], ["a", "b"], 5))
    args = (["key"], "ts", "60 seconds", "20 seconds")
    found = windows.windowed_aggregates(df, *args, cnt=F.count("*"), kinds=F.count_distinct("kind"))
    counted = windows.windowed_counts(df, *args)
    columns = ["key", "window_start", "window_end", "cnt"]
    assert sorted(found.select(columns).collect()) == sorted(counted.select(columns).collect())
    assert found.agg(F.max("kinds")).head()[0] == 2


def test_salted_counts(spark):
    df = frame(spark, random_events(SHAPES[1], ["a", "b"], 5))
    plain = windows.windowed_counts(df, [], "ts", "5 minutes", where=F.col("kind") == "a").select("window_end", "cnt")
    salted = windows.salted_window_counts(df, "ts", "5 minutes", ["seq"], 3, F.col("kind") == "a")
    assert sorted(plain.collect()) == sorted(salted.select("window_end", "cnt").collect())


@pytest.mark.parametrize("parts", [1, 3])
def test_click_cap(spark, parts):
    events = [(k, t * 400, seq, kind) for k, t, seq, kind in random_events(SHAPES[0], ["a", "b"], 7)]
    # The business day starts at 16:00 UTC.
    expected = brute.cap(events, 5, lambda t: (t + 8 * 3600) // 86400)
    capped = click_cap.click_cap(frame(spark, events), ["key"], "ts", ["seq"], 5, parts=parts)
    assert sorted(map(tuple, capped.select("seq", "channel").collect())) == expected
    assert click_cap.passed(capped).columns == ["key", "t", "seq", "kind", "ts"]


@pytest.mark.parametrize(
    "shape, low, high",
    [(SHAPES[0], -3, 5), (SHAPES[1], 0, 30), (SHAPES[2], 4, 9), (SHAPES[3], 0, 30), (SHAPES[4], 0, 0)],
)
def test_interval_join(spark, shape, low, high):
    left, right = random_events(shape, ["a", "b"], 1), random_events(shape, ["a", "b"], 2)
    joined = matching.interval_join(
        frame(spark, left), frame(spark, right), "key", "ts", "ts", f"{low} seconds", f"{high} seconds"
    )
    rows = joined.select("pay.seq", "receipt.seq").collect()
    assert sorted(map(tuple, rows)) == brute.interval_pairs(left, right, low, high)


@pytest.mark.parametrize(
    "shape, within", [(SHAPES[0], 2), (SHAPES[1], 20), (SHAPES[2], 2), (SHAPES[2], 0), (SHAPES[3], 60), (SHAPES[4], 20)]
)
def test_reconcile(spark, shape, within):
    left, right = random_events(shape, ["a", "b"], 3), random_events(shape, ["a", "b"], 4)
    one, two, span = frame(spark, left), frame(spark, right), f"{within} seconds"
    once = matching.reconcile(one, two, "key", "ts", "ts", "seq", "seq", span)
    rows = once.select("pay.seq", "receipt.seq", "channel").collect()
    assert sorted([tuple(r)[:2] for r in rows], key=str) == brute.reconcile(left, right, within)
    assert all((r[2] == "matched") == (None not in tuple(r)[:2]) for r in rows)

    near = brute.interval_pairs(left, right, -within, within)
    with_left, with_right = {a for a, _ in near}, {b for _, b in near}
    args = (one, two, "key", "ts", "ts", span)
    assert sorted(r.seq for r in matching.left_with_partner(*args).collect()) == sorted(with_left)
    no_right = sorted({e[2] for e in left} - with_left)
    no_left = sorted({e[2] for e in right} - with_right)
    assert sorted(r.seq for r in matching.left_without_partner(*args).collect()) == no_right
    assert sorted(r.seq for r in matching.right_without_partner(*args).collect()) == no_left
    channels = matching.reconcile_pairs(*args).groupBy("channel").count().collect()
    expected = {"matched": len(near), "single-pay": len(no_right), "single-receipt": len(no_left)}
    assert {r.channel: r["count"] for r in channels} == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("bits", [3, 20])
@pytest.mark.parametrize("size, slide, delay, allowed", [(60, 20, 10, 10), (60, 60, 0, 0), (50, 15, 30, 7)])
def test_lateness(spark, bits, size, slide, delay, allowed):
    rnd = random.Random(size)
    events = [(rnd.randrange(3), max(0, seq * 3 - rnd.randrange(150)), seq, "a") for seq in range(500)]
    spans = [f"{x} seconds" for x in (size, slide, delay, allowed)]
    marked = lateness.with_lateness(frame(spark, events), "ts", "seq", *spans, bits=bits)
    expected = brute.lateness(events, size, slide, delay, allowed)
    late = sorted(seq for seq, ends in expected.items() if not ends)
    assert late
    assert sorted(r.seq for r in lateness.late_rows(marked).collect()) == late
    counts = lateness.on_time_counts(marked, ["key"], spans[0], spans[1])
    wanted = {}
    for key, _, seq, _ in events:
        for end in expected[seq]:
            wanted[(key, end)] = wanted.get((key, end), 0) + 1
    rows = counts.select("key", F.unix_seconds("window_end"), "cnt").collect()
    assert {(k, e): c for k, e, c in rows} == wanted


def test_report_texts(spark):
    ranked = spark.createDataFrame(
        [(7, 3, 1, 60), (9, 2, 2, 60)], "item_id bigint, cnt bigint, row_num int, t bigint"
    ).withColumn("window_end", F.timestamp_seconds("t"))
    report = topn.ranking_report(ranked, "item_id", topn.ITEM_REPORT).head().report
    assert report == (
        "窗口结束时间：1970-01-01 00:01:00.0\n"
        "NO.1: \t 商品ID = 7\t 热门度 = 3\n"
        "NO.2: \t 商品ID = 9\t 热门度 = 2\n"
        "\n ================================= \n\n"
    )
