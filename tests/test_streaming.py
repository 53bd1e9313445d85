"""Streams over several micro-batches against the plain-Python definitions."""

import os
import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyward.operators import matching, topn, visitors, windows
from tallyward.streaming import clicks, rules, sinks
from tallyward.streaming import jobs as streams

DISORDER = 20
COLUMNS = "key bigint, t bigint, seq bigint, kind string"


@pytest.fixture(autouse=True)
def two_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def arrivals(kinds, seed, count=240, keys=4, share=0.6):
    """Events in arrival order, at most ``DISORDER`` seconds behind the latest one."""
    rnd = random.Random(seed)
    times = sorted((seq * 3 + rnd.randrange(DISORDER), seq * 3 + 0) for seq in range(count))
    return [
        (rnd.randrange(keys), t, seq, kinds[0] if rnd.random() < share else rnd.choice(kinds[1:]))
        for seq, t in enumerate(start + rnd.randrange(DISORDER // 2) for _, start in times)
    ]


class Replay:
    """Writes events as files that a stream reads one by one, then a flush row."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.files = 0

    def add(self, events):
        df = self.spark.createDataFrame(events, COLUMNS).withColumn("ts", F.timestamp_seconds("t"))
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        self._stamp()
        return self

    def _stamp(self):
        # The file source goes by modification time: make it follow the arrival order.
        path = f"{self.folder}/in"
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 2_000:
                self.files += 1
                os.utime(full, (self.files, self.files))

    def load(self, events, parts=3, flush=True, kind="flush"):
        step = -(-len(events) // parts)
        for i in range(0, len(events), step):
            self.add(events[i : i + step])
        if flush:
            self.add([(-1, 10**9, 10**9, kind)])
        return self

    def stream(self, delay=f"{DISORDER} seconds"):
        source = self.spark.readStream.schema(f"{COLUMNS}, ts timestamp").option("maxFilesPerTrigger", 1)
        return streams.watermarked(source.parquet(f"{self.folder}/in"), delay)

    def run(self, result, mode="append"):
        out, checkpoint = f"{self.folder}/out", f"{self.folder}/checkpoint"
        streams.run(result, sinks.log_writer(out), checkpoint, mode, once=True).awaitTermination()
        return sinks.read_log(self.spark, out)


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, str(tmp_path))


def failed():
    return F.col("kind") == "fail"


def warned(df):
    rows = df.select("key", F.unix_seconds("first_fail_ts"), F.unix_seconds("last_fail_ts")).collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("rule", ["pair", "relaxed", "strict", "anchored"])
def test_failure_rules(replay, rule):
    events = arrivals(["fail", "success"], 1, share=0.8)
    stream, args = replay.load(events).stream(), ("key", "ts", "seq", failed())
    if rule == "pair":
        found, expected = rules.consecutive_pairs(stream, *args, "9 seconds"), brute.pairs(events, 9)
    elif rule == "relaxed":
        found, expected = rules.repeated_failures(stream, *args, 3, "30 seconds"), brute.relaxed(events, 3, 30)
    elif rule == "strict":
        found = rules.repeated_failures(stream, *args, 3, "60 seconds", strict=True)
        expected = brute.strict(events, 3, 60)
    else:
        found, expected = rules.anchored_groups(stream, *args, 2, "25 seconds"), brute.anchored(events, 2, 25)
    assert expected
    assert warned(replay.run(found)) == expected


def test_followed_by(replay):
    events = arrivals(["create", "pay", "other"], 2, share=0.4)
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    found = replay.run(rules.followed_by(replay.load(events).stream(), "key", "ts", "seq", create, pay, "30 seconds"))
    rows = found.select("key", F.unix_seconds("create_ts"), F.unix_seconds("pay_ts"), "channel").collect()
    assert sorted(map(tuple, rows), key=str) == brute.followed_by(events, 30)


def test_life_cycle(replay):
    events = [(1, 0, 0, "create"), (2, 50, 1, "pay"), (3, 51, 2, "pay"), (2, 60, 3, "create"), (4, 61, 4, "create")]
    events += [(5, 62, 5, "create"), (5, 900, 6, "pay"), (1, 901, 7, "pay")]
    events = [(key, t + 1000, seq, kind) for key, t, seq, kind in events]
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    found = replay.run(rules.life_cycle(replay.load(events).stream(), ["key"], "ts", "seq", create, pay))
    found = sinks.newest_rows(found, ["key"], "version")
    assert {r.key: r.channel for r in found.collect()} == {
        1: "payed-but-timeout",
        2: "payed",
        3: "data not found",
        4: "timeout",
        5: "payed",
    }


def test_reconcile_once(replay):
    events = arrivals(["pay", "receipt"], 3, keys=6, share=0.5)
    kind = F.when(F.col("kind") == "pay", rules.FIRST).when(F.col("kind") == "receipt", rules.SECOND)
    sided = replay.load(events, kind="pay").stream()
    found = replay.run(rules.apply_rule(sided, ("key",), "ts", "seq", kind, rules.ReconcileRule(6_000_000)))
    rows = found.filter("key >= 0").select("left_seq", "right_seq", "channel").collect()
    left = [e for e in events if e[3] == "pay"]
    right = [e for e in events if e[3] == "receipt"]
    assert sorted([tuple(r)[:2] for r in rows], key=str) == brute.reconcile(left, right, 6)
    assert {r.channel for r in rows} == {"matched", "single-pay", "single-receipt"}


def test_two_stream_joins(spark, tmp_path):
    left, right = arrivals(["a"], 4, keys=9, share=1), arrivals(["a"], 5, keys=9, share=1)

    def sides(name):
        one = Replay(spark, str(tmp_path / f"{name}-one")).load(left).stream()
        two = Replay(spark, str(tmp_path / f"{name}-two")).load(right).stream()
        # The two flush rows must not find each other.
        return one, two.withColumn("key", F.when(F.col("key") < 0, -2).otherwise(F.col("key")))

    out = Replay(spark, str(tmp_path / "join"))
    joined = matching.interval_join(*sides("join"), "key", "ts", "ts", "-3 seconds", "5 seconds")
    pairs = out.run(joined.select("pay.seq", F.col("receipt.seq").alias("other"))).select("seq", "other")
    assert sorted(map(tuple, pairs.collect())) == brute.interval_pairs(left, right, -3, 5)

    out = Replay(spark, str(tmp_path / "outer"))
    result = out.run(matching.reconcile_pairs(*sides("outer"), "key", "ts", "ts", "5 seconds"))
    near = brute.interval_pairs(left, right, -5, 5)
    counted = result.filter("coalesce(pay.key, receipt.key) >= 0").groupBy("channel").count().collect()
    assert {r.channel: r["count"] for r in counted} == {
        "matched": len(near),
        "single-pay": len({e[2] for e in left} - {a for a, _ in near}),
        "single-receipt": len({e[2] for e in right} - {b for _, b in near}),
    }


def test_windowed_counts_and_flush(replay):
    """Rows that fail the predicate still move time on; the tail needs the flush row."""
    events = arrivals(["a", "b"], 6, share=0.3)
    counted = windows.windowed_counts(
        replay.load(events).stream(), ["key"], "ts", "60 seconds", "20 seconds", F.col("kind") == "a"
    )
    rows = replay.run(counted).select("key", F.unix_seconds("window_end"), "cnt").collect()
    assert {(k, e): c for k, e, c in rows} == brute.window_counts([e for e in events if e[3] == "a"], 60, 20)


def test_without_flush_the_tail_is_open(replay):
    events = arrivals(["a", "b"], 6)
    stream = replay.load(events, flush=False).stream()
    rows = replay.run(windows.windowed_counts(stream, [], "ts", "60 seconds")).collect()
    expected = brute.window_counts([(0, *e[1:]) for e in events], 60, 60)
    assert 0 < len(rows) < len(expected)


@pytest.mark.parametrize("form", ["plain", "salted", "visitors", "sightings"])
def test_hourly_counts(replay, form):
    events = arrivals(["a", "b"], 7, keys=30)
    mine = [e for e in events if e[3] == "a"]
    where = F.col("kind") == "a"
    stream = replay.load(events).stream()
    if form == "plain":
        found = windows.windowed_counts(stream, [], "ts", "60 seconds", where=where).select("window_end", "cnt")
    elif form == "salted":
        found = windows.salted_window_counts(stream, "ts", "60 seconds", ["seq"], 3, where)
    elif form == "visitors":
        found = visitors.unique_visitors(stream, "key", "ts", "60 seconds", where)
    else:
        found = visitors.first_sightings(stream, "key", "ts", "60 seconds", where)
    log = replay.run(found)
    seen = {(key, end): 1 for key, end in brute.window_counts(mine, 60, 60)}
    if form == "sightings":
        assert sorted(map(tuple, log.select("key", F.unix_seconds("window_end")).collect())) == sorted(seen)
        return
    expected = {}
    source = seen if form == "visitors" else brute.window_counts(mine, 60, 60)
    for (_, end), cnt in source.items():
        expected[end] = expected.get(end, 0) + cnt
    assert {e: c for e, c in log.select(F.unix_seconds("window_end"), "cnt").collect()} == expected


def test_final_ranking(replay, spark):
    events = arrivals(["pv", "buy"], 8, keys=12)
    stream = replay.load(events).stream()
    behaviors = stream.select(F.col("key").alias("item_id"), F.col("kind").alias("behavior"), "ts")
    out = f"{replay.folder}/out"
    settings = {"n": 2, "size": "60 seconds", "slide": "20 seconds", "once": True}
    streams.hot_items(behaviors, out, f"{replay.folder}/checkpoint", **settings).awaitTermination()
    log = sinks.read_log(spark, out).select(F.unix_seconds("window_end"), "row_num", "item_id", "cnt")
    counts = brute.window_counts([e for e in events if e[3] == "pv"], 60, 20)
    assert set(map(tuple, log.collect())) == brute.top_n(counts, 2)


def test_ranking_with_corrections(replay, spark):
    events = arrivals(["GET", "POST"], 9, keys=12)
    log = replay.load(events).stream().select(F.col("key").alias("url"), F.col("kind").alias("method"), "ts")
    counts, ranks = f"{replay.folder}/counts", f"{replay.folder}/ranks"
    settings = {"n": 2, "size": "60 seconds", "slide": "20 seconds", "once": True}
    streams.top_pages(log, counts, ranks, f"{replay.folder}/checkpoint", **settings).awaitTermination()
    written = sinks.read_log(spark, ranks)
    rows = sinks.newest_groups(written, ["window_end"]).select(F.unix_seconds("window_end"), "row_num", "url", "cnt")
    expected = brute.top_n(brute.window_counts([e for e in events if e[3] == "GET"], 60, 20), 2)
    assert set(map(tuple, rows.collect())) == expected
    # Some windows were ranked more than once.
    versions = written.groupBy("window_end").agg(F.count_distinct("batch_id").alias("n"))
    assert versions.agg(F.max("n")).head()[0] > 1
    # The upserted counts are the final ones.
    stored = sinks.newest_rows(sinks.read_log(spark, counts).drop("window_day"), ["url", "window_end"])
    again = topn.top_n(stored, 2, ["url"]).select(F.unix_seconds("window_end"), "row_num", "url", "cnt")
    assert set(map(tuple, again.collect())) == expected


def test_click_cap(replay):
    events = arrivals(["a"], 10, keys=3, share=1)
    capped = clicks.click_cap(replay.load(events).stream(), ["key"], "ts", "seq", 20)
    # Windowed counts follow in the same query.
    passed = capped.filter("channel = 'passed' AND key >= 0")
    counted = windows.windowed_counts(passed, ["key"], "ts", "10 minutes")
    total = replay.run(counted).groupBy("key").agg(F.sum("cnt").alias("n")).collect()
    assert {r.key: r.n for r in total} == {0: 20, 1: 20, 2: 20}


def test_click_cap_warns_once(replay):
    events = arrivals(["a"], 10, keys=3, share=1)
    capped = replay.run(clicks.click_cap(replay.load(events).stream(), ["key"], "ts", "seq", 20))
    counted = capped.filter("key >= 0").groupBy("key", "channel").count().collect()
    assert {(r.key, r.channel): r["count"] for r in counted} == {
        (key, channel): n for key in range(3) for channel, n in (("passed", 20), ("black-list", 1))
    }


def test_late_split_matches_batch(replay, spark):
    rnd = random.Random(11)
    events = [(rnd.randrange(3), max(0, seq * 3 - rnd.randrange(150)), seq, "a") for seq in range(400)]
    source = replay.load(events, parts=5, flush=False).stream()
    settings = dict(size="60 seconds", slide="20 seconds", delay="10 seconds", allowed="10 seconds", once=True)
    streams.late_split(source, replay.folder, f"{replay.folder}/checkpoint", "seq", **settings).awaitTermination()
    split = sinks.read_log(spark, f"{replay.folder}/rows")
    assert split.select("batch_id").distinct().count() == 5
    late = sorted(r.seq for r in split.filter("channel = 'late'").collect())
    assert late == sorted(seq for seq, ends in brute.lateness(events, 60, 20, 10, 10).items() if not ends)
    assert split.count() == len(events)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """What happens after a failure between the write and the commit of a batch."""
    path = str(tmp_path / "log")
    write = sinks.channel_writer(path)
    batch = spark.createDataFrame([(1, "main"), (2, "side")], "id bigint, channel string")
    for _ in range(2):
        write(batch, 7)
    assert sorted(map(tuple, sinks.read_log(spark, path).select("id", "channel", "batch_id").collect())) == [
        (1, "main", 7),
        (2, "side", 7),
    ]
    empty = sinks.read_log(spark, str(tmp_path / "nothing"), batch.schema)
    assert empty.columns == ["id", "channel", "batch_id"] and empty.count() == 0


class Settings:
    """Stands in for a session with the given settings."""

    def __init__(self, spark, **settings):
        self.sql, self.conf = spark.sql, self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_follows_the_session(spark, tmp_path):
    local = Settings(spark, **{"spark.sql.warehouse.dir": f"{tmp_path}/house"})
    assert sinks.shared_folder(local, "tally").startswith(f"{tmp_path}/house/_streams/tally-")
    with pytest.raises(RuntimeError):
        sinks.shared_folder(Settings(spark, **{"spark.master": "yarn"}), "tally")
    cluster = Settings(spark, **{"spark.checkpoint.dir": f"{tmp_path}/shared/"})
    folders = {sinks.shared_folder(cluster, "tally") for _ in range(2)}
    assert len(folders) == 2 and all(f.startswith(f"{tmp_path}/shared/tally-") for f in folders)


def test_equal_times_in_the_next_batch_are_kept(replay):
    replay.add([(0, 100, 0, "fail")]).add([(0, 100, 1, "fail")]).add([(-1, 10**9, 10**9, "flush")])
    stream = replay.stream(streams.IN_ORDER)
    found = rules.consecutive_pairs(stream, "key", "ts", "seq", failed(), "2 seconds")
    assert warned(replay.run(found)) == [(0, 100, 100)]


# NULL keys, NULL times and ties: every row of either side is in the result.
_LEFT = [(1, 10, 0), (None, 10, 1), (1, None, 2), (2, 30, 3), (3, 40, 5), (3, 40, 6)]
_RIGHT = [(1, 11, 0), (None, 10, 1), (2, None, 2), (4, 30, 3), (3, 40, 4)]


def _sides(spark, streaming=None):
    frames = []
    for i, rows in enumerate((_LEFT, _RIGHT)):
        df = spark.createDataFrame([(k, t, n, "a") for k, t, n in rows], COLUMNS)
        df = df.withColumn("ts", F.timestamp_seconds("t"))
        if streaming:
            path = f"{streaming}/{i}"
            df.write.parquet(path)
            flush = spark.createDataFrame([(-1 - i, 10**9, 99, "a")], COLUMNS).withColumn("ts", F.timestamp_seconds("t"))
            flush.write.mode("append").parquet(path)
            df = streams.watermarked(spark.readStream.schema(df.schema).parquet(path))
        frames.append(df)
    return frames


def _matched(found):
    rows = found.select("pay.seq", F.col("receipt.seq").alias("other"), "channel").collect()
    return sorted(((r.seq, r.other, r.channel) for r in rows if 99 not in (r.seq, r.other)), key=str)


_SINGLES = [(1, None, "single-pay"), (2, None, "single-pay"), (3, None, "single-pay")]
_SINGLES += [(None, n, "single-receipt") for n in (1, 2, 3)]


def test_pairs_account_for_every_row(spark, tmp_path):
    expected = sorted([(0, 0, "matched"), (5, 4, "matched"), (6, 4, "matched"), *_SINGLES], key=str)
    assert _matched(matching.reconcile_pairs(*_sides(spark), "key", "ts", "ts", "5 seconds")) == expected
    stream = matching.reconcile_pairs(*_sides(spark, str(tmp_path / "in")), "key", "ts", "ts", "5 seconds")
    assert _matched(Replay(spark, str(tmp_path)).run(stream)) == expected
    flagged = matching.with_partner_flag(*_sides(spark), "key", "ts", "ts", "5 seconds")
    assert flagged.count() == len(_LEFT) + len(_RIGHT)
    assert flagged.filter("has_partner").count() == 5


def test_reconcile_accounts_for_every_row_and_breaks_ties_alike(spark, tmp_path):
    # At one instant left rows come first: the second of two lefts meets the right row.
    expected = sorted([(0, 0, "matched"), (6, 4, "matched"), (5, None, "single-pay"), *_SINGLES], key=str)
    batch = matching.reconcile(*_sides(spark), "key", "ts", "ts", "seq", "seq", "5 seconds")
    assert _matched(batch) == expected
    found = rules.reconcile(*_sides(spark, str(tmp_path / "in")), "key", "ts", "seq", "5 seconds")
    rows = Replay(spark, str(tmp_path)).run(found).collect()
    got = [(r.left_seq, r.right_seq, r.channel) for r in rows if 99 not in (r.left_seq, r.right_seq)]
    assert sorted(got, key=str) == expected


def test_life_cycle_corrects_its_answer(replay, spark):
    """With the default hold; a pay 40 minutes after the create, a create after a lone pay."""
    events = [(1, 0, 0, "create"), (2, 10, 1, "pay"), (1, 2400, 2, "pay"), (3, 2500, 3, "other"), (2, 9000, 4, "create")]
    events += [(1, 20000, 5, "pay"), (4, 20001, 6, "create")]
    events = [(key, t + 1000, seq, kind) for key, t, seq, kind in events]
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    stream = replay.load(events, parts=6).stream("1 second")
    rows = replay.run(rules.life_cycle(stream, ["key"], "ts", "seq", create, pay))
    newest = {r.key: r.channel for r in sinks.newest_rows(rows, ["key"], "version").collect()}
    assert newest == {1: "payed-but-timeout", 2: "payed", 4: "timeout"}
    assert rows.groupBy("key").count().filter("count > 2").count() == 0


def test_rows_without_time_or_visitor(replay, spark):
    events = arrivals(["a"], 12, keys=5, share=1)
    stream = replay.load(events).stream()
    batch = spark.createDataFrame(events, COLUMNS).withColumn("ts", F.timestamp_seconds("t"))

    def holed(df):
        visitor = F.when(F.col("seq") % 5 == 0, None).otherwise(F.col("key")).alias("visitor")
        return df.select(visitor, "seq", F.when(F.col("seq") % 7 != 0, F.col("ts")).alias("ts"))

    late = visitors.unique_visitors(holed(batch), "visitor", "ts", "60 seconds")
    assert late.filter("window_end is null").count() == 0
    counted = windows.windowed_counts(holed(batch), [], "ts", "60 seconds")
    assert counted.filter("window_end is null").count() == 0
    known = stream.filter("seq is not null").withColumn("visitor", F.when(F.col("seq") % 5 == 0, None).otherwise(F.col("key")))
    on_stream = replay.run(visitors.unique_visitors(known, "visitor", "ts", "60 seconds"))
    alike = batch.withColumn("visitor", F.when(F.col("seq") % 5 == 0, None).otherwise(F.col("key")))
    expected = visitors.unique_visitors(alike, "visitor", "ts", "60 seconds")
    assert sorted(map(tuple, on_stream.select("window_end", "cnt").collect())) == sorted(map(tuple, expected.collect()))


def test_orders_share_the_state_of_their_bucket(spark, tmp_path):
    """Many orders are few groups of the state store; keys keep NULLs, quotes, microseconds and numbers beyond 2 ** 53."""
    keys = [(None, "a", 0), (2**62 + 1, 'say "b"', 1), (2**62 + 2, None, 2), (7, "\\ü", 3)] + [(n, "", 0) for n in range(100, 600)]
    rows = [(k, name, 1_000_000 + us, us, kind, 0) for k, name, us in keys for kind in (rules.FIRST, rules.SECOND)]
    rows = [(*r[:2], r[2] + (r[4] == rules.SECOND) * 1_000_000, r[3], r[4], i) for i, r in enumerate(rows)]
    schema = "id bigint, name string, t bigint, n bigint, kind int, seq bigint"
    late = [(-1, "", 10**15, 0, rules.OTHER, -1)]
    for place, part in enumerate((rows[: len(rows) // 2], rows[len(rows) // 2 :], late)):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={place}")
    source = spark.readStream.schema(f"{schema}, part int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    stream = streams.watermarked(source.withColumn("ts", F.timestamp_micros("t")).withColumn("day", F.timestamp_micros("n")), "1 hour")
    rule = rules.LifeCycleRule(60_000_000, 60_000_000, None)
    found = rules.apply_rule(stream, ("id", "name", "day"), "ts", "seq", F.col("kind"), rule, buckets=4)
    query = streams.run(found, sinks.log_writer(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", "append", once=True)
    query.awaitTermination()
    made = sinks.read_log(spark, f"{tmp_path}/out")
    got = [(r.id, r.name, r.n, r.channel) for r in made.withColumn("n", F.unix_micros("day")).collect()]
    assert sorted(got, key=str) == sorted([(*k, "payed") for k in keys], key=str)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) <= 40
