"""Jobs over several batches, stopped and started again: caps, early firings, whole windows, state that ends, hot keys."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streaming import COLUMNS, Replay, arrivals, failed, warned

from tallyward.operators import matching
from tallyward.streaming import clicks, firing, rules, slotted


@pytest.fixture(autouse=True)
def two_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, str(tmp_path))


def unbounded(replay):
    return replay.spark.readStream.schema(f"{COLUMNS}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{replay.folder}/in")


@pytest.mark.parametrize("stops", [False, True])
def test_disordered_logins_with_a_stop(replay, stops):
    """Rows up to 3 s late; a query that is stopped half way and started again gives the same rows."""
    rnd = random.Random(5)
    events = [(rnd.randrange(3), 1_000 + seq - rnd.randrange(3), seq, "fail" if rnd.random() < 0.7 else "success") for seq in range(300)]
    expected = brute.pairs(events, 2)

    def run():
        stream = replay.stream("3 seconds")
        return warned(replay.run(rules.consecutive_pairs(stream, "key", "ts", "seq", failed(), "2 seconds")))

    for i in range(0, 300, 60):
        replay.add(events[i : i + 60])
        if stops and i in (60, 180):
            assert len(run()) < len(expected)
    replay.add([(-1, 10**9, 10**9, "flush")])
    assert run() == expected and expected


def test_click_cap_over_batches(replay, spark):
    """A bot with most clicks; the counts go on after a stop, a second day starts anew, old days are forgotten."""
    rnd = random.Random(6)
    day = 86_400
    events = [(0 if rnd.random() < 0.8 else rnd.randrange(1, 40), 1_000 + seq * 700, seq, "a") for seq in range(400)]
    out, checkpoint = f"{replay.folder}/out", f"{replay.folder}/checkpoint"
    passed = []

    def run(keep_days=7):
        settings = {"max_clicks": 5, "zone": "UTC", "once": True, "every": 2, "keep_days": keep_days}
        also = lambda rows, n: passed.append((n, rows.count()))
        clicks.capped_clicks(unbounded(replay), out, checkpoint, ["key"], "ts", "seq", also=also, **settings).awaitTermination()

    for i in range(0, 400, 80):
        replay.add(events[i : i + 80])
        if i in (80, 240, 320):
            run()
    seen, expected = Counter(), []
    for key, t, seq, _ in events:
        seen[key, t // day] += 1
        if seen[key, t // day] <= 6:
            expected.append((seq, "passed" if seen[key, t // day] <= 5 else "black-list"))
    rows = clicks.capped_rows(spark, out)
    assert sorted((r.seq, r.channel) for r in rows.collect()) == sorted(expected)
    assert [n for n, _ in passed] == list(range(5)) and sum(n for _, n in passed) == sum(c == "passed" for _, c in expected)
    replay.add([(0, 100 * day, 1_000, "a"), (None, 100 * day, 1_001, "a"), (None, 100 * day, 1_002, "a")])
    run()
    table = clicks._seen(spark, out, {"key": "bigint"}, 2)
    assert sorted((r.key is None, r.seen) for r in table.read().collect()) == [(False, 1), (True, 2)]


def test_a_repeated_batch_of_clicks_replaces_itself(replay, spark, monkeypatch):
    """The batch fails after its tables were written and is run again."""
    events = [(0, 1_000 + seq, seq, "a") for seq in range(30)]
    replay.add(events[:10]).add(events[10:20]).add(events[20:])
    out, checkpoint = f"{replay.folder}/out", f"{replay.folder}/checkpoint"
    failures = [1]

    def also(rows, n):
        if n == 1 and failures:
            failures.pop()
            raise OSError("the batch is lost after its tables were written")

    def run():
        settings = {"max_clicks": 14, "zone": "UTC", "once": True, "also": also}
        clicks.capped_clicks(unbounded(replay), out, checkpoint, ["key"], "ts", "seq", **settings).awaitTermination()

    with pytest.raises(Exception, match="lost after"):
        run()
    run()
    rows = clicks.capped_rows(spark, out)
    assert sorted((r.seq, r.channel) for r in rows.collect()) == [(i, "passed" if i < 14 else "black-list") for i in range(15)]


@pytest.mark.parametrize("per_firing", [1, 7])
def test_early_firings(replay, spark, per_firing):
    rnd = random.Random(per_firing)
    events = [(rnd.randrange(12) if rnd.random() < 0.9 else None, 1_000 + seq, seq, "a" if seq % 5 else "b") for seq in range(240)]
    out, checkpoint = f"{replay.folder}/out", f"{replay.folder}/checkpoint"
    for i in range(0, 240, 50):
        replay.add(events[i : i + 50])
        if i in (100, 200):
            firing.early_visitors(
                unbounded(replay), out, checkpoint, "key", "ts", "seq", "60 seconds", per_firing, F.col("kind") == "a", once=True, every=2
            ).awaitTermination()
    users, rows, expected = defaultdict(set), Counter(), []
    for key, t, _, kind in events:
        if kind == "a" and key is not None:
            end = t - t % 60 + 60
            users[end].add(key)
            rows[end] += 1
            if rows[end] % per_firing == 0:
                expected.append((end, rows[end], len(users[end])))
    tables = firing.EarlyVisitors(spark, out, "bigint", 2)
    fired = tables.firings().select(F.unix_seconds("window_end"), "cnt_rows", "cnt").collect()
    assert sorted(map(tuple, fired)) == sorted(expected)
    totals = tables.totals().select(F.unix_seconds("window_end"), "cnt_rows", "cnt").collect()
    assert sorted(map(tuple, totals)) == sorted((end, rows[end], len(users[end])) for end in rows)


@pytest.mark.parametrize("slide", [None, "20 seconds"])
def test_whole_windows(replay, spark, slide):
    events = arrivals(["a", "b"], 13, keys=3)
    stream = replay.load(events).stream()
    table = spark.createDataFrame(events, COLUMNS).withColumn("ts", F.timestamp_seconds("t"))

    def middle(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(["ts", "seq"])
        return ordered.iloc[[len(ordered) // 2]][["key", "window_end", "seq"]].assign(n=len(ordered))

    def found(df):
        made = firing.window_rows(df, ["key"], "ts", "60 seconds", middle, "key bigint, window_end timestamp, seq bigint, n bigint", slide)
        return made.select("key", F.unix_seconds("window_end"), "seq", "n")

    held, step = defaultdict(list), 20 if slide else 60
    for key, t, seq, _ in events:
        for end in range(t - t % step + step, t + 61, step):
            held[key, end].append((t, seq))
    expected = sorted((key, end, sorted(rows)[len(rows) // 2][1], len(rows)) for (key, end), rows in held.items())
    assert sorted(map(tuple, found(table).collect())) == expected
    assert sorted(map(tuple, replay.run(found(stream)).drop("batch_id").collect())) == expected


def test_windows_reach_python_row_by_row(spark):
    """Windows longer and shorter than a batch; numbers keep their digits beside another window's NULLs."""
    rows = [(key, 10 + n, None if key == 2 else 2**60 + n, None if key == 2 and n else True) for key in (1, 2, 3) for n in range(25 * key)]
    table = spark.createDataFrame(rows, "key bigint, t bigint, n bigint, good boolean").withColumn("ts", F.timestamp_seconds("t"))

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        numbers = [] if rows["n"].isna().any() else rows["n"].tolist()
        good = sum(x is True or x == 1 for x in rows["good"].tolist())
        return pd.DataFrame({"key": [rows["key"].iat[0]], "size": [len(rows)], "least": [str(min(numbers, default=""))], "good": [good]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        made = firing.window_rows(table, ["key"], "ts", "600 seconds", told, "key bigint, size bigint, least string, good bigint").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, made)) == [(1, 25, str(2**60), 25), (2, 50, "", 1), (3, 75, str(2**60), 75)]


def state_rows(spark, folder, name):
    reader = spark.read.format("statestore").option("path", f"{folder}/checkpoint").option("stateVarName", name)
    return reader.load().count()


def test_states_of_orders_end(replay, spark):
    """Ten times as many orders, spread over time: what is remembered does not grow."""
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    sizes = []

    def run():
        found = rules.life_cycle(replay.stream("1 second"), ["key"], "ts", "seq", create, pay, "10 seconds", "10 seconds", "60 seconds")
        replay.run(found)
        return state_rows(spark, replay.folder, "memory")

    for start in (0, 500, 1_000):
        events = [(n, 1_000 + n, 2 * n, "create") for n in range(start, start + 500)]
        events += [(n, 1_003 + n, 2 * n + 1, "pay") for n in range(start, start + 500, 2)]
        replay.add(sorted(events, key=lambda e: e[1]))
        replay.add([(10**6 + start, 1_600 + start, 0, "other")])
        sizes.append(run())
    assert max(sizes) < 150 and abs(sizes[2] - sizes[1]) < 20


def test_a_hot_key_is_many_slots(spark):
    """Nine rows in ten on one key: no group of the stream rules is larger than a slot and what it looks back at."""
    key = F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(0).alias("key")
    rows = spark.range(60_000).select(key, F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"))

    def largest(events):
        sizes = np.bincount(events.slot)
        widest = int(sizes.argmax())
        return np.array([widest]), [np.array([sizes[widest]])]

    found = slotted.apply_in_slots(rows, ["key"], "ts", "seq", F.lit(1), largest, "n bigint", back=10_000_000)
    assert 0 < found.agg(F.max("n")).head()[0] <= 50


def test_stream_joins_of_a_hot_key(spark, tmp_path):
    """All rows on one key, over several batches: pairs and singles as in batch."""
    left = [(1, t, seq, "a") for _, t, seq, _ in arrivals(["a"], 20, count=150, share=1)]
    right = [(1, t + 2, seq, "a") for _, t, seq, _ in arrivals(["a"], 21, count=150, share=1)]
    one = Replay(spark, str(tmp_path / "one")).load(left).stream()
    two = Replay(spark, str(tmp_path / "two")).load(right).stream()
    two = two.withColumn("key", F.when(F.col("key") < 0, -2).otherwise(F.col("key")))
    found = Replay(spark, str(tmp_path)).run(matching.reconcile_pairs(one, two, "key", "ts", "ts", "2 seconds"))
    rows = found.filter("coalesce(pay.key, receipt.key) > 0").select("pay.seq", F.col("receipt.seq").alias("other"), "channel").collect()
    near = brute.interval_pairs(left, right, -2, 2)
    singles = [(e[2], None) for e in left if e[2] not in {a for a, _ in near}] + [(None, e[2]) for e in right if e[2] not in {b for _, b in near}]
    assert sorted(((r.seq, r.other) for r in rows), key=str) == sorted([*near, *singles], key=str)
    assert near and singles
