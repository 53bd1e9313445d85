"""Corrected rankings and the keyed table behind them over several micro-batches."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators import lateness, windows
from tallyward.streaming import rankings, store

COLUMNS = "url string, t bigint, seq bigint, method string"
KEYED = "k string, n bigint, part bigint"


def table(spark, folder, fold, every=3):
    return store.KeyedTable(spark, f"{folder}/table", KEYED, "part", fold, every)


def put(spark, keyed, batch_id, rows):
    keyed.put(spark.createDataFrame(rows, KEYED), batch_id, sorted({r[2] for r in rows}))


def contents(keyed, parts=None):
    return sorted(tuple(r) for r in keyed.read(parts).collect())


def folders(folder, kind):
    return sum(f"kind={kind}" in path and "part=" in path for path, _, _ in os.walk(f"{folder}/table"))


@pytest.mark.parametrize("every", [1, 3, 100])
def test_added_up_deltas(spark, tmp_path, every):
    """Every batch is run twice, as after a failure; sums do not change by it."""
    rnd, total = random.Random(every), Counter()
    keyed = table(spark, tmp_path, store.added_up(["k", "part"], "n"), every)
    for batch in range(12):
        rows = [(rnd.choice("abc"), rnd.randrange(5), rnd.randrange(3) if batch % 3 else 7) for _ in range(4)]
        for _ in range(2):
            put(spark, keyed, batch, rows)
        for k, n, part in rows:
            total[k, part] += n
        assert contents(keyed) == sorted((k, n, p) for (k, p), n in total.items())
    assert contents(keyed, [7]) == sorted((k, n, p) for (k, p), n in total.items() if p == 7)
    assert contents(keyed, []) == contents(keyed, [99]) == []
    if every == 3:
        # A read sees at most one snapshot and a few deltas of each part.
        assert folders(tmp_path, "snapshot") <= 4 and folders(tmp_path, "delta") <= 4 * (every + 1)


def test_newest_rows_and_groups(spark, tmp_path):
    rows = table(spark, tmp_path / "rows", store.last_row(["k", "part"]), 2)
    groups = table(spark, tmp_path / "groups", store.last_group(["part"]), 2)
    for batch in range(7):
        written = [("a", batch, 0), ("b" if batch < 5 else "a", 10 + batch, batch % 2 + 1)]
        for keyed in (rows, groups):
            put(spark, keyed, batch, written)
    assert contents(rows) == [("a", 6, 0), ("a", 15, 2), ("a", 16, 1), ("b", 13, 2), ("b", 14, 1)]
    assert contents(groups) == [("a", 6, 0), ("a", 15, 2), ("a", 16, 1)]


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    keyed = table(spark, tmp_path, store.added_up(["k", "part"], "n"), 2)
    put(spark, keyed, 0, [("a", 1, 0)])
    put(spark, keyed, 1, [("a", 1, 0)])
    os.remove(f"{tmp_path}/table/batch=1/kind=delta/_SUCCESS")
    assert contents(keyed) == [("a", 1, 0)]
    put(spark, keyed, 1, [("a", 5, 0)])
    assert contents(keyed) == [("a", 6, 0)]


def requests(seed, count=400, disorder=40):
    rnd = random.Random(seed)
    rows = []
    for seq in range(count):
        t = max(0, seq * 9 - (rnd.randrange(disorder * 20) if rnd.random() < 0.2 else rnd.randrange(disorder)))
        rows.append((f"/{rnd.randrange(4)}", t, seq, "GET" if rnd.random() < 0.9 else "POST"))
    return rows


def expected(rows, size, slide, n, delay=None, allowed=0):
    """Rankings and late rows by plain loops, in arrival order."""
    counts, late, seen = Counter(), [], None
    for url, t, seq, method in rows:
        ends = [e for e in range(t + 1, t + size + 1) if (e - size) % slide == 0]
        if delay is not None and seen is not None:
            ends = [e for e in ends if not e - 0.001 + allowed <= seen - delay]
        if method == "GET":
            counts.update((url, e) for e in ends)
            if not ends:
                late.append(seq)
        seen = t if seen is None else max(seen, t)
    ranked = []
    for end in {e for _, e in counts}:
        held = sorted((-c, url) for (url, e), c in counts.items() if e == end)
        ranked += [(end, i + 1, url, -c) for i, (c, url) in enumerate(held[:n])]
    return sorted(ranked), sorted(late)


class Feed:
    """Files that a stream reads one by one in the order in which they were added."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0

    def add(self, rows):
        df = self.spark.createDataFrame(rows, COLUMNS).withColumn("ts", F.timestamp_seconds("t"))
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        for name in os.listdir(f"{self.folder}/in"):
            full = os.path.join(self.folder, "in", name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 2_000:
                self.files += 1
                os.utime(full, (self.files, self.files))

    def run(self, **settings):
        source = self.spark.readStream.schema(f"{COLUMNS}, ts timestamp").option("maxFilesPerTrigger", 1)
        query = rankings.ranked_windows(
            source.parquet(f"{self.folder}/in"),
            f"{self.folder}/out",
            f"{self.folder}/checkpoint",
            ["url"],
            2,
            where=F.col("method") == "GET",
            once=True,
            every=2,
            **settings,
        )
        query.awaitTermination()
        spans = (settings["size"], settings["slide"])
        return rankings.RankedWindows(self.spark, f"{self.folder}/out", {"url": "string"}, *spans, every=2)


def ranks_of(found):
    return sorted(tuple(r) for r in found.ranks().select(F.unix_seconds("window_end"), "row_num", "url", "cnt").collect())


@pytest.mark.parametrize("size, slide", [(600, 5), (120, 120), (90, 60), (7200, 1800)])
def test_rankings_of_disordered_batches(spark, tmp_path, size, slide):
    """Without arrival numbers every row counts, whichever batch brings it; the job is stopped and started again."""
    rows, feed = requests(size), Feed(spark, str(tmp_path))
    settings = {"size": f"{size} seconds", "slide": f"{slide} seconds"}
    for i in range(0, 400, 100):
        feed.add(rows[i : i + 100])
        if i in (100, 300):
            found = feed.run(**settings)
            assert ranks_of(found) == expected(rows[: i + 100], size, slide, 2)[0]


def test_rankings_with_late_rows(spark, tmp_path):
    """On-time counts, corrections and late rows of one job agree with a walk in arrival order, over a stop and a start."""
    rows, feed = requests(3), Feed(spark, str(tmp_path))
    settings = {"size": "120 seconds", "slide": "30 seconds", "seq": "seq", "delay": "60 seconds", "allowed": "60 seconds"}
    for i in range(0, 400, 80):
        feed.add(rows[i : i + 80])
        if i in (160, 320):
            found = feed.run(**settings)
            ranked, late = expected(rows[: i + 80], 120, 30, 2, 60, 60)
            assert ranks_of(found) == ranked
            assert sorted(r.seq for r in found.side_rows().filter("channel = 'late'").collect()) == late
    assert len(late) > 10


def test_rows_without_number_or_time(spark, tmp_path):
    rows, feed = requests(4, 60), Feed(spark, str(tmp_path))
    feed.add([*rows, ("/x", 100, None, "GET"), ("/y", None, 1_000, "GET")])
    feed.add([("/z", 200_000, None, "GET"), ("/0", 10_000, 2_000, "GET")])
    settings = {"size": "60 seconds", "slide": "60 seconds", "seq": "seq", "delay": "60 seconds", "allowed": "0 seconds"}
    found = feed.run(**settings)
    ranked, late = expected([*rows, ("/0", 10_000, 2_000, "GET")], 60, 60, 2, 60, 0)
    assert ranks_of(found) == ranked
    channels = {r.url: r.channel for r in found.side_rows().filter("url in ('/x', '/z')").collect()}
    assert channels == {"/x": lateness.UNNUMBERED, "/z": lateness.UNNUMBERED}


def test_large_tables_are_dealt_over_more_tasks(spark):
    rows = [(key, n * 60) for key in range(40) for n in range(0, 50, 1 + key % 3)]
    df = spark.createDataFrame(rows, "key bigint, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    few = windows.windowed_counts(df, ["key"], "ts", "10 minutes", "1 minute")
    many = windows.windowed_counts(df, ["key"], "ts", "10 minutes", "1 minute", pairs_per_task=500)
    assert many.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
