import pytest
from pyspark.sql import functions as F

from tallyward.functions.hashing import poly_offset, poly_offset_text
from tallyward.operators import visitors
from tallyward.plans import jobs, tables


def poly(text, bits=29):
    value = 0
    for char in text:
        value = value * 61 + ord(char)
    return value & ((1 << bits) - 1)


def test_hash_forms(spark):
    ids = [0, 7, 42, 543462, -1, 2**63 - 1, -(2**63), 10**18 + 7]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    rows = df.select("id", poly_offset("id"), poly_offset_text(F.col("id").cast("string"))).collect()
    assert [(r[1], r[2]) for r in rows] == [(poly(str(r[0])), poly(str(r[0]))) for r in rows]
    text = spark.createDataFrame([("user-abc" * 20,), ("",)], "id string")
    assert [r[0] for r in text.select(poly_offset_text("id")).collect()] == [poly("user-abc" * 20), 0]


def visits(spark):
    return spark.range(20000).select(
        (F.col("id") % 3000).alias("user_id"), F.timestamp_seconds(F.col("id") % 7200).alias("ts")
    )


def counts(df):
    return {str(r.window_end): r.cnt for r in df.collect()}


def test_bitmap_equals_distinct_offsets(spark):
    df = visits(spark)
    exact = counts(visitors.unique_visitors(df, "user_id", "ts", "1 hour"))
    wide = counts(visitors.bitmap_totals(visitors.visitor_bitmaps(df, "user_id", "ts", "1 hour")))
    assert wide == exact
    # A small bitmap collides: fewer bits than visitors, as many as there are different offsets.
    small = counts(visitors.bitmap_totals(visitors.visitor_bitmaps(df, "user_id", "ts", "1 hour", bits=10)))
    offsets = df.withColumn("user_id", poly_offset("user_id", bits=10))
    assert small == counts(visitors.unique_visitors(offsets, "user_id", "ts", "1 hour"))
    assert all(small[end] < exact[end] for end in exact)


def test_bitmaps_merge(spark):
    df = visits(spark)
    bitmaps = visitors.visitor_bitmaps(df, "user_id", "ts", "1 hour")
    merged = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    assert merged.agg(F.sum(F.bitmap_count("bitmap"))).head()[0] == 3000


@pytest.mark.parametrize("size", ["1 hour", "1 day"])
def test_sketches_are_close(spark, size):
    events = tables.events(spark, "/root/testdata/sf0.1").filter("event_type = 'view'")
    exact = counts(visitors.unique_visitors(events, "user_id", "ts", size))
    hourly = visitors.visitor_sketches(events, "user_id", "ts", "1 hour")
    found = counts(visitors.sketch_totals(visitors.merge_sketches(hourly, "window_end", size)))
    assert found.keys() == exact.keys()
    # Three standard errors of a sketch with 2^12 registers.
    assert all(abs(found[end] - cnt) <= max(1, 0.05 * cnt) for end, cnt in exact.items())


def test_first_sightings_count_the_visitors(spark):
    events = tables.events(spark, "/root/testdata/sf0.01")
    view = F.col("event_type") == "view"
    seen = visitors.first_sightings(events, "user_id", "ts", "1 hour", view).groupBy("window_end").count()
    expected = jobs.unique_visitors(tables.behaviors(events), view="view")
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, expected.collect()))
