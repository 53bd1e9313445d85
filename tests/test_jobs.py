"""Jobs started from files, and the plans the scale of the jobs depends on."""

import re

import pytest
import samples
from pyspark.sql import functions as F

from tallyward.__main__ import JOBS, STREAMS, main
from tallyward.operators.slots import OWN, SLOT, with_slots
from tallyward.plans import jobs, tables
from tallyward.plans.catalog import CATALOG
from tallyward.streaming import rankings

BEHAVIORS = [
    "1,10,5,pv,1511658000",
    "2,10,5,pv,1511658001",
    "1,11,5,buy,1511658002",
    "bad line",
    "1,11,5,pv,1511661600",
]
WEB_LOG = [
    f"10.0.0.1 u - 17/05/2015:10:{minute:02d}:00 +0000 GET /page/{minute % 3}" for minute in (5, 6, 7, 20, 1, 21)
]
MARKETING = ["u1,CLICK,Wechat,1511658000000", "u2,UNINSTALL,Wechat,1511658000000", "u3,CLICK,Wechat,1511658001000"]
INPUTS = {
    "hot": [BEHAVIORS],
    "page": [BEHAVIORS],
    "unique": [BEHAVIORS],
    "top": [WEB_LOG],
    "late": [WEB_LOG],
    "channel": [MARKETING],
    "ad": [samples.AD_CLICKS.splitlines()],
    "province": [samples.AD_CLICKS.splitlines()],
    "login": [samples.LOGINS.splitlines()],
    "order": [samples.ORDERS.splitlines()],
    "pay": [samples.ORDERS.splitlines(), samples.RECEIPTS.splitlines()],
    "pays": [samples.ORDERS.splitlines(), samples.RECEIPTS.splitlines()],
    "single": [samples.ORDERS.splitlines(), samples.RECEIPTS.splitlines()],
}
ROWS = {
    "hot_items": 24,
    "hot_items_sql": 24,
    "hot_items_report": 24,
    "page_views": 2,
    "page_views_salted": 2,
    "unique_visitors": 2,
    "unique_visitors_bitmap": 2,
    "unique_visitors_sketch": 2,
    "channel_counts": 720,
    "ad_blacklist": 1,
    "province_counts": 5988,
    "login_pairs": 2,
    "login_times": 1,
    "login_strict": 1,
    "login_anchored": 1,
    "order_payments": 39,
    "order_life_cycle": 40,
    "pay_receipt_join": 4,
    "pay_receipt_pairs": 75,
    "pay_receipt_reconcile": 75,
    "single_pays": 35,
    "single_receipts": 35,
    "pays_with_receipt": 5,
    "late_requests": 1,
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_job_from_files(spark, tmp_path, job):
    paths = []
    for place, text in enumerate(INPUTS[job.split("_")[0]]):
        path = tmp_path / f"in{place}.txt"
        path.write_text("\n".join(text), encoding="utf-8")
        paths.append(str(path))
    main([job, "--input", *paths, "--output", str(tmp_path / "out")])
    rows = spark.read.parquet(str(tmp_path / "out")).count()
    assert rows == ROWS.get(job, rows) and rows > 0


STREAM_INPUTS = {
    "hot": BEHAVIORS,
    "page": BEHAVIORS,
    "unique": BEHAVIORS,
    "top": WEB_LOG,
    "channel": MARKETING,
    "capped": samples.AD_CLICKS.splitlines(),
    "login": samples.LOGINS.splitlines(),
    "order": samples.ORDERS.splitlines(),
}


@pytest.mark.parametrize("job", sorted(n for n in STREAMS if not n.startswith("pay_")))
def test_stream_from_files(spark, tmp_path, job):
    """Started, stopped and started again on a folder that grows; the end of time closes all windows."""
    text = STREAM_INPUTS[job.split("_")[0]]
    (tmp_path / "in").mkdir()
    arguments = [job, "--stream", "--once", "--delay", "20 seconds", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")]
    flush = last = text[-1]
    if job != "top_pages":
        number = max((x for x in last.split(",") if x.isdigit()), key=len)
        flush = last.replace(number, "9" + number[1:])
    for place, part in enumerate((text, [flush])):
        (tmp_path / "in" / f"{place}.txt").write_text("\n".join(part), encoding="utf-8")
        main(arguments)
    if job == "top_pages":
        found = rankings.RankedWindows(spark, str(tmp_path / "out"), {"url": "string"}, jobs.PAGE_SIZE, jobs.PAGE_SLIDE).ranks()
    else:
        found = spark.read.parquet(str(tmp_path / "out" / "rows"))
    assert found.count() >= min(ROWS.get(job, 1), 24)


def test_jobs_that_are_no_streams_say_so(tmp_path):
    with pytest.raises(SystemExit):
        main(["hot_items_report", "--stream", "--input", "x", "--output", str(tmp_path / "out")])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SF = "/root/testdata/sf0.001"


def test_rankings_are_cut_before_the_shuffle(spark):
    text = plan(CATALOG["hot_items_topn"].run(spark, SF))
    assert "row_number(), 5, Partial" in text
    assert "row_number(), 3, Partial" in plan(CATALOG["top_pages"].run(spark, SF))
    capped = plan(jobs.capped_clicks(tables.ad_clicks(tables.events(spark, SF)), ["event_id"]))
    assert "row_number(), 101, Partial" in capped


def test_scans_read_only_what_is_needed(spark):
    text = plan(CATALOG["hot_items_topn"].run(spark, SF))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text)[1]
    for wanted in ("IsNotNull(ts)", "IsNotNull(event_type)", "EqualTo(event_type,view)"):
        assert wanted in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("name", [n for n in CATALOG if not n.startswith("stream_")])
def test_no_query_compares_all_with_all(spark, name):
    text = plan(CATALOG[name].run(spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("late_split", "late_requests", "top_pages_in_arrival_order"):
        # Only the last level of the running maximum, over block summaries, is a single task.
        assert "SinglePartition" not in text


def test_a_hot_key_is_spread_over_slots(spark):
    """A third of all rows on one key: no (key, slot) group comes near the key's size."""
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.timestamp_seconds("id").alias("ts")
    )
    placed = with_slots(rows, "ts", back=5_000_000, ahead=5_000_000)
    sizes = placed.groupBy("key", SLOT).count()
    assert sizes.agg(F.max("count")).head()[0] <= 30
    assert placed.filter(OWN).count() == 90_000
    assert placed.count() < 1.25 * 90_000
