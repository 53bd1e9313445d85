"""Known results for the sample inputs."""

import pytest
import samples
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.plans import jobs
from tallyward.sources import lines


@pytest.fixture
def logins(lines_of):
    return parsed(lines_of, samples.LOGINS.splitlines(), schemas.LOGIN)


@pytest.fixture
def orders(lines_of):
    return parsed(lines_of, samples.ORDERS.splitlines(), schemas.ORDER)


@pytest.fixture
def receipts(lines_of):
    return parsed(lines_of, samples.RECEIPTS.splitlines(), schemas.RECEIPT)


@pytest.fixture
def clicks(lines_of):
    return parsed(lines_of, samples.AD_CLICKS.splitlines(), schemas.AD_CLICK)


def parsed(lines_of, text_lines, schema):
    return lines.parsed_only(lines.parse_records(lines_of(text_lines), schema, keep=["seq"]))


def seconds(warnings):
    rows = warnings.select("user_id", F.unix_seconds("first_fail_ts"), F.unix_seconds("last_fail_ts")).collect()
    return sorted((u, a - 1558430000, b - 1558430000) for u, a, b in rows)


def test_sample_facts(logins, orders, clicks):
    assert logins.filter("event_type = 'fail'").count() == 9
    assert orders.groupBy("event_type").count().orderBy("event_type").collect() == [("create", 39), ("pay", 40)]
    assert clicks.count() == 143
    assert clicks.select("province").distinct().count() == 7


def test_login_rules(logins):
    assert seconds(jobs.login_pairs(logins, ["seq"])) == [(1035, 842, 843), (1035, 843, 844)]
    assert seconds(jobs.login_times(logins, ["seq"])) == [(1035, 842, 844)]
    assert seconds(jobs.login_strict(logins, ["seq"])) == [(1035, 842, 844)]
    assert seconds(jobs.login_anchored(logins, ["seq"])) == [(1035, 842, 844)]


def test_order_payments(orders):
    result = jobs.order_payments(orders, ["seq"])
    assert {r.channel: r["count"] for r in result.groupBy("channel").count().collect()} == {"payed": 37, "timeout": 2}
    late = result.filter("channel = 'timeout'").select("order_id", "pay_ts", "result_msg").orderBy("order_id").collect()
    assert late == [(34756, None, "订单34756已经延迟支付"), (34767, None, "订单34767已经延迟支付")]


def test_order_life_cycle(orders):
    result = jobs.order_life_cycle(orders)
    ids = {}
    for row in result.collect():
        ids.setdefault(row.channel, []).append(row.order_id)
    assert len(ids.pop("payed")) == 37
    assert {k: sorted(v) for k, v in ids.items()} == {
        "payed-but-timeout": [34756, 34767],
        "data not found": [34768],
    }


def test_interval_join(orders, receipts):
    pairs = jobs.pay_receipt_join(jobs.payments(orders), receipts).select(
        "pay.tx_id", (F.unix_seconds("receipt.ts") - F.unix_seconds("pay.ts")).alias("gap")
    )
    assert {r.tx_id: r.gap for r in pairs.collect()} == {
        "sd76f87d6": 3,
        "3hu3k2432": 3,
        "3243hr9h9": -3,
        "329d09f9f": 0,
    }


@pytest.mark.parametrize("form", ["once", "pairs"])
def test_reconcile(orders, receipts, form):
    pays = jobs.payments(orders)
    if form == "once":
        result = jobs.pay_receipt_reconcile(pays, receipts, "seq")
    else:
        result = jobs.pay_receipt_pairs(pays, receipts)
    counts = {r.channel: r["count"] for r in result.groupBy("channel").count().collect()}
    assert counts == {"matched": 5, "single-pay": 35, "single-receipt": 35}
    extra = result.filter("channel = 'matched' AND pay.tx_id = '435kjb45d'")
    assert extra.count() == 1


def test_reconcile_without_limit(orders, receipts):
    result = jobs.pay_receipt_reconcile(jobs.payments(orders), receipts, "seq", "1 day")
    singles = result.filter("channel <> 'matched'").select("channel", F.coalesce("pay.tx_id", "receipt.tx_id"))
    assert sorted(map(tuple, singles.collect())) == [
        ("single-pay", "35jue34we"),
        ("single-pay", "88snrn932"),
        ("single-receipt", "8fdsfae83"),
        ("single-receipt", "ewr342as4"),
    ]
    assert result.filter("channel = 'matched'").count() == 38


def test_click_cap(clicks):
    assert jobs.capped_clicks(clicks, ["seq"]).filter("channel = 'passed'").count() == 122
    warning = jobs.ad_blacklist(clicks, ["seq"]).select("user_id", "ad_id", F.unix_seconds("ts"), "msg").collect()
    assert warning == [(937166, 1715, 1511661701, "超过点击上限")]


def test_province_counts(clicks):
    counts = jobs.province_counts(clicks, ["seq"])
    row = counts.agg(F.count("*"), F.sum("cnt"), F.max("cnt")).head()
    assert tuple(row) == (5988, 87840, 101)
    assert counts.orderBy(F.desc("cnt")).head().province == "beijing"
    first = counts.filter("window_end_str = '2017-11-26 02:00:05.0' AND province = 'beijing'").head()
    assert first.cnt == 5
