import pytest
import samples
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.sources import lines, messages


def write_lines(spark, tmp_path, name, text_lines):
    path = str(tmp_path / name)
    spark.createDataFrame([(line,) for line in text_lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_read_keeps_empty_transactions(spark, tmp_path):
    path = write_lines(spark, tmp_path, "orders", samples.ORDERS.splitlines())
    rows = lines.read_records(spark, path, schemas.ORDER)
    assert rows.schema.simpleString() == schemas.ORDER.simpleString()
    assert rows.filter("tx_id = ''").count() == 39
    assert rows.filter("tx_id IS NULL").count() == 0
    parsed = lines.parsed_only(lines.parse_records(lines.read_lines(spark, path), schemas.ORDER))
    assert sorted(parsed.collect()) == sorted(rows.collect())


def test_malformed_lines_are_kept_apart(lines_of):
    rows = lines.parse_records(
        lines_of(["1,2,3,pv,1511658000", "x,2,3,pv,1511658000", "1,2,3", "", "1,2,3,pv,15y"]), schemas.USER_BEHAVIOR
    )
    assert lines.parsed_only(rows).select("user_id", "category_id", F.unix_seconds("ts")).collect() == [
        (1, 3, 1511658000)
    ]
    bad = sorted(r.value for r in lines.malformed_only(rows).collect())
    assert bad == ["", "1,2,3", "1,2,3,pv,15y", "x,2,3,pv,1511658000"]


@pytest.mark.parametrize("bad", ["x,2,3,pv,1511658000", "1,2,3"])
def test_strict_parsing_fails(lines_of, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
        lines.parse_records(lines_of([bad]), schemas.USER_BEHAVIOR, strict=True).collect()


def test_millisecond_times(lines_of):
    rows = lines.parse_records(lines_of(["u-1,CLICK,Wechat,1511658000123"]), schemas.MARKETING, lines.MILLIS)
    assert rows.select(F.unix_millis("ts"), "parse_channel").head() == (1511658000123, "parsed")


def test_marketing_channel_is_kept(lines_of):
    """The record's own ``channel`` and the parse result do not get in each other's way."""
    rows = lines.parse_records(lines_of(["u-1,CLICK,Wechat,1511658000123"]), schemas.MARKETING, lines.MILLIS)
    assert lines.parsed_only(rows).select("channel").head() == ("Wechat",)


def test_web_log(lines_of):
    good = "83.149.9.216 frank - 17/05/2015:10:05:03 +0000 GET /presentations/a.png"
    rows = lines.parse_web_log(lines_of([good, "83.149.9.216 - - 17.05.2015 +0000 GET /a", "too short"]))
    expected = ("83.149.9.216", "frank", "2015-05-17 10:05:03", "GET", "/presentations/a.png")
    assert lines.parsed_only(rows).withColumn("ts", F.col("ts").cast("string")).collect() == [expected]
    assert lines.malformed_only(rows).count() == 2
    assert lines.parse_web_log(lines_of([good]), strict=True).columns == schemas.WEB_LOG.names


@pytest.mark.parametrize(
    "schema, text",
    [(schemas.LOGIN, samples.LOGINS), (schemas.ORDER, samples.ORDERS), (schemas.RECEIPT, samples.RECEIPTS)],
)
def test_encode_is_the_inverse(lines_of, schema, text):
    rows = lines.parsed_only(lines.parse_records(lines_of(text.splitlines()), schema))
    assert sorted(r.value for r in lines.encode_records(rows, schema).collect()) == sorted(text.splitlines())


def test_message_values(spark):
    raw = spark.createDataFrame([(bytearray(b"1,2,3,pv,1511658000"),)], "value binary")
    parsed = lines.parse_records(messages.message_values(raw), schemas.USER_BEHAVIOR)
    assert lines.parsed_only(parsed).select("item_id").head().item_id == 2


def test_missing_connector_is_named(spark):
    with pytest.raises(RuntimeError, match="Kafka connector"):
        messages.read_topic(spark, "localhost:9092")
    row = spark.createDataFrame([("a", "b", None)], schemas.RECEIPT)
    with pytest.raises(RuntimeError, match="Kafka connector"):
        messages.write_topic(row, "localhost:9092", schemas.RECEIPT)


def test_line_numbers_follow_the_files(spark, tmp_path):
    """Larger files are read first, numbered last if they come last."""
    folder = tmp_path / "in"
    folder.mkdir()
    texts = {"a": ["a0", "a1"], "b": [f"b{i}" for i in range(5000)], "c": ["c0"]}
    for name, rows in texts.items():
        (folder / f"{name}.txt").write_text("\n".join(rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = lines.numbered_lines(spark, str(folder)).orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in rows] == [line for name in "abc" for line in texts[name]]
    assert [r.seq for r in rows] == list(range(len(rows)))
