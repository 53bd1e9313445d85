"""Every registered query against its SQL on DuckDB."""

import oracle
import pytest

import __spark_entry__ as entry
from tallyward.plans.catalog import CATALOG

SMALL, CHECKED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in CATALOG}
BATCH = [name for name in SQL if not name.startswith("stream_")]
STREAMS = [name for name in SQL if name.startswith("stream_")]


@pytest.fixture(scope="module")
def connections():
    return {sf_dir: oracle.connect(sf_dir) for sf_dir in (SMALL, CHECKED)}


def check(spark, connections, name, sf_dir):
    expected = oracle.sql_rows(connections[sf_dir], SQL[name])
    found = oracle.spark_rows(entry.queries()[name](spark, sf_dir))
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    return found[1]


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, connections, name):
    assert check(spark, connections, name, CHECKED)


@pytest.fixture(scope="module")
def part_files(spark, tmp_path_factory):
    """The small tables as folders of part files."""
    folder = str(tmp_path_factory.mktemp("parts"))
    for name, order in (("events", "event_id"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        table.repartitionByRange(3, order).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", STREAMS)
def test_streaming_replay(spark, connections, part_files, name):
    expected = oracle.sql_rows(connections[SMALL], SQL[name])
    assert oracle.spark_rows(entry.queries()[name](spark, part_files)) == expected


@pytest.mark.parametrize("name", ["stream_pv_hourly", "stream_late_split"])
def test_streaming_replay_of_one_file(spark, connections, name):
    assert check(spark, connections, name, SMALL)


def test_every_query_has_sql():
    assert {name for name in entry.queries() if name in CATALOG} <= set(SQL)


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "cnt", "window_end", "row_num"]
