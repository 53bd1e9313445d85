"""Session settings shared by the tests, the bench and local use.

On a cluster the caller brings their own session; nothing in the operators depends on
these values except ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", name: str = "tallyward", **conf: str) -> SparkSession:
    cores = master[6:-1] if master.startswith("local[") else "200"
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STORE,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
