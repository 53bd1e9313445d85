"""The given tables read as the library's record types (stand-in columns, whole tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Wall-clock columns of the files are UTC; operators work on instants.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(
        *[
            F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def topic(events: DataFrame):
    """The number in ``props``, as text."""
    return F.get_json_object("props", "$.k")


def behaviors(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", F.col("user_id").alias("item_id"), F.col("event_type").alias("behavior"), "ts"
    )


def web_log(events: DataFrame) -> DataFrame:
    """``view`` is GET, everything else POST; the page is the number in ``props``."""
    return events.select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
        F.concat(F.lit("/page/"), topic(events)).alias("url"),
    )


def disordered_web_log(events: DataFrame) -> DataFrame:
    """The web log with an arrival number that is up to 49 places off the time order."""
    return web_log(events).withColumn("seq", F.col("event_id") + F.pmod(F.col("event_id") * 7919, F.lit(50)))


def marketing(events: DataFrame) -> DataFrame:
    return events.select(topic(events).alias("channel"), F.col("event_type").alias("behavior"), "ts")


def ad_clicks(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", F.col("event_type").alias("ad_id"), topic(events).alias("province"), "ts"
    )


def logins(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "event_type", "ts")


def order_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.col("user_id").alias("order_id"), "event_type", "ts")


def pays(events: DataFrame) -> DataFrame:
    clicks = events.filter(F.col("event_type") == "click")
    return clicks.select("event_id", F.col("user_id").cast("string").alias("tx_id"), "ts")


def receipts(events: DataFrame) -> DataFrame:
    purchases = events.filter(F.col("event_type") == "purchase")
    return purchases.select("event_id", F.col("user_id").cast("string").alias("tx_id"), "ts")


def order_pays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments: transaction = order number, time = order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("ts")
    )


def shipment_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as receipts: transaction = order number, time = ship date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("event_id"),
        F.col("l_orderkey").alias("tx_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("ts"),
    )


def order_and_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders (``create``) and their shipments (``pay``) as one stream of order events."""
    creates = order_pays(spark, sf_dir).select(
        F.col("tx_id").alias("order_id"), F.lit("create").alias("event_type"), F.lit(0).alias("event_id"), "ts"
    )
    ships = shipment_receipts(spark, sf_dir).select(
        F.col("tx_id").alias("order_id"), F.lit("pay").alias("event_type"), F.lit(1).alias("event_id"), "ts"
    )
    return creates.unionByName(ships)


def shipments_as_behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipment_receipts(spark, sf_dir).select(
        F.col("part_id").alias("item_id"), F.col("supplier_id").alias("user_id"), F.lit("pv").alias("behavior"), "ts"
    )
