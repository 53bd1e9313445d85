"""What several operators share: input tables, shared tables that cut lineage, row keys, column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``, else the one of the context.

    Where neither is set (tests, local sessions) a folder below the warehouse is used.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Later steps read files that survive the loss of executors, and a costly plan runs once. The folder is new for each
    call, and a retried task replaces its own file, so a table is either whole or absent.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyward-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hands Python at most ``rows`` rows at a time in this session: texts are long, and a batch is held several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row's id and text, as text; equal rows have equal keys, NULL included."""
    return F.concat_ws(
        ":",
        F.hex(F.xxhash64(*columns)),
        F.hex(F.xxhash64(F.lit(17), *columns)),
    )


def bounded_broadcast(df: DataFrame, limit: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows; otherwise Spark shuffles both sides."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def sha256_of(parts: Column) -> Column:
    """Lowercase hex SHA-256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(parts, ","), 256)
