"""Idempotent file sinks for ``foreachBatch`` and the views that read them.

Every micro-batch writes its own ``batch_id=<n>`` folder in overwrite mode, so a batch that is run again after a
failure replaces its own output and nothing else. Readers pick the newest rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BATCH = "batch_id"
_DAY = "window_day"

BatchWriter = Callable[[DataFrame, int], None]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's ``spark.checkpoint.dir``, or under its warehouse where that is not set.

    On a cluster the warehouse must then be a place that all machines see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_streams"
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local($|\[)", master) and re.match(r"file:|/|[^:]*$", root):
            raise RuntimeError(f"set spark.checkpoint.dir: {root} is local to the driver")
    return f"{root.rstrip('/')}/{name}-{spark.sql('SELECT uuid()').head()[0]}"


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")


def log_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Append each batch to a log, optionally after a batch-only step such as a ranking."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch) if transform else batch, path, batch_id)

    return write


def channel_writer(path: str, channel: str = "channel") -> BatchWriter:
    """Main and side outputs: one sub-folder per channel."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, [channel])

    return write


def read_log(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All batches of a log with their ``batch_id``.

    If nothing was written yet: an empty frame where ``schema`` (without ``batch_id``) tells the columns, else an error.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], StructType([*schema.fields, StructField(BATCH, IntegerType())]))


def newest_groups(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the last batch that wrote a group: a changed window replaces its earlier version as a whole."""
    last = log.groupBy(*by).agg(F.max(BATCH).alias(BATCH))
    return log.join(last, [*by, BATCH], "left_semi").drop(BATCH)


def newest_rows(log: DataFrame, keys: Sequence[str], version: str = BATCH) -> DataFrame:
    """The last version of each keyed row (a keyed store filled by upserts)."""
    rest = [c for c in log.columns if c not in (*keys, BATCH, version)]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return newest.select(*keys, "_row.*")


def ranked_update_writer(
    counts_path: str,
    ranks_path: str,
    rank: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    by: str = "window_end",
) -> BatchWriter:
    """For counts in update mode: store the changed counts and rank every changed window again.

    Counts are stored by day of the window and batch, and only the days a batch changed are read back (their number is
    bounded by the calendar); older days can be removed at any time. Read the ranks with ``newest_groups(log, [by])``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.withColumn(_DAY, F.to_date(by)).withColumn(BATCH, F.lit(batch_id)).persist()
        try:
            # Only this batch's own folders are replaced if it runs again.
            (
                changed.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(_DAY, BATCH)
                .parquet(counts_path)
            )
            days = [row[0] for row in changed.select(_DAY).distinct().collect()]
            if not days:
                return
            stored = spark.read.option("basePath", counts_path).parquet(*[f"{counts_path}/{_DAY}={d}" for d in days])
            touched = stored.filter(F.col(BATCH) <= batch_id).join(changed.select(by).distinct(), by, "left_semi")
            write_batch(rank(newest_rows(touched.drop(_DAY), [*keys, by])), ranks_path, batch_id)
        finally:
            changed.unpersist()

    return write
