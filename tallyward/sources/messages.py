"""Message-queue source and sink. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.sources.lines import SECONDS, encode_records

# Default topic of the item job and the start position.
ITEM_TOPIC = "hotitems"
START_AT = "latest"

_HINT = "the Kafka connector (spark-sql-kafka) is not on the class path"


def message_values(messages: DataFrame) -> DataFrame:
    """Plain-string message values as ``value`` rows, from the connector's binary column."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_topic(
    spark: SparkSession, servers: str, topic: str = ITEM_TOPIC, start: str = START_AT, **options
) -> DataFrame:
    """Message values of a topic as a stream; tasks pull offset ranges in parallel."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
    )
    try:
        return message_values(reader.load())
    except AnalysisException as error:
        raise _explained(error) from error


def _explained(error: AnalysisException) -> Exception:
    """A plain hint if Spark has no such source; any other error as it is."""
    return RuntimeError(_HINT) if "failed to find data source" in str(error).lower() else error


def write_topic(
    rows: DataFrame, servers: str, schema: StructType, topic: str = ITEM_TOPIC, unit: str = SECONDS
) -> None:
    """Write rows as one unkeyed text message each. Every task writes its own partition."""
    writer = encode_records(rows, schema, unit).write.format("kafka")
    try:
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    except AnalysisException as error:
        raise _explained(error) from error
