"""Text records to typed rows and back: CSV lines, web-server log lines, message values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

SECONDS, MILLIS = "seconds", "millis"

# Web-log date pattern and the token positions that are read.
LOG_TIME_PATTERN = "dd/MM/yyyy:HH:mm:ss"
LOG_TOKENS = {"ip": 0, "user_id": 1, "ts": 3, "method": 5, "url": 6}

# A record may have a ``channel`` of its own.
OUTCOME = "parse_channel"
PARSED, MALFORMED = "parsed", "malformed"


def read_lines(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """One row per text line, in column ``value``."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def numbered_lines(spark: SparkSession, path: str, number: str = "seq") -> DataFrame:
    """Text lines with their number, counted from 0 through all files in order of their paths.

    How Spark packs files into tasks has no part in it: lines are numbered within their piece of a file, and pieces,
    of which there are few, by (path, start).
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    pieces = rows.groupBy("_path", "_start").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_path", "_start", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(pieces, ["_path", "_start"]).select(
        "value", (F.col("_before") + F.col("_at") - F.col("_first")).alias(number)
    )


def read_records(
    spark: SparkSession, path: str, schema: StructType, streaming: bool = False, unit: str = SECONDS, **options
) -> DataFrame:
    """Typed rows straight from header-less CSV files; the last column is an epoch number.

    Malformed fields become NULL. Use ``parse_records`` on ``read_lines`` to keep such lines apart.
    """
    raw = StructType(schema.fields)
    columns = ", ".join(
        f"{f.name} {'bigint' if isinstance(f.dataType, TimestampType) else f.dataType.simpleString()}" for f in raw
    )
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(columns).options(**options).csv(path)
    return rows.select(
        *[
            _epoch(F.col(f.name), unit).alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else _text(F.col(f.name), f.name).alias(f.name)
            for f in raw
        ]
    )


def _text(column: Column, name: str) -> Column:
    # The CSV reader gives NULL for an empty field; an order without a transaction has "".
    return F.coalesce(column, F.lit("")) if name == "tx_id" else column


def _epoch(number: Column, unit: str) -> Column:
    return F.timestamp_seconds(number) if unit == SECONDS else F.timestamp_millis(number)


def parse_records(
    lines: DataFrame,
    schema: StructType,
    unit: str = SECONDS,
    value: str = "value",
    strict: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split comma-separated ``value`` text into the schema's columns; works on files and on message streams.

    Lenient (default): adds ``parse_channel``, ``malformed`` where a field is missing or does not convert, so that one
    bad line does not stop the job. Strict: a bad line fails the query. ``keep`` names columns to carry along.
    """

    def field(tokens: str, place: int) -> Column:
        kind = schema.fields[place].dataType
        token = _token(tokens, place, strict)
        if isinstance(kind, StringType):
            return token
        number = "bigint" if isinstance(kind, TimestampType) else kind.simpleString()
        typed = token.cast(number) if strict else token.try_cast(number)
        return _epoch(typed, unit) if isinstance(kind, TimestampType) else typed

    fields = {name: place for place, name in enumerate(schema.names)}
    return _parsed(lines, ",", fields, field, value, strict, keep)


def parse_web_log(
    lines: DataFrame, value: str = "value", strict: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Space-separated web-server log lines; the zone token after the time is not applied."""

    def field(tokens: str, place: int) -> Column:
        token = _token(tokens, place, strict)
        if place != LOG_TOKENS["ts"]:
            return token
        return F.to_timestamp(token, LOG_TIME_PATTERN) if strict else F.try_to_timestamp(token, F.lit(LOG_TIME_PATTERN))

    return _parsed(lines, " ", LOG_TOKENS, field, value, strict, keep)


def _token(tokens: str, place: int, strict: bool) -> Column:
    return F.element_at(tokens, place + 1) if strict else F.get(tokens, F.lit(place))


def _parsed(lines, separator, fields, field, value, strict, keep) -> DataFrame:
    # Split once; the optimizer keeps the split apart from the fields taken from it.
    split = lines.select(*keep, value, F.split(F.col(value), separator, -1).alias("_tokens"))
    columns = [field("_tokens", place).alias(name) for name, place in fields.items()]
    if strict:
        return split.select(*keep, *columns)
    # The fields come out of a generator (of one row): filters on them stay above it. On a plain projection every
    # such filter would be copied below it, splitting and converting the line again for each field.
    rows = split.select(*keep, value, F.inline(F.array(F.struct(*columns))))
    complete = F.lit(True)
    for name in fields:
        complete = complete & F.col(name).isNotNull()
    return rows.withColumn(OUTCOME, F.when(complete, PARSED).otherwise(MALFORMED))


def parsed_only(rows: DataFrame, value: str = "value") -> DataFrame:
    return rows.filter(F.col(OUTCOME) == PARSED).drop(OUTCOME, value)


def malformed_only(rows: DataFrame, value: str = "value") -> DataFrame:
    return rows.filter(F.col(OUTCOME) == MALFORMED).select(value)


def encode_records(rows: DataFrame, schema: StructType, unit: str = SECONDS) -> DataFrame:
    """The comma-separated ``value`` text of each row: the inverse of ``parse_records``."""
    texts = []
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            instant = column.cast("timestamp")
            column = F.unix_seconds(instant) if unit == SECONDS else F.unix_millis(instant)
        texts.append(F.coalesce(column.cast("string"), F.lit("")))
    return rows.select(F.concat_ws(",", *texts).alias("value"))
