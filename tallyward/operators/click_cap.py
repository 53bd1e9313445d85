"""Daily click cap per key with a blacklist warning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.hashing import salt
from tallyward.functions.timing import business_day

# The click limit, the zone of the business day and the warning text.
MAX_CLICKS = 100
BUSINESS_ZONE = "Asia/Shanghai"
CAP_MESSAGE = "超过点击上限"

PASSED, BLACKLISTED = "passed", "black-list"

# Largest rank bound for which Spark prunes ranks in the map tasks (its default setting).
_MAP_SIDE_RANKS = 1000


def click_cap(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: Sequence[str],
    max_clicks: int = MAX_CLICKS,
    zone: str = BUSINESS_ZONE,
    parts: int | None = None,
) -> DataFrame:
    """The first ``max_clicks`` rows per key and business day pass; the next one raises the day's only warning.

    Adds ``day``, ``row_num`` and ``channel`` (``passed`` or ``black-list``); later rows are left out. Only
    max + 1 ranks are asked for, so each map task sends at most that many rows of a key and day. Beyond the
    bound up to which Spark does that, ranks are first cut within ``parts`` salted groups.
    """
    limit = max_clicks + 1
    if parts is None:
        parts = 1 if limit <= _MAP_SIDE_RANKS else 64
    dated = df.withColumn("day", business_day(ts, zone))
    order = [F.asc(ts), *[F.asc(c) for c in seq]]
    if parts > 1:
        group = Window.partitionBy(*keys, "day", "_salt").orderBy(*order)
        dated = (
            dated.withColumn("_salt", salt(parts, ts, *seq))
            .withColumn("_rank", F.row_number().over(group))
            .filter(F.col("_rank") <= limit)
            .drop("_salt", "_rank")
        )
    ranked = dated.withColumn("row_num", F.row_number().over(Window.partitionBy(*keys, "day").orderBy(*order)))
    return ranked.filter(F.col("row_num") <= limit).withColumn(
        "channel", F.when(F.col("row_num") <= max_clicks, PASSED).otherwise(BLACKLISTED)
    )


def passed(capped: DataFrame) -> DataFrame:
    return capped.filter(F.col("channel") == PASSED).drop("channel", "row_num", "day")


def warnings(capped: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return capped.filter(F.col("channel") == BLACKLISTED).select(*keys, "day", ts, F.lit(CAP_MESSAGE).alias("msg"))
