"""From raw documents to packed training sequences: the stages in order, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and returns them with the columns of
``documents``; the last returns the packed pieces. Every row is decided on by itself, whatever id it has: rows share a key
only if all their columns are equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import decontaminate, minhash, packing, secrets, toxicity
from tallyward.llm.common import read_table, stored
from tallyward.llm.queries import WORD_VOCABULARY


_ROW = "_row"


def _with_row(docs: DataFrame) -> DataFrame:
    """Adds a key of the row: its id, rows without one last, and a hash of its columns. Rows that are equal have equal keys."""
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    number = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), number.alias("id"), F.xxhash64(*plain).alias("hash"))
    return docs.withColumn(_ROW, key)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with their keys) whose key is not in ``gone``, without the key."""
    return docs.join(gone, _ROW, "left_anti").drop(_ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier takes for toxic go; NULL and empty texts stay."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the smallest id, rows without an id last; of equal rows one."""
    keyed = _with_row(docs)
    fates = stored(
        minhash.near_duplicates(keyed, doc_id=_ROW).groupBy(F.col("doc_id").alias(_ROW)).agg(F.max("kept").alias("kept"), F.count("*").alias("n")),
        "fates",
    )
    rest = keyed.join(fates.filter("not kept").select(_ROW), _ROW, "left_anti")
    again = fates.filter("kept and n > 1").select(_ROW)
    if not again.limit(1).count():
        return rest.drop(_ROW)
    once = rest.join(again, _ROW, "left_semi").dropDuplicates([_ROW])
    return rest.join(again, _ROW, "left_anti").unionByName(once).drop(_ROW)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with words of a benchmark item go."""
    keyed = _with_row(docs)
    found = decontaminate.contamination(keyed, read_table(spark, sf_dir, "benchmark"), doc_id=_ROW)
    return _without(keyed, found.filter("n_hit > 0").select(F.col("doc_id").alias(_ROW)).distinct())


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers live on through the stages, so this one leaves less behind in them.
    return packing.pack(docs, WORD_VOCABULARY, 4096, 2, keep_ids=False, remembered=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: A classifier and a signature join are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
