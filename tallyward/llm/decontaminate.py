"""Benchmark decontamination by a prefix-filtered set join; DataFrame functions only.

A window of an item is contained in a document only if all its shingles (five words) are, so one of them is enough to find
it: the prefix of a set for full containment has one token, and the rarest is the cheapest. The steps:

1. Documents become words once; their shingles meet the set of item shingles. Where that set is small (it is counted) it is
   broadcast and documents are not shuffled; else shingles are shuffled with nothing but their place and the document's key,
   and the words around the places that matched are fetched by that key. The few that match are stored with their place, the
   words around them and the document's number of words.
2. Shingles are ordered by how often they matched; a window with one that never did is dropped, each other one
   keeps its rarest shingle with its offset.
3. Stored matches join the windows on that shingle. The place fixes the window's start (positional bound), which must leave
   room for the whole window in the document (length bound); then the words themselves are compared.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import bounded_broadcast, sha256_of, stored

#: Everything but digits, letters A-Z in either case and characters beyond ASCII separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 5


def with_words(df: DataFrame, text: str, words: str = "words") -> DataFrame:
    """Adds the array of words of a text, A-Z lower-cased and other characters as they are; no words for NULL."""
    plain = F.octet_length(text) == F.char_length(text)

    def lowered(word: Column) -> Column:
        mapped = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(mapped)

    # For ASCII texts lower() maps A-Z only; elsewhere it would change other letters, so each word is looked at.
    split = F.array_remove(F.split(F.when(plain, F.lower(text)).otherwise(F.col(text)), SEPARATORS), "")
    return (
        df.withColumn("_plain", plain)
        .withColumn("_split", F.coalesce(split, F.array().cast("array<string>")))
        .withColumn(words, F.when(F.col("_plain"), F.col("_split")).otherwise(F.transform("_split", lowered)))
        .drop("_plain", "_split")
    )


def _shingle_hashes(words: str, size: int) -> Column:
    """A hash for each run of ``size`` words."""

    def one(i: Column) -> Column:
        return F.xxhash64(F.lit(size), *[F.get(F.col(words), i + j) for j in range(size)])

    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<long>"))


def item_windows(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, window (words joined by a space) and win (words) for each run of ``window`` words of an item."""
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))))
    return (
        with_words(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("_text")), "_text")
        .filter(F.size("words") > 0)
        .select("item_id", "words", starts.alias("at"))
        .select("item_id", F.slice("words", F.col("at"), F.lit(window)).alias("win"))
        .select("item_id", F.array_join("win", " ").alias("window"), "win")
        .distinct()
    )


def _place(low: Column, sizes: list[int]) -> Column:
    """The first word of a shingle from its number; the runs of the sizes follow one another, larger sizes first."""
    offset = F.lit(0)
    for size in sorted(sizes, reverse=True):
        offset = F.when(low >= 0, low).otherwise(offset)
        low = low - F.greatest(F.size("words") - size + 1, F.lit(0))
    return offset


def _runs(sizes: list[int]) -> list[Column]:
    return [_shingle_hashes("words", size) for size in sorted(sizes, reverse=True)]


def _around(window: int) -> list[Column]:
    return [F.col("from"), F.slice("words", F.col("from") + 1, F.lit(2 * window + SHINGLE)).alias("around")]


def _hits_by_broadcast(worded: DataFrame, wanted: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """A row per shingle that matches, and one per document with ``at`` -1, in one pass without a shuffle."""
    # One row with a shingle of its own per document carries its number of words through the join.
    marker = F.lit(0).cast("long")
    everything = F.broadcast(wanted.unionByName(worded.sparkSession.range(1).select(marker.alias("shingle"))).distinct())
    exploded = worded.select("doc_id", "k1", "k2", "words", F.posexplode_outer(F.concat(F.array(marker), *_runs(sizes))).alias("place", "shingle"))
    at = F.when(F.col("place") == 0, -1).otherwise(_place(F.col("place") - 1, sizes))
    matched = (
        exploded.join(everything, "shingle")
        .filter((F.col("place") == 0) | (F.col("shingle") != 0))
        .withColumn("at", at)
        .withColumn("from", F.greatest(F.col("at") - window, F.lit(0)))
    )
    start, around = _around(window)
    return matched.select(
        "doc_id", "k1", "k2", F.size("words").alias("n_words"), "shingle", "at", start, F.when(F.col("at") >= 0, around).alias("around")
    )


def _hits_by_shuffle(worded: DataFrame, wanted: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """The same for a set of any size: shingles are joined by themselves, then places fetch their words by the document's key."""
    none = {"shingle": "long", "at": "int", "from": "int", "around": "array<string>"}
    markers = worded.select(
        "doc_id", "k1", "k2", F.size("words").alias("n_words"), *[F.lit(-1 if c == "at" else None).cast(t).alias(c) for c, t in none.items()]
    )
    if not sizes:
        return markers
    exploded = worded.select("k1", "k2", F.posexplode(F.concat(*_runs(sizes))).alias("place", "shingle"))
    # A shingle of a passage that many documents share is a key of many rows; adaptive execution splits it.
    met = exploded.join(wanted, "shingle").groupBy("k1", "k2").agg(F.collect_set(F.struct("place", "shingle")).alias("met"))
    once = worded.select("k1", "k2", "words").join(met.select("k1", "k2"), ["k1", "k2"], "left_semi")
    once = once.groupBy("k1", "k2").agg(F.any_value("words").alias("words"))  # equal rows have equal words
    placed = once.join(met, ["k1", "k2"]).select("k1", "k2", "words", F.inline("met"))
    placed = placed.withColumn("at", _place(F.col("place"), sizes)).withColumn("from", F.greatest(F.col("at") - window, F.lit(0)))
    found = placed.select(
        F.lit(None).cast(worded.schema["doc_id"].dataType).alias("doc_id"),
        "k1", "k2", F.size("words").alias("n_words"), "shingle", "at", *_around(window),
    )
    return markers.unionByName(found)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    broadcast_limit: int = 1_000_000,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside an occurrence of a window), item_ids (sorted as strings).

    Defined results: a NULL or empty text has no words and no hits; an item without words has no windows; one of fewer words
    than ``window`` is one window; equal rows get equal results, and rows that share an id are looked at one by one; an
    empty table of documents gives no rows, one of items no hits; other columns are ignored.
    """
    windows = stored(item_windows(items, window), "windows")
    win_shingles = (
        windows.select("window", "win")
        .distinct()
        .withColumn("size", F.least(F.size("win"), F.lit(SHINGLE)))
        .select("*", F.lit(0).alias("_none"))
    )
    sizes = [row["size"] for row in win_shingles.select("size").distinct().collect()]  # at most SHINGLE values
    hashed = F.lit(None).cast("array<long>")
    for size in sizes:
        hashed = F.when(F.col("size") == size, _shingle_hashes("win", size)).otherwise(hashed)
    win_shingles = win_shingles.select("window", "win", F.posexplode(hashed).alias("at", "shingle"))

    keys = [F.xxhash64(F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.lit(17), F.col(doc_id), F.col(text)).alias("k2")]
    worded = with_words(docs.select(F.col(doc_id).alias("doc_id"), *keys, F.col(text).alias("_text")), "_text")
    wanted = win_shingles.select("shingle").distinct()
    if wanted.limit(broadcast_limit + 1).count() <= broadcast_limit:
        hits = _hits_by_broadcast(worded, wanted, sizes, window)
    else:
        hits = _hits_by_shuffle(worded, wanted, sizes, window)
    hits = stored(hits, "hits")

    found = hits.filter("at >= 0")
    rarity = found.groupBy("shingle").agg(F.count("*").alias("n"))
    prefixes = (
        win_shingles.join(rarity, "shingle", "left")
        .groupBy("window")
        .agg(
            F.any_value("win").alias("win"),
            F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", F.col("at").alias("offset"))).alias("rarest"),
        )
        .filter("rarest.n > 0")
        .select("window", "win", "rarest.shingle", "rarest.offset")
    )
    start, size = F.col("at") - F.col("offset"), F.size("win")
    occurrences = stored(
        found.join(bounded_broadcast(prefixes, broadcast_limit // 10), "shingle")
        .filter((start >= 0) & (start + size <= F.col("n_words")))
        .filter(F.slice("around", start - F.col("from") + 1, size) == F.col("win"))
        .select("k1", "k2", start.alias("start"), size.alias("size"), "window")
        .distinct(),
        "occurrences",
    )
    hit_words = (
        occurrences.select("k1", "k2", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("word"))
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("n_hit"))
    )
    hit_items = (
        occurrences.select("k1", "k2", "window")
        .distinct()
        .join(windows.select("window", "item_id"), "window")
        .select("k1", "k2", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )
    return (
        hits.filter("at < 0")
        .select("doc_id", "k1", "k2", F.col("n_words").cast("long").alias("n_words"))
        .join(hit_words, ["k1", "k2"], "left")
        .join(hit_items, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of ``contamination``."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_of(F.col("item_ids")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
