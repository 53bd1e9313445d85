"""Sequence packing: shortest-pack-first over the length histogram.

1. ``token_rows`` encodes each whole text once, ``pieces`` cuts token rows into pieces of at most ``capacity`` ids.
2. ``plan_packs`` sees only the histogram of piece lengths (at most ``capacity`` numbers). Lengths are placed longest
   first, each into the packs with the most room left; packs of equal content are one pattern with a count.
3. ``place`` ranks the pieces of a length and joins the ranks with the patterns' rank intervals.

Ranks are taken per (length, bucket) and shifted by the counts of the buckets before, so a length that most pieces
share is spread over all tasks. Nothing but the histogram reaches the driver.

Defined results: a NULL or empty text has no ids of its own, only the end id; NULL ids are kept; equal rows are packed
one by one; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import bounded_broadcast, small_batches, stored

#: Chunks whose ids a Python worker remembers at most; beyond it the memory is emptied and filled anew.
REMEMBERED = 700_000
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


class ChunkEncoder:
    """Ids of whole texts for a tokenizer that drops white space and never joins ids across it.

    A text's ids are then those of its white-space separated chunks in a row, and a chunk's ids are remembered. A
    chunk of letters is one pre-token, so it goes to the merges directly; a closing full stop or comma after an ASCII
    letter is always a pre-token of its own. Everything else takes the tokenizer's full way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._letters = _byte_letters()
        self._known: dict[bytes, bytes] = {}
        self.remembered = REMEMBERED

    def _slow(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: bytes) -> bytes:
        found = self._known.get(chunk)
        if found is None:
            if len(chunk) > 1 and chunk[-1:] in b".," and chunk[-2:-1].isalpha():
                found = self._chunk(chunk[:-1]) + self._chunk(chunk[-1:])
            else:
                text = chunk.decode("utf-8", "replace")
                if not _LATIN.fullmatch(text):
                    found = self._slow(text)
                elif (lower := text.lower().encode()) != chunk:
                    found = self._chunk(lower)
                else:
                    mapped = chunk.decode("latin-1").translate(self._letters)
                    found = _packed([token.id for token in self._tokenizer.model.tokenize(mapped)])
            self._known[chunk] = found
        return found

    def ids(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids of a text in UTF-8."""
        if b"<|" in text:  # may hold the tokenizer's own special strings
            return self._slow(text.decode("utf-8", "replace"))
        if len(self._known) > self.remembered:
            self._known.clear()
        chunks = text.split()
        known = self._known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            return b"".join(map(self._chunk, chunks))


def _packed(ids: list[int]) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


_ENCODERS: dict[str, ChunkEncoder] = {}


def token_rows(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit, ``end_id`` last) of each document.

    ``tokenizer_path`` names a file that exists on every executor; its vocabulary must drop white space.
    """
    end = end_id.to_bytes(4, "little")
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(tokenizer_path, None) or ChunkEncoder(tokenizer_path)
        _ENCODERS[tokenizer_path] = encoder
        encoder.remembered = remembered
        for batch in batches:
            for part in _slices(batch):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                ids = [encoder.ids(t or b"") + end for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        encode, f"doc_id {kind}, ids binary"
    )


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Small slices, so that what is made of a batch is small at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def pieces(tokens: DataFrame, capacity: int) -> DataFrame:
    """Token rows cut at multiples of ``capacity``: doc_id, start, length, ids, doc_tokens."""
    total = (F.octet_length("ids") / 4).cast("long")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(capacity).cast("long")))
    length = F.least(F.lit(capacity).cast("long"), F.col("doc_tokens") - F.col("start"))
    return (
        tokens.withColumn("doc_tokens", total)
        .select("doc_id", "ids", "doc_tokens", starts.alias("start"))
        .withColumn("length", length)
        .withColumn("ids", F.expr(f"substring(ids, int(start * 4 + 1), {capacity * 4})"))
    )


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, end rank, first sequence, offset) for pieces counted by length.

    Pieces of a length with ranks in [first, end) lie at ``offset`` of the sequences ``first sequence`` onwards. The
    work depends on the number of different lengths and patterns, not on the number of pieces.
    """
    # Free room -> patterns as (count, ((length, offset), ...)).
    open_packs: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    done: list[tuple[int, tuple]] = []
    rooms = [0] * (capacity + 1)  # patterns by free room
    roomiest = 0

    def put(room: int, count: int, pattern: tuple) -> None:
        nonlocal roomiest
        if room:
            open_packs[room].append((count, pattern))
            rooms[room] += 1
            roomiest = max(roomiest, room)
        else:
            done.append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while roomiest and not rooms[roomiest]:
                roomiest -= 1
            if roomiest >= length:
                room = roomiest
                count, pattern = open_packs[room].pop()
                rooms[room] -= 1
                used = min(count, left)
                if used < count:
                    put(room, count - used, pattern)
                put(room - length, used, (*pattern, (length, capacity - room)))
            else:
                # As many packs as the pieces need when each pack takes as many of this length as fit.
                fit = capacity // length
                whole, rest = divmod(left, fit)
                used = left
                slots = tuple((length, i * length) for i in range(fit))
                if whole:
                    put(capacity - fit * length, whole, slots)
                if rest:
                    put(capacity - rest * length, 1, slots[:rest])
            left -= used
    done += [pack for room in sorted(open_packs) for pack in open_packs[room]]
    slots, ranks, first = [], defaultdict(int), 0
    for count, pattern in done:
        for length, offset in pattern:
            slots.append((length, ranks[length], ranks[length] + count, first, offset))
            ranks[length] += count
        first += count
    return slots


def place(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (doc_id, start, length, ...).

    ``cut`` is read twice; pass a stored table.
    """
    spark = cut.sparkSession
    histogram = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = "length long, first_rank long, end_rank long, first_sequence long, offset long"
    slots = bounded_broadcast(spark.createDataFrame(plan_packs(histogram, capacity), schema), 500_000)
    buckets = min(4096, max(64, sum(histogram.values()) // 50_000))
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    offsets = counts.select("length", "bucket", before.alias("before"))
    inner = Window.partitionBy("length", "bucket").orderBy(*[F.col(c) for c in cut.columns if c != "length"])
    ranked = (
        keyed.withColumn("local", F.row_number().over(inner))
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("local") - 1)
    )
    inside = (
        (ranked["length"] == slots["length"])
        & (ranked["rank"] >= slots["first_rank"])
        & (ranked["rank"] < slots["end_rank"])
    )
    return ranked.join(slots, inside).select(
        *[ranked[c] for c in cut.columns],
        (slots["first_sequence"] + ranked["rank"] - slots["first_rank"]).alias("sequence_id"),
        slots["offset"],
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    keep_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` with ``keep_ids``.
    ``remembered`` trades a Python worker's memory (some 200 bytes for each chunk) for time.
    """
    cut = pieces(token_rows(docs, tokenizer_path, end_id, remembered=remembered), capacity).withColumn("ids_crc32", F.crc32("ids"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]
    return place(stored(cut.select(*columns), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: its ids in order, joined from pieces packed with ``keep_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda got, part: F.concat(got, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_ids"))
