"""Tokens per field and section: a document is encoded once, as a whole, and its tokens are attributed by their places.

The fields of a row are joined by a line break and encoded together. A byte-level vocabulary gives back every byte, so the
lengths of the tokens' byte strings, summed up, are their places in the text; these intervals are joined with the
sections' intervals by search in sorted bounds. A token that crosses a bound goes to one section by a named rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import small_batches

#: What may be done with a token that lies in several sections: it goes to the one that has most of its bytes (the first of
#: several such), or to the one in which it starts.
RULES = ("most", "start")
_BREAK = 10
_ENCODERS: dict[tuple[str, str], tuple] = {}


def encoder(path: str, pattern: str):
    """A byte-level encoder from a file of ranks, and the byte length of each id."""
    if (path, pattern) not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            sizes[i] = len(token)
        _ENCODERS[path, pattern] = (
            tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
            sizes,
        )
    return _ENCODERS[path, pattern]


def attributed(ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, from the tokens' ends and the sections' ends (bytes; both cover the same text)."""
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    section = np.searchsorted(bounds, starts, side="right")
    if rule == "most":
        last = np.searchsorted(bounds, ends - 1, side="right")
        for i in np.flatnonzero(last > section):
            cuts = bounds[section[i] : last[i]]
            shares = np.diff(np.r_[starts[i], cuts, ends[i]])
            section[i] += int(np.argmax(shares))
    return np.bincount(section, minlength=len(bounds))


def _sections(fields: list[bytes], by_line: bool) -> tuple[bytes, np.ndarray, list[int], list[int]]:
    """The joined text, the sections' ends, and each section's field and number within it.

    A line break belongs to the section before it, so does the one between two fields.
    """
    ends, owners, numbers, at = [], [], [], 0
    for f, field in enumerate(fields):
        tail = 1 if f + 1 < len(fields) else 0
        inner = np.flatnonzero(np.frombuffer(field, np.uint8) == _BREAK) + 1 if by_line else np.empty(0, np.int64)
        inner = inner[inner < len(field)]
        here = np.r_[inner, len(field) + tail] + at
        ends.append(here)
        owners += [f] * len(here)
        numbers += range(len(here))
        at += len(field) + tail
    return b"\n".join(fields), np.concatenate(ends), owners, numbers


def section_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    fields: tuple[str, ...] = ("text",),
    by_line: bool = True,
    rule: str = "most",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document, field and section: doc_id, field, section, start, end, n_tokens, doc_tokens.

    ``start`` and ``end`` are code points of the field (a section's own line break included), ``doc_tokens`` counts the
    whole document. ``vocabulary`` names a file of ranks on every executor, ``pattern`` cuts texts before the merges.

    Defined results: a NULL field is empty; an empty field is one section without tokens of its own; rows with the same id
    are encoded one by one; an empty table gives no rows; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = list(fields)
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = encoder(vocabulary, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                texts = [part.column(1 + f).cast(pa.binary()).to_pylist() for f in range(len(names))]
                rows, own, number, start, end, tokens, total = [], [], [], [], [], [], []
                for i in range(part.num_rows):
                    whole, bounds, owners, numbers = _sections([t[i] or b"" for t in texts], by_line)
                    ids = encoding.encode_ordinary(whole.decode("utf-8", "replace"))
                    ends = np.cumsum(sizes[np.array(ids, np.int64)])
                    counts = attributed(ends, bounds, rule) if len(ids) else np.zeros(len(bounds), np.int64)
                    # Code points are bytes that do not continue a character.
                    points = np.r_[0, np.cumsum((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)]
                    stops = points[bounds]
                    begins = np.r_[0, stops[:-1]]
                    owner = np.array(owners)
                    base = begins[np.searchsorted(owner, owner)]  # where the field starts
                    rows += [i] * len(bounds)
                    own += owners
                    number += numbers
                    start.append(begins - base)
                    end.append(stops - base)
                    tokens.append(counts)
                    total += [len(ids)] * len(bounds)
                columns = [
                    part.column(0).take(pa.array(rows, pa.int32())),
                    pa.array(names).take(pa.array(own, pa.int32())),
                    pa.array(number, pa.int32()),
                    *(pa.array(np.concatenate(x).astype(np.int64)) for x in (start, end, tokens)),
                    pa.array(total, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, _COLUMNS)

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(names)])
    return picked.mapInArrow(
        count, f"doc_id {kind}, field string, section int, start long, end long, n_tokens long, doc_tokens long"
    )


_COLUMNS = ["doc_id", "field", "section", "start", "end", "n_tokens", "doc_tokens"]
