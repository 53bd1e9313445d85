"""Hash expressions, all inside whole-stage code generation unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base of the polynomial hash and the size of the visitor bitmap (2^29 bits).
POLY_BASE = 61
BITMAP_BITS = 29

_MAX_BIGINT_CHARS = 20


def poly_offset(key: str, base: int = POLY_BASE, bits: int = BITMAP_BITS) -> Column:
    """Bitmap position of an integer key: base-``base`` polynomial of its decimal text, mod 2^bits.

    A bigint has at most 20 characters, so the polynomial is a fixed sum of 20 terms taken from
    the right; positions past the left end contribute 0. The low ``bits`` of the products add up
    to less than 2^42, so nothing overflows and no per-character lambda is needed.
    """
    text = F.reverse(F.col(key).cast("string"))
    mask = (1 << bits) - 1
    total = F.lit(0).cast("bigint")
    for place in range(_MAX_BIGINT_CHARS):
        weight = pow(base, place, 1 << bits)
        total = total + F.ascii(F.substring(text, place + 1, 1)).cast("bigint") * F.lit(weight)
    return total.bitwiseAND(F.lit(mask).cast("bigint"))


def poly_offset_text(key: str | Column, base: int = POLY_BASE, bits: int = BITMAP_BITS) -> Column:
    """The same hash for text of any length (a fold over characters, outside code generation)."""
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return F.aggregate(
        F.filter(F.split(key, ""), lambda c: c != ""),
        F.lit(0).cast("bigint"),
        lambda acc, c: (acc * F.lit(base) + F.ascii(c)).bitwiseAND(mask),
    )


def salt(parts: int, *columns: str) -> Column:
    """Deterministic salt: the same row gets the same salt when a task is run again."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")
