"""Hashed words and word shingles of many texts at once, in numpy over the texts' UTF-8 bytes.

A word is a run of digits, letters A-Z (taken as a-z) and bytes of 128 and more, so any character beyond ASCII is part of
a word. Hashes have 64 bits and depend on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 6364136223846793005
_LETTERS = np.random.default_rng(5).integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _upto(n: int) -> None:
    if len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 19)
        _powers["up"] = np.cumprod(np.r_[_U(1), np.full(size, _BASE, _U)])
        _powers["down"] = np.cumprod(np.r_[_U(1), np.full(size, pow(_BASE, -1, 2**64), _U)])


def text_parts(column: pa.Array, part_bytes: int = 400_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a string column into runs of rows of about ``part_bytes``: first row, end row, bytes, offsets."""
    if not len(column):
        return
    filled = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(filled):
        end = int(np.searchsorted(offsets, offsets[first] + part_bytes, side="right")) - 1
        end = min(max(end, first + 1), len(filled))
        at = offsets[first : end + 1]
        yield first, end, data[at[0] : at[-1]], at - at[0]
        first = end


def _located(data: np.ndarray, offsets: np.ndarray):
    """Word starts and ends, running sums of the letters' hashes, and for each text the first word's place."""
    low = _LOWER[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _INSIDE[low]
    before = np.r_[False, inside[:-1]]
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.r_[inside[1:], False]
    cuts = offsets[1:] - 1
    after[cuts[cuts >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    _upto(len(data))
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_LETTERS[low] * _powers["up"][: len(data)], out=sums[1:])
    return starts, ends, sums, np.searchsorted(starts, offsets)


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the first word's place (one more at the end)."""
    starts, ends, sums, first = _located(data, offsets)
    return mixed((sums[ends] - sums[starts]) * _powers["down"][starts]), first


def hashed_prefixes(
    data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...], buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per word the buckets (1 to ``buckets`` - 1) of the word and of its first bytes, and the texts' first places.

    A prefix of a length that the word does not exceed has bucket 0. ``buckets`` is a power of two.
    """
    starts, ends, sums, first = _located(data, offsets)
    down = _powers["down"][starts]
    out = np.zeros((len(starts), 1 + len(lengths)), np.int32)
    for i, length in enumerate((0, *lengths)):
        to = ends if not length else np.minimum(starts + length, len(data))
        hashed = mixed((sums[to] - sums[starts]) * down + _U(length)) & _U(buckets - 1)
        out[:, i] = np.where(starts + length < ends, np.maximum(hashed, _U(1)).astype(np.int32), 0)
    return out, first


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words, and each text's first place; a text of fewer words, but not none, is one run."""
    counts = np.diff(first)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    places = np.r_[0, np.cumsum(sizes)]
    at = np.repeat(first[:-1] - places[:-1], sizes) + np.arange(places[-1])
    end = np.repeat(first[1:], sizes)
    out = np.full(len(at), _U(n))
    for i in range(n):
        there = at + i
        inside = there < end
        step = words[np.minimum(there, max(len(words) - 1, 0))] if len(words) else np.empty(0, _U)
        out = np.where(inside, mixed(out * _U(0x9E3779B97F4A7C15) + step), out)
    return out, places
