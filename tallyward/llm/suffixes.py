"""Removal of byte strings that occur more than once, by a distributed difference-cover algorithm.

Only strings of ``window`` (200) bytes matter, so suffixes are ordered by no more than their first 200 bytes:

1. Cover. A difference cover modulo ``MODULUS`` holds, for every shift, two residues that differ by it. Two equal
   200-byte strings therefore have sampled positions at the same offset, and the ``TUPLE`` (68) bytes after it lie
   inside both. Sampled tuples get names (hashes), are dealt by name, sorted, and names met once are dropped.
2. Recursion on names. Only starts within reach of a repeated sampled tuple remain. They get the name of their whole
   200 bytes (64 bits plus the bits of their bucket from a second hash), dealt and sorted likewise.
3. Merge. What the sorted runs say of each name (a bit: met elsewhere or not) goes back to its chunk, where starts become
   covered bytes, spans and kept bytes.

Texts are dealt once into chunks by a key of the text, compressed; equal texts of a batch travel once, with a count. A
chunk sends each name once, however often it holds it, so a passage that a third of all documents share is one entry
per chunk. Work per task: one chunk, or one range of names.

The full suffix array (modulus 3, every suffix ordered) needs over ten bytes shuffled per byte of text and is not built:
suffixes that differ within 200 bytes from all others can be dropped after the first naming round.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A perfect difference set: every residue modulo 133 is the difference of two of these (checked below).
MODULUS, COVER = 133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
assert len({(a - b) % MODULUS for a in COVER for b in COVER}) == MODULUS
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 4_000_000

_U = np.uint64
_BASES = (6364136223846793005, 2862933555777941757)
_LETTERS = [np.random.default_rng(i).integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1) for i in (11, 12)]
_SAMPLED = np.isin(np.arange(MODULUS), COVER)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int) -> None:
        self._base = base
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> _Powers:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 20)
            inverse = pow(self._base, -1, 2**64)
            self.up = np.cumprod(np.r_[_U(1), np.full(size, self._base, _U)])
            self.down = np.cumprod(np.r_[_U(1), np.full(size, inverse, _U)])
        return self


_POWERS = [_Powers(b) for b in _BASES]


def _hashes(data: np.ndarray, starts: np.ndarray, length: int, which: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each start on; the starts ascend."""
    out = np.empty(len(starts), _U)
    step = 1 << 20
    powers = _POWERS[which].upto(step + length + 1)
    for low in range(0, len(data), step):
        first, last = np.searchsorted(starts, (low, low + step))
        if first == last:
            continue
        part = data[low : low + step + length]
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(_LETTERS[which][part] * powers.up[: len(part)], out=sums[1:])
        at = starts[first:last] - low
        out[first:last] = (sums[at + length] - sums[at]) * powers.down[at]
    return _mixed(out)


class _Chunk:
    """The different texts of a chunk, in order of their keys."""

    def __init__(self, table: pa.Table) -> None:
        copies: dict[tuple[int, int], int] = {}
        bodies: dict[tuple[int, int], bytes] = {}
        for keys, counts, sizes, body in zip(*(table.column(c).to_pylist() for c in ("keys", "copies", "sizes", "body"))):
            whole, at = zlib.decompress(body), 0
            keys = map(tuple, np.frombuffer(keys, np.int64).reshape(-1, 2).tolist())
            for key, n, size in zip(keys, *(np.frombuffer(x, np.int64).tolist() for x in (counts, sizes))):
                copies[key] = copies.get(key, 0) + n
                bodies[key] = whole[at : at + size]
                at += size
        self.keys = sorted(bodies)
        self.copies = [copies[k] for k in self.keys]
        self.data = np.frombuffer(b"".join(bodies[k] for k in self.keys), np.uint8)
        self.offsets = np.r_[0, np.cumsum([len(bodies[k]) for k in self.keys], dtype=np.int64)]

    def room(self, starts: np.ndarray) -> np.ndarray:
        """Bytes from each start to its text's end."""
        text = np.searchsorted(self.offsets, starts, side="right") - 1
        return self.offsets[text + 1] - starts

    def sampled(self, length: int) -> np.ndarray:
        parts = [
            at + np.flatnonzero(np.resize(_SAMPLED, end - at - length + 1))
            for at, end in zip(self.offsets[:-1], self.offsets[1:])
            if end - at >= length
        ]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def candidates(self, repeated: np.ndarray, window: int) -> np.ndarray:
        """Starts of windows that hold a whole repeated tuple."""
        text = np.searchsorted(self.offsets, repeated, side="right") - 1
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, np.maximum(repeated - MODULUS + 1, self.offsets[text]), 1)
        np.add.at(edges, repeated + 1, -1)
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        return starts[self.room(starts) >= window]


class _Names:
    """Names of positions: different ones in order of (bucket, name), with the position's place among them."""

    def __init__(self, chunk: _Chunk, starts: np.ndarray, length: int, buckets: int, short: bool) -> None:
        name = _hashes(chunk.data, starts, length, 0)
        if short:  # 40 bits; a false hit costs a later comparison, never a wrong result
            bucket = ((name >> _U(40)) * _U(buckets) >> _U(24)).astype(np.uint16)
            name &= _U((1 << 40) - 1)
        else:
            bucket = ((_hashes(chunk.data, starts, length, 1) >> _U(40)) * _U(buckets) >> _U(24)).astype(np.uint16)
        order = np.argsort(name)
        order = order[np.argsort(bucket[order], kind="stable")]
        name, bucket = name[order], bucket[order]
        new = np.r_[True, (name[1:] != name[:-1]) | (bucket[1:] != bucket[:-1])][: len(name)]
        self.place = np.empty(len(name), np.int64)
        self.place[order] = np.cumsum(new) - 1
        # Copies of a text count as further positions of its names.
        text = np.searchsorted(chunk.offsets, starts, side="right") - 1
        weight = np.minimum(np.asarray(chunk.copies, np.int64), 2)[text] if len(starts) else np.empty(0, np.int64)
        self.repeated = np.bincount(self.place, weights=weight, minlength=int(new.sum())) > 1
        self.names, self.bucket = name[new], bucket[new]
        self.short = short

    def rows(self, chunk: int) -> pa.Table:
        buckets, first = np.unique(self.bucket, return_index=True)
        ends = np.r_[first[1:], len(self.bucket)].astype(np.int64)
        blobs = [_packed(self.names[a:b], self.short) for a, b in zip(first, ends)]
        bits = [np.packbits(self.repeated[a:b]).tobytes() for a, b in zip(first, ends)]
        columns = [pa.array(buckets.astype(np.int32)), pa.array([chunk] * len(buckets), pa.int32()), blobs, bits]
        return pa.table([columns[0], columns[1], pa.array(blobs, pa.binary()), pa.array(bits, pa.binary())], _NAMES)

    def marked(self, answers: dict[int, bytes]) -> np.ndarray:
        """For each position, whether its name occurs at another position."""
        found = np.zeros(len(self.names), bool)
        buckets, first = np.unique(self.bucket, return_index=True)
        for bucket, a, b in zip(buckets, first, np.r_[first[1:], len(self.bucket)].astype(np.int64)):
            found[a:b] = np.unpackbits(np.frombuffer(answers[int(bucket)], np.uint8), count=b - a)
        return found[self.place]


_NAMES = ["bucket", "chunk", "names", "repeated"]


def _packed(names: np.ndarray, short: bool) -> bytes:
    if not short:
        return names.tobytes()
    return names.astype("<u4").tobytes() + (names >> _U(32)).astype(np.uint8).tobytes()


def _unpacked(blob: bytes, short: bool) -> np.ndarray:
    if not short:
        return np.frombuffer(blob, _U)
    n = len(blob) // 5
    return np.frombuffer(blob, "<u4", n).astype(_U) | (np.frombuffer(blob, np.uint8, n, 4 * n).astype(_U) << _U(32))


def _deal(names: DataFrame, phase: int) -> DataFrame:
    """Sorts the names of each bucket; answers every (chunk, bucket) with a bit per name: it is also elsewhere."""
    short = phase == 1

    def compare(table: pa.Table) -> pa.Table:
        blobs = [_unpacked(b, short) for b in table.column("names").to_pylist()]
        sizes = np.array([len(b) for b in blobs])
        every = np.concatenate(blobs)
        twice = [np.unpackbits(np.frombuffer(r, np.uint8), count=n) for r, n in zip(table.column("repeated").to_pylist(), sizes)]
        twice = np.concatenate(twice).astype(bool)
        order = np.argsort(every)
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        met = np.zeros(len(every), bool)
        met[order[1:][same]] = True
        met[order[:-1][same]] = True
        met |= twice
        bits = [np.packbits(part).tobytes() for part in np.split(met, np.cumsum(sizes)[:-1])]
        phases = pa.array([phase] * len(bits), pa.int32())
        return pa.table([table.column("chunk"), phases, table.column("bucket"), pa.array(bits, pa.binary())], _BITS)

    return names.groupBy("bucket").applyInArrow(compare, "chunk int, phase int, bucket int, bits binary")


_BITS = ["chunk", "phase", "bucket", "bits"]


def text_key(text: str = "text") -> list[Column]:
    """Two 64-bit halves of a text's key, ``k1`` and ``k2``; a NULL text has that of an empty one."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(17), body).alias("k2")]


def remove_repeats(docs: DataFrame, window: int = 200, text: str = "text") -> DataFrame:
    """``docs`` with n_removed, n_spans and ``kept``, the remaining bytes of the text (see ``repeats``)."""
    # A column of the input that has the name of a new one gives way to it.
    new = ("k1", "k2", "n_removed", "n_spans", "kept")
    base = docs.drop(*new)
    zero = F.lit(0).cast("long")
    joined = base.select("*", *text_key(text)).join(repeats(docs, window, text), ["k1", "k2"], "left")
    return joined.select(
        *[joined[c] for c in base.columns],
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", F.col(text).cast("binary"), F.lit(b"")).alias("kept"),
    )


def repeats(docs: DataFrame, window: int = 200, text: str = "text") -> DataFrame:
    """Per different text that loses bytes: k1, k2, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a string of ``window`` bytes over it also starts elsewhere, in any document; overlaps count.

    Defined results: NULL and empty texts have 0 bytes and lose none; nor do texts shorter than ``window``; each row of a
    repeated id is a document of its own; equal texts of ``window`` bytes or more lose all; an empty table gives no
    rows; other columns are ignored.
    """
    length = window - MODULUS + 1
    if length < 16:
        raise ValueError(f"window must be at least {MODULUS + 15}")
    keyed = docs.select(*text_key(text), F.col(text).cast("binary").alias("body"))
    total = keyed.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    chunks = max(6, int(total // CHUNK_BYTES))
    buckets = min(60_000, max(6, chunks // 3))

    def ship(batches):
        for batch in batches:
            seen: dict[tuple[int, int], list] = {}
            for k1, k2, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                entry = seen.setdefault((k1, k2), [0, body])
                entry[0] += 1
            by_chunk: dict[int, list] = {}
            for key, (n, body) in seen.items():
                by_chunk.setdefault(key[0] % chunks, []).append((key, n, body.as_py()))
            for chunk, rows in by_chunk.items():
                numbers = ([k for k, _, _ in rows], [n for _, n, _ in rows], [len(b) for _, _, b in rows])
                blobs = [np.array(x, np.int64).tobytes() for x in numbers]
                blobs.append(zlib.compress(b"".join(b for _, _, b in rows), 1))
                arrays = [pa.array([chunk], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs)]
                yield pa.RecordBatch.from_arrays(arrays, ["chunk", "keys", "copies", "sizes", "body"])

    texts = (
        keyed.filter(F.octet_length("body") >= window)
        .mapInArrow(ship, "chunk int, keys binary, copies binary, sizes binary, body binary")
    )

    def sampled_names(chunk: _Chunk) -> _Names:
        return _Names(chunk, chunk.sampled(length), length, buckets, short=True)

    def starts_of(chunk: _Chunk, bits: pa.Table) -> np.ndarray:
        return chunk.candidates(chunk.sampled(length)[sampled_names(chunk).marked(_answers(bits, 1))], window)

    def first_names(table: pa.Table) -> pa.Table:
        return sampled_names(_Chunk(table)).rows(table.column("chunk")[0].as_py())

    def second_names(table: pa.Table, bits: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        return _Names(chunk, starts_of(chunk, bits), window, buckets, short=False).rows(table.column("chunk")[0].as_py())

    def merge(table: pa.Table, bits: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        starts = starts_of(chunk, bits)
        hit = starts[_Names(chunk, starts, window, buckets, short=False).marked(_answers(bits, 2))]
        edges = np.zeros(len(chunk.data) + 1, np.int32)
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + window, -1)
        gone = np.cumsum(edges[:-1]) > 0
        rows = []
        for (k1, k2), a, b in zip(chunk.keys, chunk.offsets[:-1], chunk.offsets[1:]):
            part = gone[a:b]
            if part.any():
                spans = int(part[0]) + int(np.count_nonzero(part[1:] & ~part[:-1]))
                rows.append((k1, k2, int(part.sum()), spans, chunk.data[a:b][~part].tobytes()))
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["k1", "k2", "n_removed", "n_spans", "kept"])

    names = "bucket int, chunk int, names binary, repeated binary"
    first = _deal(texts.groupBy("chunk").applyInArrow(first_names, names), 1)
    second = _deal(texts.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(second_names, names), 2)
    return (
        texts.groupBy("chunk")
        .cogroup(first.unionByName(second).groupBy("chunk"))
        .applyInArrow(merge, "k1 long, k2 long, n_removed long, n_spans long, kept binary")
    )


def _answers(bits: pa.Table, phase: int) -> dict[int, bytes]:
    columns = (bits.column(c).to_pylist() for c in ("phase", "bucket", "bits"))
    return {bucket: answer for p, bucket, answer in zip(*columns) if p == phase}

