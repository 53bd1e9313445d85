"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set: its shingles of five words, each with its number of occurrences. Every unit of weight of an
element throws darts at a line of ranks, a Poisson process that depends on the element and the unit alone; a dart
hits a random coordinate. A document looks at its darts up to a rank that gives about ``k ln k + 2k`` of them, however
many elements it has, and keeps the earliest per coordinate (looking twice as far where a coordinate is empty). Two documents
agree in a coordinate with a probability of their weighted Jaccard similarity.

Coordinates are joined in bands. A bucket's members are paired with its hub only: the member that meets most others over
all its buckets, which among the copies of a text is the text itself or the copy nearest to it. Pairs are verified on all
shingles and linked ones grouped into components. Members of a bucket that are then still in different components are
compared with each other: those that belong to the same leading hub, and those of buckets that many hubs share, in tiles of a bounded size,
which give a spanning forest and never their pairs, the few others as pairs. So no link inside a bucket is lost but those within one component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import small_batches, stored
from tallyward.llm.graph import components
from tallyward.llm.textwords import hashed_words, mixed, shingles, text_parts

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
#: Members, and visitors, of a tile, and the units that they may have together; units that are counted at a time.
TILE, TILE_UNITS, COLUMNS = 256, 2_000_000, 16_384
#: Pairs of different homes that a bucket's members may have each, on average, before the bucket is tiled.
PAIRS_EACH = 64


def weighted_units(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash for each unit of weight: the element's hash with the number of its occurrence; sorted per text."""
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])][: len(hashes)]
    run = np.flatnonzero(new)
    occurrence = np.arange(len(hashes)) - np.repeat(run, np.diff(np.r_[run, len(hashes)]))
    return mixed(hashes + occurrence.astype(_U) * _GOLD)


def dart_signatures(units: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The id of the earliest dart per text and coordinate; texts without units have zeros."""
    n_texts = len(places) - 1
    weights = np.diff(places)
    out = np.zeros((n_texts, k), _U)
    todo = np.flatnonzero(weights)
    reach = (k * math.log(k) + 2 * k) / np.maximum(weights, 1)
    while len(todo):
        picked = np.concatenate([np.arange(places[i], places[i + 1]) for i in todo])
        text = np.repeat(todo, weights[todo])
        cell, limit = units[picked], reach[text]
        rank = np.zeros(len(cell))
        ids, ranks, texts = [], [], []
        throw = 0
        while len(cell):
            throw += 1
            dart = mixed(cell + _U(throw * int(_GOLD) % 2**64))
            rank = rank - np.log(((dart >> _U(11)).astype(np.float64) + 0.5) / 2.0**53)
            near = rank < limit
            cell, limit, rank, text = cell[near], limit[near], rank[near], text[near]
            ids.append(mixed(dart[near] ^ _GOLD))
            ranks.append(rank)
            texts.append(text)
        ids, ranks, texts = np.concatenate(ids), np.concatenate(ranks), np.concatenate(texts)
        late_first = np.argsort(-ranks, kind="stable")
        slot = (texts * k + ((ids >> _U(32)) * _U(k) >> _U(32)).astype(np.int64))[late_first]
        found = np.zeros(n_texts * k, _U)
        found[slot] = ids[late_first] | _U(1)  # of several the last, the earliest dart, stays
        found = found.reshape(n_texts, k)
        full = todo[(found[todo] != 0).all(axis=1)]
        out[full] = found[full]
        todo = todo[(found[todo] == 0).any(axis=1)]
        reach[todo] *= 2
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    bands = signatures.shape[1] // rows
    keys = np.tile(mixed(np.arange(1, bands + 1, dtype=_U)), (len(signatures), 1))
    for r in range(rows):
        keys = mixed(keys * _GOLD + signatures[:, r : bands * rows : rows])
    return keys.view(np.int64)


def _sequence_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits per text that depend on its words and their order."""
    halves = []
    for base in (_U(2862933555777941757), _U(3202034522624059733)):
        up = np.cumprod(np.full(len(words) + 1, base, _U))
        down = np.cumprod(np.full(len(words) + 1, pow(int(base), -1, 2**64), _U))
        sums = np.zeros(len(words) + 1, _U)
        np.cumsum(words * up[:-1], out=sums[1:])
        halves.append(mixed((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(_U)))
    return np.stack(halves, axis=1)


def signed(docs: DataFrame, n: int, k: int, rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, node (16 bytes: documents of the same words share it; NULL without words), n_units, bands."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column(1)):
                words, first = hashed_words(data, offsets)
                units, places = shingles(words, first, n)
                keys = band_keys(dart_signatures(weighted_units(units, places), places, k), rows)
                size = np.diff(places)
                nodes = [x.tobytes() if s else None for x, s in zip(_sequence_keys(words, first), size)]
                flat = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), keys.ravel())
                columns = [batch.column(0).slice(a, b - a), pa.array(nodes, pa.binary()), pa.array(size), flat]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n_units", "bands"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        sign, f"doc_id {kind}, node binary, n_units long, bands array<long>"
    )


def unit_rows(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """node and its units as bytes (see ``_packed``)."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_parts(batch.column(0)):
                words, first = hashed_words(data, offsets)
                hashes, places = shingles(words, first, n)
                units = weighted_units(hashes, places)
                blobs = [_packed(units[i:j]) for i, j in zip(places[:-1], places[1:])]
                nodes = [x.tobytes() for x in _sequence_keys(words, first)]
                columns = [pa.array(nodes, pa.binary()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "units"])

    return docs.select(F.col(text).alias("text")).mapInArrow(unit, "node binary, units binary")


def _packed(units: np.ndarray) -> bytes:
    """The upper 40 bits of each unit: of two texts of n units, about n * n / 2**40 units agree by chance."""
    high = units >> _U(24)
    return high.astype("<u4").tobytes() + (high >> _U(32)).astype(np.uint8).tobytes()


def _unpacked(blob) -> np.ndarray:
    n = len(blob) // 5
    return np.frombuffer(blob, "<u4", n).astype(_U) | (np.frombuffer(blob, np.uint8, n, 4 * n).astype(_U) << _U(32))


def verified(pairs: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose weighted Jaccard similarity is at least ``percent`` hundredths, counted on all units."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            hits = []
            for i in range(batch.num_rows):
                x, y = _unpacked(left[i].as_buffer()), _unpacked(right[i].as_buffer())
                together = len(np.unique(np.concatenate([x, y])))
                hits.append((len(x) + len(y) - together) * 100 >= percent * together)
            yield batch.select([0, 1]).filter(pa.array(hits, pa.bool_()))

    left = units.select(F.col("node").alias("a"), F.col("units").alias("units_a"))
    right = units.select(F.col("node").alias("b"), F.col("units").alias("units_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "units_a", "units_b")
    return both.mapInArrow(check, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, percent: int = 80, n: int = 5, k: int = 128, rows: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, component_id (the smallest doc_id of its group), kept (it is that document).

    Documents are linked at a weighted Jaccard similarity of ``percent`` hundredths or more of their ``n``-word shingles (a
    text of fewer words is one shingle). A pair at 0.8 shares none of 32 bands of 4 with a probability of 5e-8.

    Defined results: a text that is NULL or has no words is a group of its own; equal texts, and texts of equal words, are
    one group; rows with the same id are looked at one by one, and each carries its own group; an empty table gives no rows;
    other columns are ignored.
    """
    signatures = stored(signed(docs, n, k, rows, doc_id, text), "signatures")
    nodes = signatures.filter(F.col("node").isNotNull())
    one_each = nodes.groupBy("node").agg(F.any_value("bands").alias("bands"))
    # A short hash stands for the node until the buckets of one are gone; if two nodes share it, both come back.
    short = F.xxhash64("node").alias("short")
    buckets = one_each.select(short, F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = nodes.select(short, "node", "n_units").distinct()
    met = stored(buckets.join(shared, "bucket").join(sizes, "short").drop("short"), "buckets")
    scores = met.groupBy("node").agg(F.sum("n").alias("score"))
    members = stored(met.drop("n").join(scores, "node"), "members")

    # One document for each node in a bucket; rows that repeat its id are harmless.
    holders = scores.select("node").join(nodes.groupBy("node").agg(F.min("doc_id").alias("id")), "node")
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = plain.join(holders.select("id").distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    units = stored(unit_rows(held, n), "units")

    label = F.coalesce("component", "node")
    best = F.max(F.struct("score", "node", "n_units")).alias("best")
    hubs = members.groupBy("bucket").agg(best).select("bucket", F.col("best.score").alias("hub_score"), F.col("best.node").alias("hub"), F.col("best.n_units").alias("hub_units"))
    met = stored(members.join(hubs, "bucket"), "members")
    pairs = (
        met.filter((F.col("node") != F.col("hub")) & _near_sizes(F.col("n_units"), F.col("hub_units"), percent))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    links = stored(verified(pairs, units, percent), "links")
    groups = components(links)

    homes = met.groupBy("node").agg(F.max(F.struct("hub_score", "hub")).alias("home")).select("node", F.col("home.hub").alias("home"))
    labelled = met.select("bucket", "node", "n_units").join(homes, "node").join(groups, "node", "left")
    labelled = labelled.select("bucket", "node", "n_units", "home", label.alias("component"))
    torn = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    apart = stored(labelled.join(torn.filter("low <> high").select("bucket"), "bucket"), "apart")
    # Members of different homes: pairs where a bucket has few for its size, each with a member outside its largest home; else tiles.
    of_home = apart.groupBy("bucket", "home").agg(F.count("*").alias("h"))
    mixed = of_home.groupBy("bucket").agg(
        F.sum("h").alias("n"), F.sum(F.col("h") * F.col("h")).alias("hh"), F.max(F.struct("h", "home")).alias("top")
    )
    mixed = mixed.withColumn("pairs", (F.col("n") * F.col("n") - F.col("hh")) / 2).filter("pairs > 0")
    mixed = stored(mixed.select("bucket", F.col("top.home").alias("main"), (F.col("pairs") > PAIRS_EACH * F.col("n")).alias("wide")), "mixed")
    few = apart.join(mixed.filter("not wide").select("bucket", "main"), "bucket")
    wide = mixed.filter("wide").select("bucket")
    x, y = few.filter(F.col("home") != F.col("main")).alias("x"), few.alias("y")
    crossing = (
        x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.home") != F.col("y.home")) & _near_sizes(F.col("x.n_units"), F.col("y.n_units"), percent))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )
    more = _tiled(apart.select("home", "node", "component", "n_units").distinct(), units, percent)
    if wide.limit(1).count():
        crowd = apart.join(wide, "bucket", "left_semi").select(F.col("bucket").alias("home"), "node", "component", "n_units")
        more = more.unionByName(_tiled(crowd.distinct(), units, percent))
    more = stored(verified(crossing, units, percent).unionByName(more), "links")
    if more.limit(1).count():
        groups = components(links.unionByName(more))

    grouped = nodes.select("doc_id", "node").join(groups, "node", "left").withColumn("component", label)
    heads = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    rows_out = grouped.join(heads, "component").select("doc_id", "component_id")
    alone = signatures.filter(F.col("node").isNull()).select("doc_id", F.col("doc_id").alias("component_id"))
    return rows_out.unionByName(alone).select(
        "doc_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _tiled(homes: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes (home, node, component, n_units) of one home, as a spanning forest of each tile.

    Nodes outside their home's largest component visit all nodes of the home; both are dealt into blocks of a bounded number of
    nodes and of units (a block of one text has that text's units).
    """
    homes = stored(homes, "homes")
    sizes = homes.groupBy("home", "component").agg(F.count("*").alias("n"), F.sum("n_units").alias("units"))
    largest = sizes.groupBy("home").agg(
        F.max(F.struct("n", "component", "units")).alias("top"), F.sum("n").alias("members"), F.sum("units").alias("units")
    )
    largest = largest.withColumn("visitors", F.col("members") - F.col("top.n")).filter("visitors > 0")

    def blocks(rows: str, units):
        return F.ceil(F.greatest(F.col(rows) / TILE, units / TILE_UNITS)).cast("int")

    grid = largest.select(
        "home",
        F.col("top.component").alias("main"),
        blocks("members", F.col("units")).alias("m_blocks"),
        blocks("visitors", F.col("units") - F.col("top.units")).alias("v_blocks"),
    )
    placed = homes.join(grid, "home")
    spread = F.xxhash64("node")

    def block(blocks: str):
        return F.pmod(spread, F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    row = ["home", "m_block", "v_block", "visitor", "node"]
    inside = placed.withColumns({"m_block": block("m_blocks"), "visitor": F.lit(False)}).withColumn("v_block", every("v_blocks"))
    guests = placed.filter(F.col("component") != F.col("main"))
    guests = guests.withColumns({"v_block": block("v_blocks"), "visitor": F.lit(True)}).withColumn("m_block", every("m_blocks"))
    rows = inside.select(row).unionByName(guests.select(row)).join(units, "node")
    return rows.groupBy("home", "m_block", "v_block").applyInArrow(lambda t: _linked_tile(t, percent), "a binary, b binary")


def _linked_tile(table: pa.Table, percent: int) -> pa.Table:
    nodes, visitor = table.column("node").to_pylist(), np.array(table.column("visitor").to_pylist(), bool)
    sets = [_unpacked(x) for x in table.column("units").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Units that only one node has can't be shared; the others are counted in blocks of columns.
    shared = np.bincount(place, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    kept = shared[place]
    row, at = owner[kept], column[place[kept]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    query, member = np.flatnonzero(visitor), np.flatnonzero(~visitor)
    both = np.zeros((len(query), len(member)), np.int64)
    for low in range(0, int(shared.sum()), COLUMNS):
        part = slice(*np.searchsorted(at, [low, low + COLUMNS]))
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[row[part], at[part] - low] = 1
        both += np.rint(matrix[query] @ matrix[member].T).astype(np.int64)
    together = sizes[query][:, None] + sizes[member][None, :] - both
    head = {node: node for node in nodes}

    def root(x):
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    edges = []
    for i, j in zip(*np.nonzero(both * 100 >= percent * together)):
        a, b = root(nodes[query[i]]), root(nodes[member[j]])
        if a != b:
            head[max(a, b)] = min(a, b)
            edges.append((nodes[query[i]], nodes[member[j]]))
    columns = list(zip(*edges)) or [[], []]
    return pa.table([pa.array(c, pa.binary()) for c in columns], ["a", "b"])


def _near_sizes(x, y, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent
