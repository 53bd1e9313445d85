"""Near-duplicate vectors of equal label by an inverted multi-index.

1. Index. Two codebooks, one for each half of the unit vectors, are fitted on a bounded sample; their product is a grid of
   cells, and every vector is filed in the cell of its two nearest codewords.
2. Search. Each vector visits cells in order of distance (multi-sequence traversal: a heap over the two sorted lists of
   codewords). How many is calibrated on neighbours planted at exactly the limit around a sample of vectors, the hardest
   links there can be, in random directions and towards other vectors: the smallest number that finds the share ``recall`` of them.
   The search itself then tells, over all links, how many it found late, in the second half of the visits only; where that is more
   than ``1 - recall`` of them, visits are doubled, up to all cells.
3. Verification. In each cell, members and visitors meet in tiles of a bounded size and are compared by cosine in
   double precision; a cell with many of either is many tiles.

Equal vectors are one node with a count. A tile gives sums of links and a spanning forest, never its pairs. A link found
from both ends is counted once: a tile knows which cells its members visit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import row_key, stored
from tallyward.llm.graph import components

#: Rows of a tile: members of a cell, and visitors.
MEMBERS, VISITORS = 128, 256
#: Vectors on which codebooks are fitted, and vectors that get planted neighbours, at most.
FIT_SAMPLE, CALIBRATION_SAMPLE = 20_000, 1_000
#: Planted neighbours of each kind (random direction, towards another vector) of a vector.
PLANTED = 2
#: Parts of a cell's rows while they learn how large their cell is.
SALTS = 32


def fit_codebook(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from different points spread over the sample; fewer codewords where there are fewer different points."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(3)
    words = points[rng.permutation(len(points))[:k]]
    for _ in range(rounds):
        nearest = _distances(points, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(words))
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], words)
    return words


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :]


def nearest_cells(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest cells of one vector, from its distances to the codewords of each half."""
    order1, order2 = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out = [(first[order1[0]] + second[order2[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < n:
        _, i, j = heapq.heappop(heap)
        out.append(order1[i] * len(second) + order2[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(first) and y < len(second) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[order1[x]] + second[order2[y]], x, y))
    return np.array(out, np.int64)


def _normed(points: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest number first, so that squares neither vanish nor overflow."""
    points = points / np.abs(points).max(axis=1)[:, None]
    return points / np.sqrt((points * points).sum(axis=1))[:, None]


def _units(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    return _normed(np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64))


class Index:
    """Two codebooks over unit vectors of ``dim`` numbers."""

    def __init__(self, sample: np.ndarray, k: int) -> None:
        self.half = max(1, sample.shape[1] // 2)
        self.books = [fit_codebook(sample[:, : self.half], k), fit_codebook(sample[:, self.half :], k)]

    def visits(self, units: np.ndarray, n: int) -> np.ndarray:
        first, second = _distances(units[:, : self.half], self.books[0]), _distances(units[:, self.half :], self.books[1])
        n = min(n, self.cells)
        return np.stack([nearest_cells(a, b, n) for a, b in zip(first, second)]) if len(units) else np.empty((0, n), np.int64)

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def ranks(self, units: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The visit at which each vector comes to the cell of its counterpart in ``others``."""
        own, other = [[_distances(x, book) for x, book in zip((u[:, : self.half], u[:, self.half :]), self.books)] for u in (units, others)]
        out = np.empty(len(units), np.int64)
        for row, (first, second) in enumerate(zip(*own)):
            far = first[other[0][row].argmin()] + second[other[1][row].argmin()]
            out[row] = max(1, np.searchsorted(np.sort(second), far - first, side="right").sum())
        return out


def _linked_tile(table: pa.Table, kind: str, dim: int, least: float) -> pa.Table:
    """Sums of links, of those found late among them, and a spanning forest of one tile."""
    visitor = np.array(table.column("visitor").to_pylist(), bool)
    units = _units(table.column("vector"), kind, dim)
    copies = np.array(table.column("copies").to_pylist(), np.int64)
    nodes = np.array(table.column("node").to_pylist(), object)
    cells = np.array(table.column("own").to_pylist(), np.int64)
    visits = pc.list_flatten(table.column("visits")).to_numpy().reshape(len(nodes), -1)
    member, query = np.flatnonzero(~visitor), np.flatnonzero(visitor)
    i, j = np.nonzero(units[query] @ units[member].T >= least)
    q, m = query[i], member[j]
    other = nodes[q] != nodes[m]
    q, m = q[other], m[other]
    back = visits[m] == cells[q][:, None]
    unseen = ~back.any(axis=1)  # the member does not visit the visitor's cell itself
    soon = visits.shape[1] - visits.shape[1] // 2
    late = ~(back[:, :soon].any(axis=1) | (visits[q, :soon] == cells[m][:, None]).any(axis=1))
    links, found_late = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    for sums, counted in ((links, np.ones(len(q), bool)), (found_late, late)):
        np.add.at(sums, q[counted], copies[m[counted]])
        np.add.at(sums, m[unseen & counted], copies[q[unseen & counted]])
    # A node may be here twice, as member and as visitor; its least row stands for it.
    names, row = np.unique(nodes.astype(str), return_inverse=True)
    group = np.arange(len(names))
    a, b = row[q], row[m]
    while len(a):
        low = np.minimum(group[a], group[b])
        before = group.copy()
        np.minimum.at(group, a, low)
        np.minimum.at(group, b, low)
        group = group[group]
        if (group == before).all():
            break
    total, total_late = (np.bincount(row, weights=x, minlength=len(names)).astype(np.int64) for x in (links, found_late))
    touched = np.unique(np.concatenate([a, b])) if len(a) else np.empty(0, np.int64)
    ends = [pa.array(x[touched].tolist(), pa.string()) for x in (names, names[group])]
    return pa.table([ends[0], pa.array(total[touched]), pa.array(total_late[touched]), ends[1]], ["node", "links", "late", "head"])


def near_vectors(
    vectors: DataFrame,
    least: float = 0.93,
    recall: float = 0.999,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (the smallest vec_id reachable), kept (it is that vector).

    Vectors link if their labels are equal and not NULL and their cosine is at least ``least``.

    Defined results: a vector that is NULL, empty, zero or holds NULL or non-finite numbers, or whose label is NULL, links with
    nothing; vectors of different lengths do not link; rows with the same id are vectors of their own with one id;
    an empty table gives no rows; other columns are ignored.
    """
    value = F.col(embedding)
    element = vectors.schema[embedding].dataType.elementType.simpleString()
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(value, lambda x: x != 0)
    fine = F.coalesce(F.col(label).isNotNull() & finite & nonzero, F.lit(False))
    base = vectors.select(
        F.col(vec_id).alias("vec_id"),
        F.when(fine, F.concat_ws("/", F.col(label).cast("string"), F.size(value))).alias("place"),
        F.when(fine, row_key(label, embedding)).alias("node"),
        F.when(fine, value).alias("embedding"),
    )
    found = _search(base.filter("node is not null"), least, recall, "f4" if element == "float" else "f8")
    ids = base.select("vec_id", "node")
    if found is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sums, groups, sizes = found
    joined = ids.join(sizes, "node", "left").join(sums, "node", "left").join(groups, "node", "left")
    component = F.coalesce("component", "node")
    joined = joined.select(
        "vec_id",
        component.alias("component"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )
    heads = joined.filter("component is not null").groupBy("component").agg(F.min("vec_id").alias("head"))
    return joined.join(heads, "component", "left").select(
        "vec_id",
        "n_links",
        F.coalesce("head", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("head", "vec_id")).alias("kept"),
    )


def _search(valid: DataFrame, least: float, recall: float, kind: str):
    """(links per node, components, copies per node), or None where there is no vector to search."""
    once = stored(
        valid.groupBy("node").agg(
            F.any_value("place").alias("place"), F.any_value("embedding").alias("embedding"), F.count("*").alias("copies")
        ),
        "nodes",
    )
    shapes = once.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).collect()  # one row per length
    if not shapes:
        return None
    found = None
    for dim, n in sorted((row["dim"], row["n"]) for row in shapes):
        tiles = _linked(once.filter(F.size("embedding") == dim), dim, n, least, recall, kind)
        found = tiles if found is None else found.unionByName(tiles)
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("head").alias("b")))
    return sums, groups, once.select("node", "copies")


def _chosen(df: DataFrame, n: int, most: int, salt: int) -> DataFrame:
    """About ``most`` rows (all, if there are no more), by a hash of the node."""
    share = min(1.0, most / max(n, 1))
    return df.filter(F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * most)


def _linked(once: DataFrame, dim: int, n: int, least: float, recall: float, kind: str) -> DataFrame:
    sample = np.array([r[0] for r in _chosen(once, n, FIT_SAMPLE, 1).select("embedding").collect()], np.float64)
    sample = sample.reshape(-1, dim)
    if len(sample) == 0:
        sample = np.array([r[0] for r in once.select("embedding").limit(1000).collect()], np.float64)
    sample = _normed(sample)
    index = Index(sample, int(min(1024, max(2, n**0.5 / 8))))
    if recall > 1:
        raise RuntimeError(f"all {index.cells} cells find every link, not a share of {recall}")
    visits = planted_visits(index, sample[:: -(-len(sample) // CALIBRATION_SAMPLE)], least, recall)
    while True:
        tiles = stored(_searched(once, dim, index, visits, least, kind), "tiles")
        links, late = tiles.agg(F.sum("links"), F.sum("late")).first()
        if visits == index.cells or (late or 0) <= (1 - recall) * (links or 0):
            return tiles
        visits = min(2 * visits, index.cells)


def planted_visits(index: Index, units: np.ndarray, least: float, recall: float) -> int:
    """The visits at which the share ``recall`` of neighbours planted at a cosine of ``least`` is found, from either side."""
    rng = np.random.default_rng(5)
    ranks = []
    for i in range(2 * PLANTED):
        towards = rng.normal(size=units.shape) if i % 2 else units[rng.permutation(len(units))]
        aside = towards - (towards * units).sum(axis=1)[:, None] * units
        length = np.sqrt((aside * aside).sum(axis=1))
        kept = length > 1e-6  # no direction towards an equal vector
        if kept.any():
            near = least * units[kept] + (1 - least**2) ** 0.5 * aside[kept] / length[kept][:, None]
            ranks.append(np.minimum(index.ranks(units[kept], near), index.ranks(near, units[kept])))
    if not ranks:
        return index.cells
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[min(len(ranks), int(np.ceil(recall * len(ranks)))) - 1])


def _searched(once: DataFrame, dim: int, index: Index, visits: int, least: float, kind: str) -> DataFrame:
    """Tiles of members and visitors of the cells, each with its sums and its forest (see ``_linked_tile``)."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(2).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
            found = index.visits(_normed(flat), visits)
            raw = flat.astype(kind)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array([x.tobytes() for x in raw], pa.binary()),
                batch.column(3),
                pa.array(found[:, 0]),
                pa.array(list(found), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "place", "vector", "copies", "own", "visits"])

    filed = stored(
        once.select("node", "place", "embedding", "copies").mapInArrow(
            file, "node string, place string, vector binary, copies long, own long, visits array<long>"
        ),
        "filed",
    )
    spread = F.xxhash64("node")
    going = filed.select("*", F.explode("visits").alias("cell"))
    members = filed.groupBy("place", F.col("own").alias("cell")).agg(F.count("*").alias("n_members"))
    visitors = going.groupBy("place", "cell").agg(F.count("*").alias("n_visitors"))
    # A cell is a grid of tiles: blocks of its members by blocks of its visitors. A cell may hold most rows, so its size is
    # told to its rows in parts.
    grid = stored(
        members.join(visitors, ["place", "cell"]).select(
            "place",
            "cell",
            F.ceil(F.col("n_members") / MEMBERS).cast("int").alias("m_blocks"),
            F.ceil(F.col("n_visitors") / VISITORS).cast("int").alias("v_blocks"),
        ),
        "grid",
    )
    parts = grid.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64(F.lit(29), "node"), F.lit(SALTS)).cast("int")

    def block(blocks: str):
        return F.pmod(spread, F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    row = ["place", "cell", "m_block", "v_block", "visitor", "node", "vector", "copies", "own", "visits"]
    at = ["place", "cell", "part"]
    inside = filed.withColumns({"cell": F.col("own"), "part": part}).join(parts, at)
    inside = inside.withColumns({"m_block": block("m_blocks"), "visitor": F.lit(False)}).withColumn("v_block", every("v_blocks"))
    guests = going.withColumn("part", part).join(parts, at)
    guests = guests.withColumns({"v_block": block("v_blocks"), "visitor": F.lit(True)}).withColumn("m_block", every("m_blocks"))
    return (
        inside.select(row)
        .unionByName(guests.select(row))
        .groupBy("place", "cell", "m_block", "v_block")
        .applyInArrow(lambda table: _linked_tile(table, kind, dim, least), "node string, links long, late long, head string")
    )
