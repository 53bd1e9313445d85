"""k-means of integer vectors with heap-ordered bounds; every assignment and centroid is exact.

For each vector the gap between its second-nearest and its nearest centroid is a bound: when centroids move, the gap of a vector of
cluster c shrinks by at most the drift of c plus the largest drift of another. That shrinkage is the same for the whole
cluster, so it is added up once per cluster (its offset), and a vector is filed under gap + offset at that time: its expiry.
It can change cluster only when the offset has reached the expiry, and then it is popped and compared with all centroids again.

A cluster's heap is a set of runs: each round writes the vectors it rescanned as Parquet, ordered by (cluster, expiry). As
offsets only grow, the entries to pop are those whose expiry lies between the last offset and the new one, a range that is
pushed down to the row groups' statistics; what lies below was popped before and lives on in a later run. Sums per cluster
change by the vectors that moved. A round therefore reads and writes what expired, shuffles k x dim sums, and holds no heap in memory.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import shared_folder

#: Components of this size and more could give squared distances beyond 64 bits.
MOST = 1 << 27
#: Bytes of a row group: the unit that a pop reads.
GROUP_BYTES = 4 << 20


def quantised(vectors: DataFrame, dim: int = 64, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and ``point``, the integers floor(scale * x) of the vectors that have ``dim`` components, all finite.

    Left out: vectors that are NULL, of another length or with NULL or non-finite components, and those with an integer beyond
    2^27 (squared distances would not fit 64 bits).
    """
    value = F.col(embedding)
    scaled = F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < MOST))
    kept = vectors.filter(F.coalesce((F.size(value) == dim) & fine, F.lit(False)))
    return kept.select(F.col(vec_id).alias("vec_id"), scaled.cast("array<int>").alias("point"))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` points (all, if fewer) with the smallest SHA-256 of ``seed:vec_id``; NULL ids come last, ties by the point."""
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("vec_id").cast("string")).cast("binary"), 256)
    drawn = points.orderBy(F.when(F.col("vec_id").isNotNull(), order).asc_nulls_last(), "point").limit(k)
    return np.array([r["point"] for r in drawn.select("point").collect()], np.int64)


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact in 64 bits."""
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _points(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _scanned(points: np.ndarray, centroids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (the smaller number of equally near ones) and the expiry of each point."""
    found = distances(points, centroids)
    nearest = found.argmin(axis=1)
    rows = np.arange(len(points))
    upper = np.sqrt(found[rows, nearest].astype(float))
    found = found.astype(float)
    found[rows, nearest] = np.inf
    lower = np.sqrt(found.min(axis=1))
    # Less what rounding can add; a gap of zero expires with the first drift.
    gap = np.where(np.isinf(lower), np.inf, lower - upper - 1e-6 - 1e-9 * (np.where(np.isinf(lower), 0, lower) + upper))
    return nearest, np.maximum(gap, 0.0) + offsets[nearest]


def _scan(centroids: np.ndarray, offsets: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, expiry = _scanned(_points(batch.column(1)), centroids, offsets)
            columns = [*batch.columns, pa.array(nearest, pa.int32()), pa.array(expiry)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "point", "was", "cluster", "expiry"])

    return scan


def _moved(k: int, dim: int):
    """Per task, what clusters gain and lose: (cluster, place, sum); place ``dim`` holds counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            points = np.column_stack([_points(batch.column(0)), np.ones(batch.num_rows, np.int64)])
            was = batch.column(1).fill_null(-1).to_numpy()
            np.add.at(sums, batch.column(2).to_numpy(), points)
            np.subtract.at(sums, was[was >= 0], points[was >= 0])
        cluster, place = np.nonzero(sums)
        columns = [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[cluster, place])]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "place", "sum"])

    return add


class _Runs:
    """The runs of all heaps, in one folder of the shared folder, and the offsets up to which each heap was popped."""

    def __init__(self, points: DataFrame, k: int) -> None:
        self.spark = points.sparkSession
        self.folder = f"{shared_folder(self.spark)}/tallyward-heaps-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.popped = np.zeros(k)
        kind = points.schema["vec_id"].dataType.simpleString()
        self.schema = f"vec_id {kind}, point array<int>, was int, cluster int, expiry double"

    def scanned(self, rows: DataFrame, centroids: np.ndarray, offsets: np.ndarray) -> DataFrame:
        """Compares (vec_id, point, was) with all centroids and adds them to the heaps as a new run."""
        path = f"{self.folder}/run-{len(self.paths)}"
        found = rows.mapInArrow(_scan(centroids, offsets), self.schema).sortWithinPartitions("cluster", "expiry")
        found.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
        self.paths.append(path)
        self.popped = offsets.copy()
        return self.spark.read.schema(self.schema).parquet(path)

    def _between(self, low: np.ndarray, high: np.ndarray) -> Column:
        chosen = F.lit(False)
        for c, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
            if a < b:
                expires = F.col("expiry")
                in_range = (expires >= a) if math.isinf(b) else (expires >= a) & (expires < b)
                chosen = chosen | ((F.col("cluster") == c) & in_range)
        return chosen

    def rows(self, offsets: np.ndarray | None = None) -> DataFrame:
        """The entries that expire before ``offsets``, or all that are still in the heaps."""
        high = np.full(len(self.popped), np.inf) if offsets is None else offsets
        found = self.spark.read.schema(self.schema).parquet(*self.paths)
        return found.filter(self._between(self.popped, high))


def clustered(points: DataFrame, centroids: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """vec_id, point and cluster of each row of ``points``, and the final centroids.

    Each round assigns every point to its nearest centroid (ties: the smaller number) and replaces each centroid that has
    points by the floor of their mean; then points are assigned once more. ``centroids`` must not be empty.
    """
    k, dim = centroids.shape
    offsets = np.zeros(k)
    runs = _Runs(points, k)
    fresh = points.select("vec_id", "point", F.lit(None).cast("int").alias("was"))
    new = runs.scanned(fresh, centroids, offsets)
    totals = [[0] * (dim + 1) for _ in range(k)]
    for _ in range(rounds):
        changed = new.filter("was is null or was <> cluster").select("point", "was", "cluster")
        changed = changed.mapInArrow(_moved(k, dim), "cluster int, place int, sum long")
        exact = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
        for r in changed.groupBy("cluster", "place").agg(exact).collect():  # at most k x (dim + 1) rows
            totals[r["cluster"]][r["place"]] += int(r["sum"])
        after = np.array(
            [[s // t[dim] for s in t[:dim]] if t[dim] else c.tolist() for t, c in zip(totals, centroids)], np.int64
        )
        drift = np.sqrt(((after - centroids) ** 2).sum(axis=1).astype(float)) * (1 + 1e-9)
        centroids = after
        if not drift.any():
            break
        others = np.array([max([0.0, *drift[:c], *drift[c + 1 :]]) for c in range(k)])
        offsets = (offsets + drift + others) * (1 + 1e-12)
        popped = runs.rows(offsets).select("vec_id", "point", F.col("cluster").alias("was"))
        new = runs.scanned(popped, centroids, offsets)
    return runs.rows().select("vec_id", "point", "cluster"), centroids


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, **columns) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia and inertia (distances summed over the cluster and
    over all), centroid (the integers of the final centroid).

    Defined results: vectors that ``quantised`` leaves out have no row; rows with the same id are vectors of their own; a vector
    without an id is assigned but no first centroid while others are left; with fewer than ``k`` vectors there are as many
    clusters; an empty table gives no rows; other columns are ignored.
    """
    points = quantised(vectors, **columns)
    start = first_centroids(points, k, seed)
    kind = points.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {kind}, cluster int, distance long"
    if len(start) == 0:
        none = "cluster_inertia long, inertia long, centroid array<long>"
        return vectors.sparkSession.createDataFrame([], f"{result}, {none}")
    found, centroids = clustered(points, start, rounds)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = centroids[batch.column(2).to_numpy()]
            far = ((_points(batch.column(1)) - own) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(far)], ["vec_id", "cluster", "distance"])

    rows = found.select("vec_id", "point", "cluster").mapInArrow(measure, result)
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()  # k rows
    inertia = {r["cluster"]: int(r["sum"]) for r in sums}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), x.tolist()) for c, x in enumerate(centroids)]
    known = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digests(found: DataFrame) -> DataFrame:
    """``centroid_clusters`` with centroid_sha256 (lowercase hex of the integers, comma-joined) instead of the centroid."""
    joined = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(joined.cast("binary"), 256)).drop("centroid")
