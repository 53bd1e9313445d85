"""A keyed result table for ``foreachBatch``: one delta per micro-batch, folded into snapshots.

Rows belong to a part (an hour, a day, a bucket of keys). A batch writes its delta in overwrite mode, so a batch that is run
again replaces itself. Once a part has ``every`` deltas of earlier batches, they and its snapshot become a new snapshot and
are removed. A read of a part costs its keys and at most ``every`` deltas, however many batches there were.

Layout: ``batch=<n>/kind=<delta or snapshot-...>/<part>=<p>``; a folder counts once its write has finished. A snapshot of batch n
holds all batches up to n; it is only made of batches that Spark has committed, since it is made when a later one runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.streaming.sinks import BATCH, newest_groups, newest_rows

DELTA, SNAPSHOT = "delta", "snapshot"
_KIND = "kind"

Fold = Callable[[DataFrame], DataFrame]


def added_up(keys: Sequence[str], value: str) -> Fold:
    """Deltas are increments of ``value`` per key."""
    return lambda log: log.groupBy(*keys).agg(F.sum(value).alias(value))


def last_row(keys: Sequence[str]) -> Fold:
    """Deltas are new versions of keyed rows."""
    return lambda log: newest_rows(log, keys)


def last_group(by: Sequence[str]) -> Fold:
    """Deltas are new versions of whole groups."""
    return lambda log: newest_groups(log, by)


class KeyedTable:
    """``fold`` turns the rows of several batches (with ``batch_id``) into the current rows of ``schema``, ``part`` included."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str, fold: Fold, every: int = 8) -> None:
        self.spark, self.path, self.part, self.fold, self.every = spark, path.rstrip("/"), part, fold, every
        self.columns = spark.createDataFrame([], schema).columns
        self.schema = f"{schema}, batch int, {_KIND} string"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self, parts: Sequence | None, before: int | None) -> dict[str, list[tuple[int, str]]]:
        """By part the finished (batch, kind) folders of batches below ``before``."""
        names = "*" if parts is None else "{" + ",".join(str(p) for p in parts) + "}"
        found: dict[str, list[tuple[int, str]]] = {}
        finished: dict[str, bool] = {}
        for status in self._fs.globStatus(self._path(f"{self.path}/batch=*/{_KIND}=*/{self.part}={names}")) or []:
            folder = status.getPath()
            whole = folder.getParent().toString()
            if whole not in finished:
                finished[whole] = self._fs.exists(self._path(f"{whole}/_SUCCESS"))
            batch, kind, part = (x.split("=", 1)[1] for x in folder.toString().split("/")[-3:])
            if finished[whole] and (before is None or int(batch) < before):
                found.setdefault(part, []).append((int(batch), kind))
        return found

    @staticmethod
    def _current(folders: list[tuple[int, str]]) -> list[tuple[int, str]]:
        """The newest snapshot (two of one batch are equal) and the deltas after it."""
        newest = max((f for f in folders if f[1] != DELTA), default=(-1, ""))
        return [f for f in folders if f == newest or f[1] == DELTA and f[0] > newest[0]]

    def _rows(self, folders: dict[str, list[tuple[int, str]]]) -> DataFrame:
        paths = [
            f"{self.path}/batch={b}/{_KIND}={kind}/{self.part}={part}" for part, held in folders.items() for b, kind in self._current(held)
        ]
        if not paths:
            return self.fold(self.spark.createDataFrame([], self.schema).withColumnRenamed("batch", BATCH).drop(_KIND)).select(self.columns)
        log = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*sorted(paths))
        return self.fold(log.withColumnRenamed("batch", BATCH).drop(_KIND)).select(self.columns)

    def read(self, parts: Sequence | None = None, before: int | None = None) -> DataFrame:
        """The current rows of some parts, or of all; ``before`` leaves out that batch and later ones."""
        return self._rows(self._folders(parts, before) if parts is None or parts else {})

    def forget(self, before: int) -> None:
        """Removes the parts (whole numbers) below ``before``."""
        for status in self._fs.globStatus(self._path(f"{self.path}/batch=*/{_KIND}=*/{self.part}=*")) or []:
            if int(status.getPath().getName().split("=", 1)[1]) < before:
                self._fs.delete(status.getPath(), True)

    def put(self, rows: DataFrame, batch_id: int, parts: Sequence) -> None:
        """Adds the delta of a batch, whose rows lie in ``parts``; folds what earlier batches left there."""
        rows.select(self.columns).write.mode("overwrite").partitionBy(self.part).parquet(f"{self.path}/batch={batch_id}/{_KIND}={DELTA}")
        self.compact(parts, batch_id)

    def compact(self, parts: Sequence | None, before: int) -> None:
        """Folds parts with ``every`` deltas or more of batches below ``before``."""
        folders = self._folders(parts, before) if parts is None or parts else {}
        due = {p: held for p, held in folders.items() if sum(kind == DELTA for _, kind in self._current(held)) >= self.every}
        if not due:
            return
        last = max(b for held in due.values() for b, _ in held)
        target = f"{self.path}/batch={last}/{_KIND}={SNAPSHOT}-{uuid.uuid4().hex}"
        self._rows(due).write.partitionBy(self.part).parquet(target)
        for part, held in due.items():
            for b, kind in held:
                self._fs.delete(self._path(f"{self.path}/batch={b}/{_KIND}={kind}/{self.part}={part}"), True)
