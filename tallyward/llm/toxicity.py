"""Toxicity by a convolutional text classifier over hashed words, trained in numpy.

A word's embedding is the sum of the rows of its hash buckets: of the whole word and of its beginnings, so that forms
of a word that training has not met share what they have in common. Filters of several widths run over the text, the
largest answer of each goes to a logistic output. Embeddings start at zero, so an unknown bucket says nothing.

Training takes every labelled row outside the held-out part. The rows are dealt by a hash over groups of some
``group_words`` words; in each round every group goes on from the shared model in a task of its own, and each number of the
model then moves by the mean of the groups that moved it. The driver sees the model alone. A fifth of the labelled rows that
training does not see calibrates one threshold per language; language is never an input of a score.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import bounded_broadcast, small_batches, stored
from tallyward.llm.textwords import hashed_prefixes, text_parts

_U = np.uint64
BUCKETS = 1 << 20
WIDTHS = (1, 2, 3)
#: Lengths in bytes of the beginnings of words that have buckets of their own.
PREFIXES = (4, 5, 6, 7, 8, 9)
PAD = max(WIDTHS) - 1
#: Groups are dealt by bytes of text.
_BYTES_PER_WORD = 7
#: The model is averaged in so many tasks.
_SLICES = 64


@dataclass
class Model:
    row_of: np.ndarray  # bucket -> row of the embedding; row 0 says nothing
    embedding: np.ndarray
    kernels: list[np.ndarray]  # by width: places x dimensions x filters
    weights: np.ndarray
    bias: float
    thresholds: dict[str | None, float]  # by language; None: all languages together

    def scores(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        words = _embedded(self.embedding, rows)
        pooled = [np.maximum.reduceat(_answers(words, kernel), starts, axis=0) for kernel in self.kernels]
        return _sigmoid(np.concatenate(pooled, axis=1) @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _embedded(embedding: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = embedding[rows[:, 0]]
    for i in range(1, rows.shape[1]):
        out += embedding[rows[:, i]]
    return out


def _answers(words: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """The filters' answers at each place of embedded words, which end with padding."""
    n = len(words)
    out = words @ kernel[0]
    for k in range(1, len(kernel)):
        out[: n - k] += words[k:] @ kernel[k]
    return out


def _padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of several texts, each followed by padding (row 0), and where each text starts."""
    n_texts = len(first) - 1
    starts = first[:-1] + PAD * np.arange(n_texts)
    out = np.zeros((len(rows) + PAD * n_texts, rows.shape[1]), rows.dtype)
    out[np.arange(len(rows)) + np.repeat(PAD * np.arange(n_texts), np.diff(first))] = rows
    return out, starts


def word_buckets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for a, b, data, offsets in text_parts(texts):
        yield a, b, *hashed_prefixes(data, offsets, PREFIXES, BUCKETS)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training must not see: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _marks(labels: DataFrame) -> DataFrame:
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """first, second (hashes that order the rows), lang, toxic and text of all labelled documents outside the held-out part."""
    marks = bounded_broadcast(_marks(labels), 500_000)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    order = [F.xxhash64("doc_id").alias("first"), F.xxhash64("doc_id", "text").alias("second")]
    rows = docs.filter(F.octet_length("text") > 0).select("doc_id", lang.alias("lang"), "text").join(marks, "doc_id")
    return rows.select(*order, "lang", "toxic", "text")


def _common_buckets(rows: DataFrame, least_texts: int, max_rows: int) -> np.ndarray:
    """The buckets of at least ``least_texts`` texts, the most frequent ``max_rows`` - 1 of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, buckets, first in word_buckets(batch.column(0)):
                for low, high in zip(first[:-1], first[1:]):
                    seen[np.unique(buckets[low:high])] += 1
        seen[0] = 0
        there = np.flatnonzero(seen)
        for low in range(0, len(there), 50_000):
            part = there[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], ["bucket", "n"])

    totals = rows.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = totals.filter(F.col("n") >= least_texts).orderBy(F.desc("n"), "bucket").limit(max_rows - 1)
    return np.array([r["bucket"] for r in found.select("bucket").collect()], np.int64)


def _grouped(docs: DataFrame, labels: DataFrame, group_words: int) -> DataFrame:
    """The labelled rows with ``part``, their group, written so that the rows of a group follow one another in their order."""
    sizes = docs.select("doc_id", F.octet_length("text").alias("size")).join(_marks(labels), "doc_id", "left_semi")
    size = sizes.agg(F.sum("size")).first()[0] or 0
    n_groups = max(1, round(size / (_BYTES_PER_WORD * group_words)))
    rows = labelled(docs, labels).withColumn("part", F.pmod("second", F.lit(n_groups)).cast("int"))
    rows = rows.repartition(n_groups, "part").dropDuplicates(["part", "first", "second"])
    return stored(rows.sortWithinPartitions("part", "first", "second"), "labelled")


@dataclass
class _State:
    """What training changes: the embedding, the kernels, the weights, the bias, and the sums of squared steps."""

    embedding: np.ndarray
    kernels: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray
    squares: list[np.ndarray]

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, self.weights, self.bias, *self.squares]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def moved(self, by: np.ndarray) -> None:
        low = 0
        for a in self.arrays():
            a += by[low : low + a.size].reshape(a.shape)
            low += a.size


def _pass(state: _State, texts: list[np.ndarray], labels: np.ndarray, rate: float, rng, batch: int) -> None:
    """One pass of a group over its texts."""
    embedding, kernels, weights, squares = state.embedding, state.kernels, state.weights, state.squares
    dim, filters = kernels[0].shape[1:]
    turn = rng.permutation(len(texts))
    for low in range(0, len(texts), batch):
        part = turn[low : low + batch]
        first = np.r_[0, np.cumsum([len(texts[i]) for i in part])]
        rows_in, starts = _padded(np.concatenate([texts[i] for i in part]), first)
        ends = np.r_[starts[1:], len(rows_in)]
        words = _embedded(embedding, rows_in)
        pooled, places = [], []
        for kernel in kernels:
            answers = _answers(words, kernel)
            where = np.stack([a + answers[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            places.append(where)
            pooled.append(answers[where, np.arange(filters)])
        features = np.concatenate(pooled, axis=1)
        wrong = ((_sigmoid(features @ weights + state.bias) - labels[part]) / len(part)).astype(np.float32)
        to_features = wrong[:, None] * weights[None, :]
        step = features.T @ wrong
        squares[-1] += step * step
        weights -= rate * step / np.sqrt(squares[-1])
        state.bias -= np.float32(0.3) * wrong.sum()
        changed = np.zeros_like(embedding)
        for i, (kernel, where) in enumerate(zip(kernels, places)):
            flow = to_features[:, i * filters : (i + 1) * filters]
            step = np.zeros_like(kernel)
            for k in range(len(kernel)):
                at = np.minimum(where + k, len(rows_in) - 1)  # the last place is padding
                step[k] = np.einsum("df,dfe->ef", flow, words[at])
                back = flow[:, :, None] * kernel[k].T[None]
                for column in range(rows_in.shape[1]):
                    np.add.at(changed, rows_in[at, column].ravel(), back.reshape(-1, dim))
            squares[i + 1] += step * step
            kernel -= rate * step / np.sqrt(squares[i + 1])
        changed[0] = 0  # padding and unknown words stay at zero
        squares[0] += (changed * changed).mean(axis=1)
        embedding -= rate * changed / np.sqrt(squares[0])[:, None]


def _round(rows: DataFrame, row_of, state: _State, epoch: int, batch: int) -> np.ndarray:
    """How far a pass of every group moves the model: per number the mean of the groups that moved it."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(state)

    def moved(part: int, own: _State) -> pa.RecordBatch:
        moves = [m.tobytes() for m in np.array_split(own.flat() - shared.value.flat(), _SLICES)]
        columns = [pa.array([part] * _SLICES, pa.int32()), pa.array(range(_SLICES), pa.int32()), pa.array(moves, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["part", "slice", "moves"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, rng = None, None, None
        for held in batches:
            parts = held.column(0).to_numpy()
            cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True])
            for low, high in zip(cuts[:-1], cuts[1:]):
                part = int(parts[low])
                if part != now:
                    if own is not None:
                        yield moved(now, own)
                    now, own, rng = part, copy.deepcopy(shared.value), np.random.default_rng([7, epoch, part])
                labels = held.column(1).slice(low, high - low).to_numpy().astype(np.float32)
                for a, b, buckets, first in word_buckets(held.column(2).slice(low, high - low)):
                    texts = [row_of.value[buckets[i:j]] for i, j in zip(first[:-1], first[1:])]
                    known = np.flatnonzero(np.diff(first))
                    _pass(own, [texts[i] for i in known], labels[a:b][known], 0.15 / (1 + epoch), rng, batch)
        if own is not None:
            yield moved(now, own)

    def mean(table: pa.Table) -> pa.Table:
        total, n = 0.0, 0
        for _, moves in sorted(zip(table["part"].to_pylist(), table["moves"].to_pylist())):
            move = np.frombuffer(moves, np.float32)
            total, n = total + move.astype(np.float64), n + (move != 0)
        means = (total / np.maximum(n, 1)).astype(np.float32).tobytes()
        return pa.table([table["slice"][:1].combine_chunks(), pa.array([means], pa.binary())], names=["slice", "moves"])

    moves = rows.select("part", "toxic", "text").mapInArrow(passed, "part int, slice int, moves binary")
    found = moves.groupBy("slice").applyInArrow(mean, "slice int, moves binary").collect()
    shared.destroy()
    return np.concatenate([np.frombuffer(bytes(r["moves"]), np.float32) for r in sorted(found, key=lambda r: r["slice"])])


def train(
    docs: DataFrame,
    labels: DataFrame,
    dim: int = 8,
    filters: int = 8,
    epochs: int = 5,
    batch: int = 32,
    least_texts: int = 4,
    max_rows: int = 60_000,
    calibration: int = 5,
    group_words: int = 1_500_000,
) -> Model:
    """Fits the classifier on all labelled rows; without both labels every score is the labels' mean.

    One row in ``calibration`` is kept back for the thresholds.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = _grouped(docs, labels, group_words)
    kept_back = F.pmod(F.xxhash64("second"), F.lit(calibration)) == 0
    fit = rows.filter(~kept_back)
    n, toxic = fit.agg(F.count("*"), F.sum("toxic")).first()
    rng = np.random.default_rng(7)
    both = bool(n) and 0 < toxic < n
    common = _common_buckets(fit, least_texts, max_rows) if both else np.empty(0, np.int64)
    row_of = np.zeros(BUCKETS, np.uint16)
    row_of[common] = np.arange(1, len(common) + 1)
    mean = float(np.clip(toxic / n, 1e-3, 1 - 1e-3)) if n else 0.0
    bias = np.full(1, np.log(mean / (1 - mean)) if n else -5.0, np.float32)
    embedding = np.zeros((len(common) + 1, dim), np.float32)
    kernels = [rng.normal(0, 0.5, (w, dim, filters)).astype(np.float32) for w in WIDTHS]
    weights = rng.normal(0, 0.5, filters * len(WIDTHS)).astype(np.float32)
    squares = [np.full(len(embedding), 1e-4, np.float32), *[np.full_like(k, 1e-4) for k in kernels], np.full_like(weights, 1e-4)]
    state = _State(embedding, kernels, weights, bias, squares)
    if both:
        shared = spark.sparkContext.broadcast(row_of)
        for epoch in range(epochs):
            state.moved(_round(fit, shared, state, epoch, batch))
    model = Model(row_of, state.embedding, state.kernels, state.weights, float(state.bias[0]), {None: 0.5})
    model.thresholds = _thresholds(rows.filter(kept_back), model)
    return model


def _thresholds(rows: DataFrame, model: Model, least_toxic: int = 20, steps: int = 10_000) -> dict[str | None, float]:
    """The threshold of the best F1 per language; languages with few toxic rows take that of all together.

    Rows are counted by language and score in ``steps`` steps; a threshold is the least score of a step.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buckets, first in word_buckets(batch.column(2)):
                scores = shared.value.scores(*_padded(shared.value.row_of[buckets], first)).astype(np.float64)
                columns = [*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "toxic", "score"])

    found = rows.select(F.col("lang").cast("string"), "toxic", "text").mapInArrow(score, "lang string, toxic int, score double")
    step = F.floor(F.col("score") * steps).alias("step")
    counts = found.groupBy("lang", step).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.min("score").alias("least"))
    held: dict[str | None, list[tuple]] = {}
    for r in counts.collect():  # at most `steps` rows a language
        held.setdefault(str(r["lang"]), []).append((r["least"], r["n"], r["toxic"]))
    held[None] = [x for part in held.values() for x in part]

    def best(part: list[tuple]) -> float:
        least, n, toxic = (np.array(x) for x in zip(*sorted(part, reverse=True)))
        return float(least[int(np.argmax(2 * np.cumsum(toxic) / (np.cumsum(n) + toxic.sum())))])

    out = {lang: best(part) for lang, part in held.items() if sum(x[2] for x in part) >= least_toxic}
    return {None: 0.5} | out


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and flagged (by the language's threshold) of every document.

    Defined results: a NULL or empty text is scored as one that says nothing; equal texts get equal scores; rows with
    the same id are scored one by one; a missing or unknown language takes the common threshold; an empty table gives no
    rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_rows rows and BUCKETS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, buckets, first in word_buckets(batch.column(2)):
                scores = model.scores(*_padded(model.row_of[buckets], first)).astype(np.float64)
                ids, marks = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                langs = batch.column(3).slice(a, b - a).to_pylist()
                limits = np.array([model.thresholds.get(x, model.thresholds[None]) for x in langs])
                columns = [ids, marks, pa.array(scores), pa.array(scores >= limits)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "flagged"])

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text), lang).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, flagged boolean"
    )


def toxicity(docs: DataFrame, labels: DataFrame, group_words: int = 1_500_000) -> DataFrame:
    """Trains on all labelled rows and scores all documents (see ``scored``)."""
    return scored(docs, train(docs, labels, group_words=group_words))


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    least: float | None = None,
    group_words: int = 1_500_000,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not toxic; trained as in ``toxicity``.

    A row is toxic if its score reaches the calibrated threshold of its language, or ``least`` where that is given.
    """
    model = train(docs, labels, group_words=group_words)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    lang = docs.columns.index("lang") if "lang" in docs.columns else None

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, buckets, first in word_buckets(batch.column(at)):
                scores = model.scores(*_padded(model.row_of[buckets], first))
                part = batch.slice(a, b - a)
                if least is not None:
                    limits = least
                else:
                    names = [None] * len(part) if lang is None else part.column(lang).to_pylist()
                    limits = np.array([model.thresholds.get(str(x), model.thresholds[None]) for x in names])
                yield part.filter(pa.array(scores < limits))

    return docs.mapInArrow(keep, docs.schema)
