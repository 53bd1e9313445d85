"""The language of texts by a convolutional network over bytes, trained in numpy.

A byte has an embedding; filters of several widths run over a window of fixed length, the largest answer of each (zero at
least) goes to a softmax over the languages. A text is cut into overlapping windows so that each of its byte runs is inside
one; its answer is the mean of its windows' log-probabilities, weighted by their bytes.

Training takes a bounded sample of labelled texts per language (parameters) on the driver; prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import small_batches
from tallyward.llm.textwords import text_parts
from tallyward.llm.toxicity import held_out

#: Bytes of a window, filter widths, filters of each width, numbers of an embedding.
WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4, 5), 16, 8
#: Neighbouring windows share what the widest filter needs.
STRIDE = WINDOW - max(WIDTHS) + 1
#: The symbol behind the end of a text; its embedding stays zero.
PAD = 256
#: Letters A-Z count as a-z.
_LOWER = np.arange(256, dtype=np.int16)
_LOWER[65:91] += 32
#: Windows that are computed together.
TOGETHER = 128


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and number of bytes of each window of several texts, and each text's first window (one more at the end).

    Every text has a window, an empty one an empty window.
    """
    sizes = np.diff(offsets)
    counts = 1 + np.maximum(sizes - WINDOW + STRIDE - 1, 0) // STRIDE
    first = np.r_[0, np.cumsum(counts)]
    inside = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    starts = np.repeat(offsets[:-1], counts) + inside * STRIDE
    return starts, np.minimum(np.repeat(offsets[1:], counts) - starts, WINDOW), first


def symbols(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of windows as rows of WINDOW symbols, padded."""
    place = np.arange(WINDOW)
    at = np.minimum(starts[:, None] + place, max(len(data) - 1, 0))
    found = _LOWER[data[at]] if len(data) else np.full(at.shape, PAD, np.int16)
    found[place >= sizes[:, None]] = PAD
    return found


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # symbols x numbers
    kernel: np.ndarray  # (widest x numbers) x all filters; narrower filters have zeros behind
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def patches(self, rows: np.ndarray) -> np.ndarray:
        """For each window and place, the embedded symbols that a filter sees there."""
        widest = max(WIDTHS)
        padded = np.concatenate([rows, np.full((len(rows), widest - 1), PAD, rows.dtype)], axis=1)
        seen = self.embedding[padded]
        out = np.empty((len(rows), WINDOW, widest * DIM), np.float32)
        for k in range(widest):
            out[:, :, k * DIM : (k + 1) * DIM] = seen[:, k : k + WINDOW]
        return out

    def answers(self, rows: np.ndarray) -> np.ndarray:
        """Log-probabilities of the languages for each window."""
        out = np.empty((len(rows), len(self.languages)), np.float64)
        for low in range(0, len(rows), TOGETHER):
            seen = self.patches(rows[low : low + TOGETHER])
            held = (seen.reshape(-1, seen.shape[2]) @ self.kernel).reshape(len(seen), WINDOW, -1).max(axis=1)
            out[low : low + TOGETHER] = log_softmax(np.maximum(held + self.bias, 0.0) @ self.weights + self.offsets)
        return out

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each text."""
        starts, sizes, first = windows(data, offsets)
        sums = np.zeros((len(offsets) - 1, len(self.languages)))
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        for low in range(0, len(starts), 8 * TOGETHER):
            part = slice(low, low + 8 * TOGETHER)
            found = self.answers(symbols(data, starts[part], sizes[part]))
            np.add.at(sums, text[part], found * np.maximum(sizes[part], 1)[:, None])
        means = sums / np.add.reduceat(np.maximum(sizes, 1), first[:-1])[:, None]
        return np.exp(log_softmax(means))


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def training_windows(
    docs: DataFrame, per_language: int, per_text: int, most_languages: int, doc_id: str, text: str, lang: str
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, and windows of a sample of labelled texts with the number of their language.

    For each of the ``most_languages`` most frequent languages, ``per_language`` labelled different texts outside the held-out part, those
    of the smallest hashes, and of each at most ``per_text`` windows, spread over the whole of it. Only these windows reach the driver.
    """
    named = docs.select(
        F.col(text).alias("text"), F.xxhash64(text).alias("hash"), F.col(lang).cast("string").alias("lang"), held_out(doc_id).alias("out")
    )
    named = named.filter(F.col("lang").isNotNull() & ~F.col("out") & F.col("text").rlike(r"\p{L}"))
    sizes = named.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("hash").alias("texts"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    languages = sorted(r["lang"] for r in sizes)
    # The smallest hashes are sought among about twice as many as are wanted, not among all.
    top = [(r["lang"], min(2**63 - 1, int(2**64 * 2 * per_language / max(r["texts"], 1)) - 2**63)) for r in sizes]
    near = named.join(F.broadcast(docs.sparkSession.createDataFrame(top, "lang string, top long")), "lang").filter("hash <= top")
    hashes = near.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    last = hashes.withColumn("rank", rank).filter(F.col("rank") <= per_language).groupBy("lang").agg(F.max("hash").alias("last"))
    drawn = named.join(F.broadcast(last), "lang").filter("hash <= last").dropDuplicates(["lang", "hash"])
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column(1)):
                starts, sizes, first = windows(data, offsets)
                counts = np.minimum(np.diff(first), per_text)
                places = [i + np.arange(n) * (j - i) // n for i, j, n in zip(first[:-1], first[1:], counts)]
                at = np.concatenate(places)
                rows = symbols(data, starts[at], sizes[at])
                marks = batch.column(0).slice(a, b - a).take(pa.array(np.repeat(np.arange(b - a), counts)))
                yield pa.RecordBatch.from_arrays([marks, pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "symbols"])

    found = drawn.select("lang", "text").mapInArrow(cut, "lang string, symbols binary").toArrow()
    rows = np.frombuffer(b"".join(found.column("symbols").to_pylist()), np.int16).reshape(-1, WINDOW)
    number = {name: i for i, name in enumerate(languages)}
    marks = np.array([number[x] for x in found.column("lang").to_pylist()], np.int64)
    order = sorted(range(len(rows)), key=lambda i: (marks[i], rows[i].tobytes()))  # whatever order the tasks ended in
    return languages, rows[order], marks[order]


def _width_mask() -> np.ndarray:
    widest = max(WIDTHS)
    mask = np.zeros((widest, DIM, len(WIDTHS), FILTERS), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i] = 1
    return mask.reshape(widest * DIM, -1)


def train(
    languages: list[str],
    rows: np.ndarray,
    marks: np.ndarray,
    epochs: int = 4,
    least_steps: int = 300,
    batch: int = 64,
    rate: float = 4e-3,
) -> Network:
    """Fits the network by Adam on softmax loss, in ``epochs`` or as many as make ``least_steps``; each language weighs alike."""
    rng = np.random.default_rng(11)
    mask = _width_mask()
    scale = np.sqrt(2.0 / mask.sum(axis=0))
    embedding = rng.normal(0, 1, (PAD + 1, DIM)).astype(np.float32)
    embedding[PAD] = 0
    kernel = (rng.normal(0, 1, mask.shape) * scale * mask).astype(np.float32)
    net = Network(
        languages,
        embedding,
        kernel,
        np.zeros(mask.shape[1], np.float32),
        rng.normal(0, 0.1, (mask.shape[1], len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    counts = np.bincount(marks, minlength=len(languages))
    weight = (len(marks) / (len(languages) * np.maximum(counts, 1)))[marks].astype(np.float32)
    values = [net.embedding, net.kernel, net.bias, net.weights, net.offsets]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    steps = 0
    passes = max(epochs, -(-least_steps * batch // max(len(rows), 1)))
    for _ in range(passes if len(languages) > 1 else 0):
        order = rng.permutation(len(rows))
        for low in range(0, len(rows), batch):
            part = order[low : low + batch]
            seen = net.patches(rows[part])
            answers = (seen.reshape(-1, seen.shape[2]) @ net.kernel).reshape(len(part), WINDOW, -1)
            where = answers.argmax(axis=1)
            n, filters = where.shape
            raw = np.take_along_axis(answers, where[:, None], axis=1)[:, 0] + net.bias
            features = np.maximum(raw, 0)
            wrong = np.exp(log_softmax((features @ net.weights + net.offsets).astype(np.float64))).astype(np.float32)
            wrong[np.arange(n), marks[part]] -= 1
            wrong *= weight[part][:, None] / n
            flow = (wrong @ net.weights.T) * (raw > 0)
            at = seen[np.arange(n)[:, None], where]  # window x filter x patch
            to_kernel = np.einsum("nf,nfp->pf", flow, at) * mask
            back = (flow[:, :, None] * net.kernel.T[None]).reshape(n, filters, max(WIDTHS), DIM)
            padded = np.concatenate([rows[part], np.full((n, max(WIDTHS) - 1), PAD, rows.dtype)], axis=1)
            to_embedding = np.zeros_like(net.embedding)
            for k in range(max(WIDTHS)):
                np.add.at(to_embedding, padded[np.arange(n)[:, None], where + k], back[:, :, k])
            to_embedding[PAD] = 0
            steps += 1
            slopes = [to_embedding, to_kernel, flow.sum(axis=0), features.T @ wrong, wrong.sum(axis=0)]
            for value, slope, (m, v) in zip(values, slopes, moments):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                value -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
            net.kernel *= mask
    return net


def languages(
    docs: DataFrame,
    per_language: int = 1_000,
    per_text: int = 8,
    most_languages: int = 200,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred and score (its probability) of every document, by a network trained on the labelled ones.

    Defined results: a NULL text and one without a letter are ``und`` with score 0, as all texts are where nothing was learned
    (no labelled text outside the held-out part); with a single language learned, every other text has it with score 1. Equal texts
    have equal results; rows with the same id are predicted one by one; an empty table gives no rows; other columns are ignored.
    """
    names, rows, marks = training_windows(docs, per_language, per_text, most_languages, doc_id, text, lang)
    network = train(names, rows, marks)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some 10,000 numbers and the languages' names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        known = pa.array([*network.languages, "und"], pa.string())
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column(2)):
                here = batch.slice(a, b - a)
                best, score = np.full(b - a, len(known) - 1), np.zeros(b - a)
                lettered = np.flatnonzero(here.column(3).fill_null(False).to_numpy(zero_copy_only=False))
                if network.languages and len(lettered):
                    found = network.texts(data, offsets)[lettered]
                    best[lettered], score[lettered] = found.argmax(axis=1), found.max(axis=1)
                columns = [here.column(0), here.column(1), known.take(pa.array(best)), pa.array(np.minimum(score, 1.0))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    lettered = F.col(text).rlike(r"\p{L}").alias("lettered")
    return docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text), lettered).mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
