"""Quality scores by a byte-level convolutional network in numpy.

A text's bytes are covered by overlapping chunks, to its end. Learned filters run
over each chunk; the strongest answer of each filter goes through a small dense
layer, and mean and maximum over the chunks are combined into one probability.
A filter over one-hot bytes is a table lookup per tap, so there is no embedding.

Training takes a bounded sample of labelled texts: ``MAX_TEXTS`` of each class,
picked by a hash of the id, and ``MAX_CHUNKS`` evenly spaced chunks of each. The
bias is then moved from the balanced sample to the classes' true shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from curate.llm.flat import bytes_of, slices

CHUNK = 256
STEP = 208
TAPS = 6
FILTERS = 16
HIDDEN = 12
MAX_TEXTS = 1200
MAX_CHUNKS = 16
EPOCHS = 12
BATCH_TEXTS = 48
RATE = 0.01
# Share of training texts shown as a short excerpt, as short texts are rare.
EXCERPTS = 0.2
_AT_ONCE = 512
# Text that a task scores at once.
SLICE_BYTES = 2 << 20


@dataclass
class Network:
    filters: np.ndarray  # taps, byte, filter
    filter_bias: np.ndarray
    dense: np.ndarray  # filter, hidden
    dense_bias: np.ndarray
    last: np.ndarray  # 2 * hidden: mean and maximum over chunks
    last_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        scale = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        return cls(
            scale(TAPS, 256, FILTERS, by=0.3), np.zeros(FILTERS, np.float32), scale(FILTERS, HIDDEN, by=0.3),
            np.zeros(HIDDEN, np.float32), scale(2 * HIDDEN, by=0.3), np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.filters, self.filter_bias, self.dense, self.dense_bias, self.last, self.last_bias]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Strongest answer of each filter in each chunk, and where it is."""
        width = chunks.shape[1] - TAPS + 1
        answer = self.filters[0][chunks[:, :width]]
        for tap in range(1, TAPS):
            answer += self.filters[tap][chunks[:, tap : tap + width]]
        where = answer.argmax(1)
        return np.take_along_axis(answer, where[:, None, :], 1)[:, 0], where

    def hidden(self, pooled: np.ndarray) -> np.ndarray:
        return np.tanh(np.maximum(pooled + self.filter_bias, 0) @ self.dense + self.dense_bias)

    def combine(self, hidden: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds per text, whose chunks start at ``first``; and the texts' features."""
        counts = np.diff(np.append(first, len(hidden)))[:, None]
        features = np.concatenate((np.add.reduceat(hidden, first) / counts, np.maximum.reduceat(hidden, first)), 1)
        return features @ self.last + self.last_bias[0], features

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of texts given as bytes in a row."""
        starts, ends, first = cover(offsets)
        hidden = [
            self.hidden(self.pooled(cut(data, starts[lo : lo + _AT_ONCE], ends[lo : lo + _AT_ONCE]))[0])
            for lo in range(0, len(starts), _AT_ONCE)
        ]
        return 1 / (1 + np.exp(-self.combine(np.concatenate(hidden), first)[0].astype(float)))


def cover(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks over each text to its last byte: where each starts, where its text ends,
    and each text's first chunk. An empty text has one chunk of padding."""
    sizes = np.diff(offsets)
    counts = 1 + np.maximum(0, -(-(sizes - CHUNK) // STEP))
    first = np.cumsum(counts) - counts
    number = np.arange(counts.sum()) - np.repeat(first, counts)
    return np.repeat(offsets[:-1], counts) + number * STEP, np.repeat(offsets[1:], counts), first


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    padded = data if len(data) else np.zeros(1, np.uint8)
    return np.where(inside, padded[np.minimum(at, len(padded) - 1)], 0).astype(np.uint8)


def fit(chunks: list[np.ndarray], labels: np.ndarray, share: float, seed: int = 0) -> Network:
    """Train on texts given as their chunks. ``share`` is that of label 1 among all
    labelled rows."""
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed + 1)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(chunks))
        for lo in range(0, len(order), BATCH_TEXTS):
            pick = order[lo : lo + BATCH_TEXTS]
            step += 1
            texts = [_excerpt(chunks[i], rng) if rng.random() < EXCERPTS else chunks[i] for i in pick]
            grads = _gradients(net, texts, labels[pick])
            for part, grad, (mean, square) in zip(net.parts(), grads, moments):
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                part -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    seen = labels.mean()
    net.last_bias += np.float32(np.log(share / (1 - share)) - np.log(seen / (1 - seen)))
    return net


def _excerpt(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Some bytes of a text, as a short text of its own."""
    chunk = chunks[rng.integers(len(chunks))]
    size = int(rng.integers(8, 128))
    start = int(rng.integers(max(1, np.count_nonzero(chunk) - size)))
    out = np.zeros((1, CHUNK), np.uint8)
    out[0, :size] = chunk[start : start + size]
    return out


def _gradients(net: Network, chunks: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    counts = np.array([len(c) for c in chunks])
    first = np.cumsum(counts) - counts
    flat = np.concatenate(chunks)
    pooled, where = net.pooled(flat)
    open_ = np.maximum(pooled + net.filter_bias, 0)
    hidden = np.tanh(open_ @ net.dense + net.dense_bias)
    odds, features = net.combine(hidden, first)
    error = ((1 / (1 + np.exp(-odds))) - labels).astype(np.float32) / len(labels)
    d_features = error[:, None] * net.last
    text = np.repeat(np.arange(len(chunks)), counts)
    d_hidden = (d_features[:, :HIDDEN] / counts[:, None])[text]
    top = hidden == features[:, HIDDEN:][text]
    d_hidden += top * d_features[:, HIDDEN:][text]
    d_inner = d_hidden * (1 - hidden * hidden)
    d_open = (d_inner @ net.dense.T) * (open_ > 0)
    row = np.arange(len(flat))[:, None]
    d_filters = np.empty_like(net.filters)
    for tap in range(TAPS):
        cell = flat[row, where + tap].astype(np.int64) * FILTERS + np.arange(FILTERS)
        d_filters[tap] = np.bincount(cell.ravel(), d_open.ravel(), 256 * FILTERS).reshape(256, FILTERS)
    return [d_filters, d_open.sum(0), open_.T @ d_inner, d_inner.sum(0), features.T @ error, error.sum(keepdims=True)]


def _sampled_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = bytes_of(part.column("text"))
            starts, ends, first = cover(offsets)
            counts = np.diff(np.append(first, len(starts)))
            raw = []
            for f, n in zip(first, counts):
                at = f + (np.arange(n) if n <= MAX_CHUNKS else np.linspace(0, n - 1, MAX_CHUNKS).astype(int))
                raw.append(cut(data, starts[at], ends[at]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), part.column("place"), pa.array(raw, pa.binary())], ["label", "place", "chunks"]
            )


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col="doc_id", text_col="text") -> Network | float:
    """A network fitted to a bounded sample of the labelled rows for which ``learn``
    holds. Where they are all of one class or none, the share of label 1 (with one
    of each added) stands in for it. Null labels and ids are passed over.
    """
    known = labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    none, all_ = counts.get(0, 0), counts.get(1, 0)
    if not none or not all_:
        return (all_ + 1) / (none + all_ + 2)
    order = F.xxhash64("label_id")
    picked = [known.where(F.col("label") == v).distinct().orderBy(order, "label_id").limit(MAX_TEXTS) for v in (0, 1)]
    # At most 2 * MAX_TEXTS narrow rows.
    sample = F.broadcast(picked[0].union(picked[1]))
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(sample, F.col("id") == F.col("label_id"))
    rows = texts.select("label", F.xxhash64("id", "text").alias("place"), "text").mapInArrow(
        _sampled_chunks, "label int, place long, chunks binary"
    )
    rows = rows.orderBy("place", "chunks", "label").limit(2 * MAX_TEXTS).collect()
    values = np.array([r["label"] for r in rows], np.float32)
    if not 0 < values.sum() < len(values):
        return (all_ + 1) / (none + all_ + 2)
    return fit([np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in rows], values, all_ / (none + all_))


def scores(docs: DataFrame, model: Network | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs``, all its columns, and the probability of label 1 of each whole text.

    Null and empty texts are one chunk of padding. A column that is already called
    ``score_col`` is replaced; an empty table stays empty.
    """
    if isinstance(model, float):
        return docs.withColumn(score_col, F.lit(model))

    @F.arrow_udf(DoubleType())
    def probability(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            whole = pa.RecordBatch.from_arrays([column], ["text"])
            found = [np.empty(0)]
            for part in slices(whole, "text", SLICE_BYTES):
                found.append(model.score(*bytes_of(part.column("text"))))
            yield pa.array(np.concatenate(found))
        # What the batches took is not kept for the worker's next task.
        pa.default_memory_pool().release_unused()

    # Only texts go to the workers and only numbers come back.
    return docs.withColumn(score_col, probability(F.coalesce(F.col(text_col), F.lit(""))))
