"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, gated attention weighs the
passages, and the weighted mean is scored. Only the documents have labels; encoder,
attention and score are trained together in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import first_by_hash, map_arrow, stored
from adlake.llm.langid import fold

PASSAGE = 384
BUCKETS = 96
ENCODED, ATTENDED = 16, 12
# The bound on what the training sees: labelled documents of each label.
DOCS_PER_LABEL = 1_200
# Passages of one document that training sees; scoring reads all.
PASSAGES_PER_DOC = 128
STEPS, RATE, DECAY = 250, 0.01, 1e-4
THRESHOLD = 0.3

# Classes of bytes: lower, upper, digit, blank, line break, sentence mark, other mark, beyond ASCII.
_CLASS = np.full(256, 7, np.int64)
_CLASS[:128] = 6
for _chars, _number in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b" \t", 3), (b"\r\n", 4), (b".,;:!?'\"-()", 5)):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _number
_CLASSES = 8
FEATURES = BUCKETS + _CLASSES + 4


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features of the texts and the number of passages of each (at least one).

    A passage is a stretch of ``PASSAGE`` bytes: shares of hashed byte pairs, shares of byte
    classes, word length, and the shares of words that repeat the word before or the one
    two before.
    """
    datas = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    counts = np.array([max(1, -(-len(d) // PASSAGE)) for d in datas], np.int64)
    total = int(counts.sum())
    out = np.zeros((total, FEATURES), np.float32)
    data = np.frombuffer(b"".join(datas), np.uint8)
    if not len(data):
        return out, counts
    sizes = np.array([len(d) for d in datas], np.int64)
    first = np.cumsum(counts) - counts
    starts = np.cumsum(sizes) - sizes
    at = np.arange(len(data)) - np.repeat(starts, sizes)
    passage = np.repeat(first, sizes) + at // PASSAGE
    lengths = np.maximum(np.bincount(passage, minlength=total), 1)[:, None]
    folded = data.astype(np.int64)
    pair = np.zeros(len(data), np.int64)
    pair[1:] = ((folded[:-1] * 31 + folded[1:]) * 0x9E3779B1 >> 7) % BUCKETS
    pair[at == 0] = 0
    out[:, :BUCKETS] = np.bincount(passage * BUCKETS + pair, minlength=total * BUCKETS).reshape(total, -1) / lengths
    kind = _CLASS[data]
    out[:, BUCKETS : BUCKETS + _CLASSES] = np.bincount(passage * _CLASSES + kind, minlength=total * _CLASSES).reshape(total, -1) / lengths
    # Words are told apart by a hash: a sum of byte times place, over the bytes of the word.
    blanks = (kind == 3) | (kind == 4)
    opens = np.ones(len(data), bool)
    opens[1:] = blanks[:-1]
    begin = np.nonzero(~blanks & (opens | (at == 0)))[0]
    if len(begin):
        ends = np.append(begin[1:], len(data))
        place = np.zeros(len(data), np.uint64)
        place[begin[0] :] = np.arange(begin[0], len(data)) - np.repeat(begin, ends - begin)
        power = (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ place << np.uint64(7)
        mixed = np.where(blanks, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * power)
        word = np.add.reduceat(mixed, begin)
        letters = np.add.reduceat((~blanks).astype(np.int64), begin)
        own = passage[begin]
        words = np.maximum(np.bincount(own, minlength=total), 1)
        text = np.repeat(np.arange(len(datas)), sizes)[begin]
        same = np.zeros((2, len(begin)))
        same[0, 1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
        same[1, 2:] = (word[2:] == word[:-2]) & (text[2:] == text[:-2])
        column = BUCKETS + _CLASSES
        out[:, column] = np.bincount(own, letters, minlength=total) / words / 10
        out[:, column + 1] = np.bincount(own, same[0], minlength=total) / words
        out[:, column + 2] = np.bincount(own, same[1], minlength=total) / words
        out[:, column + 3] = np.minimum(np.bincount(own, letters > 25, minlength=total), 10) / 10
    return out, counts


@dataclass
class Model:
    """Standardisation, encoder, gated attention and score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]  # encoder, its bias, V, U, w, score, its bias
    prior: float


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _bags(weights, x, counts):
    """Scores of the bags and what the gradients need."""
    enc, enc_b, v, u, w, out, out_b = weights
    starts = np.cumsum(counts) - counts
    own = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ enc + enc_b)
    a, g = np.tanh(h @ v), _sigmoid(h @ u)
    e = (a * g) @ w
    e = np.exp(e - np.maximum.reduceat(e, starts)[own])
    alpha = e / np.add.reduceat(e, starts)[own]
    bag = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
    return _sigmoid(bag @ out + out_b[0]), (h, a, g, alpha, bag, starts, own)


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, seed: int = 3) -> Model:
    """Fit to passage features, passages per document, and the labels of the documents."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = ((x - mean) / scale).clip(-6, 6)
    weights = [rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, ENCODED)), np.zeros(ENCODED),
               rng.normal(0, 0.3, (ENCODED, ATTENDED)), rng.normal(0, 0.3, (ENCODED, ATTENDED)),
               rng.normal(0, 0.3, ATTENDED), rng.normal(0, 0.3, ENCODED), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in weights], [np.zeros_like(p) for p in weights]
    # Both labels count alike.
    ones = max(1, int(y.sum()))
    weight = np.where(y == 1, len(y) / 2 / ones, len(y) / 2 / max(1, len(y) - ones)) / len(y)
    for step in range(1, STEPS + 1):
        p, (h, a, g, alpha, bag, starts, own) = _bags(weights, x, counts)
        enc, _, v, u, w, out, _ = weights
        d = (p - y) * weight
        d_bag = d[:, None] * out
        d_alpha = (d_bag[own] * h).sum(axis=1)
        d_e = alpha * (d_alpha - np.add.reduceat(alpha * d_alpha, starts)[own])
        d_ag = d_e[:, None] * w
        d_a, d_g = d_ag * g * (1 - a * a), d_ag * a * g * (1 - g)
        d_h = (d_bag[own] * alpha[:, None] + d_a @ v.T + d_g @ u.T) * (1 - h * h)
        grads = [x.T @ d_h, d_h.sum(axis=0), h.T @ d_a, h.T @ d_g, (a * g).T @ d_e, bag.T @ d, np.array([d.sum()])]
        for value, grad, m, s in zip(weights, grads, first, second):
            grad = grad + DECAY * value
            m += 0.1 * (grad - m)
            s += 0.01 * (grad * grad - s)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, weights, float(y.mean()))


def scores(model: Model | None, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(counts):
        return np.zeros(0)
    if model is None:
        return np.full(len(counts), 0.5)
    return _bags(model.weights, ((x - model.mean) / model.scale).clip(-6, 6), counts)[0]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on labelled rows outside the held-out fold; None unless both labels occur.

    The sample is bounded: ``DOCS_PER_LABEL`` documents of each label, the first in an order
    by hash of the id, and of each at most ``PASSAGES_PER_DOC`` passages, spread over it. A document with contradicting labels is left out; labels other
    than 0 and 1, null ids and ids without a document are ignored.
    """
    sound = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter(F.col("quality") == F.col("_most"))
    )
    by_hash = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (
        first_by_hash(stored(sound.select("doc_id", "quality"), "labels"), "quality", F.xxhash64("doc_id"), DOCS_PER_LABEL)
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= DOCS_PER_LABEL)
        .select("doc_id", "quality")
    )
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(stored(picked, "picked")), "doc_id")
        .select("text", "quality", "doc_id")
    )
    # Encoded where they lie: features of at most 2 * DOCS_PER_LABEL documents reach the driver.
    found = map_arrow(sample, _encoder, "quality int, doc_id long, counts long, x binary").orderBy("doc_id", "x").toArrow()
    y = np.array(found.column("quality").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.concatenate([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found.column("x").to_pylist()])
    return train(x, np.asarray(found.column("counts").to_pylist()), y)


def _spread(n: int, most: int) -> np.ndarray:
    """At most ``most`` of n places, evenly apart."""
    return np.arange(n) if n <= most else np.linspace(0, n - 1, most).astype(int)


def _encoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, counts = features(batch.column("text").to_pylist())
        each = np.split(x, np.cumsum(counts)[:-1]) if len(counts) else []
        each = [p[_spread(len(p), PASSAGES_PER_DOC)] for p in each]
        parts, counts = [p.tobytes() for p in each], [len(p) for p in each]
        yield pa.RecordBatch.from_arrays(
            [batch.column("quality").cast(pa.int32()), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(parts, pa.binary())],
            ["quality", "doc_id", "counts", "x"],
        )


def _scorer(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for at in range(0, max(batch.num_rows, 1), 64):
                x, counts = features(batch.column(0).slice(at, 64).to_pylist())
                got.append(scores(model, x, counts))
            score = np.concatenate(got)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32())],
                [*batch.schema.names[1:], "score", "predicted"],
            )

    return run


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for all of ``docs`` (doc_id, text).

    ``labels`` has (doc_id, quality). Null and empty texts are one empty passage and get
    the score of that. Without labels of both kinds every score is 0.5. Repeated rows
    give repeated results; an empty input gives an empty result.
    """
    model = fit(docs, labels)
    marked = docs.select("text", "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"))
    return map_arrow(marked, _scorer(model), "doc_id long, held_out boolean, score double, predicted int")
