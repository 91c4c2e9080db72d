"""Language identification with a bidirectional gated recurrent network over bytes.

The network labels every byte of a text from the bytes on both sides; the label
probabilities are averaged over the document. It is trained in numpy by
backpropagation through time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import first_by_hash, map_arrow, stored

HIDDEN = 8
# Bytes that the network reads at once; the state starts anew at every such stretch.
SPAN = 64
PAD = 256
FOLDS = 5
# The bound on what the training sees: labelled documents per language, and stretches
# of each, spread evenly over the whole text.
DOCS_PER_LANGUAGE = 200
SPANS_PER_DOC = 6
STEPS, BATCH, RATE = 160, 256, 0.02

_LETTER = re.compile(r"[^\W\d_]")
_F = np.float32


def fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS


@dataclass
class Model:
    """Per direction: a table of gate inputs by byte, and recurrent weights; then the output."""

    labels: list[str]
    tables: list[np.ndarray]  # 2 x (3H, 257)
    recurrent: list[np.ndarray]  # 2 x (3H, H)
    output: np.ndarray  # (L, 2H)
    bias: np.ndarray  # (L,)


def spans_of(data: bytes) -> np.ndarray:
    """The text cut into rows of ``SPAN`` bytes, the last one padded."""
    n = -(-len(data) // SPAN)
    out = np.full(n * SPAN, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, SPAN)


def prepared(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def _forward(table, weights, columns, keep=False):
    """States (T, H, B) over the byte columns (T, B); gates are clipped lines.

    update = clip(z), reset = clip(r), candidate = clip(n + reset * (U h)) in [-1, 1].
    """
    steps, width = columns.shape
    h = np.zeros((HIDDEN, width), _F)
    states = np.empty((steps, HIDDEN, width), _F)
    kept = []
    gates, drawn = np.empty((3 * HIDDEN, width), _F), np.empty((3 * HIDDEN, width), _F)
    for t in range(steps):
        np.take(table, columns[t], axis=1, out=gates, mode="clip")
        np.matmul(weights, h, out=drawn)
        zr, n = gates[: 2 * HIDDEN], gates[2 * HIDDEN :]
        zr += drawn[: 2 * HIDDEN]
        if keep:
            raw = zr.copy()
        np.maximum(zr, 0, out=zr)
        np.minimum(zr, 1, out=zr)
        z, r, u = zr[:HIDDEN], zr[HIDDEN:], drawn[2 * HIDDEN :]
        if keep:
            fed = u.copy()
        u *= r
        n += u
        if keep:
            kept.append((h, raw, fed, n.copy(), z.copy(), r.copy()))
        np.maximum(n, -1, out=n)
        np.minimum(n, 1, out=n)
        # h = n + z (h - n)
        out = states[t]
        np.subtract(h, n, out=out)
        out *= z
        out += n
        h = out
    return states, kept


def _backward(weights, columns, kept, states_grad):
    """Gradients of the table and the recurrent weights."""
    steps, width = columns.shape
    d_table = np.zeros((3 * HIDDEN, 257), _F)
    d_weights = np.zeros_like(weights)
    carry = np.zeros((HIDDEN, width), _F)
    for t in range(steps - 1, -1, -1):
        h, raw, fed, n_raw, z, r = kept[t]
        dh = states_grad[t] + carry
        n = np.clip(n_raw, -1, 1)
        dn = dh * (1 - z) * (np.abs(n_raw) < 1)
        dz = dh * (h - n)
        dzr = np.concatenate([dz, dn * fed]) * ((raw > 0) & (raw < 1))
        d_gates = np.concatenate([dzr, dn])
        d_drawn = np.concatenate([dzr, dn * r])
        d_weights += d_drawn @ h.T
        carry = dh * z + weights.T @ d_drawn
        one_hot = np.zeros((width, 257), _F)
        one_hot[np.arange(width), columns[t]] = 1
        d_table += d_gates @ one_hot
    return d_table, d_weights


def _probabilities(model: Model, rows: np.ndarray, keep=False):
    columns = np.ascontiguousarray(rows.T).astype(np.intp)
    back = columns[::-1]
    forth_states, forth_kept = _forward(model.tables[0], model.recurrent[0], columns, keep)
    back_states, back_kept = _forward(model.tables[1], model.recurrent[1], back, keep)
    back_states = back_states[::-1]
    scores = np.matmul(model.output[:, :HIDDEN], forth_states)
    scores += np.matmul(model.output[:, HIDDEN:], back_states)
    scores += model.bias[:, None]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores, (columns, back, forth_states, back_states, forth_kept, back_kept)


def train(rows: np.ndarray, labels: list[str], targets: np.ndarray, seed: int = 5) -> Model:
    """Fit to spans (n, SPAN) and their label numbers; every byte carries its text's label."""
    rng = np.random.default_rng(seed)
    n_labels = len(labels)
    bias = np.zeros((3 * HIDDEN, 1))
    bias[:HIDDEN], bias[HIDDEN : 2 * HIDDEN] = 0.7, 0.5
    tables = [(rng.normal(0, 0.3, (3 * HIDDEN, 257)) + bias).astype(_F) for _ in range(2)]
    recurrent = [rng.normal(0, 0.2, (3 * HIDDEN, HIDDEN)).astype(_F) for _ in range(2)]
    model = Model(labels, tables, recurrent, rng.normal(0, 0.3, (n_labels, 2 * HIDDEN)).astype(_F), np.zeros(n_labels, _F))
    # Every language counts alike, whatever its number of spans.
    shares = np.bincount(targets, minlength=n_labels)
    weight = (len(targets) / np.maximum(shares, 1) / n_labels).astype(_F)
    params = [*model.tables, *model.recurrent, model.output, model.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(rows), min(BATCH, len(rows)))
        p, (cols, back, fs, bs, fk, bk) = _probabilities(model, rows[pick], keep=True)
        y = targets[pick]
        d = p.copy()
        d[:, y, np.arange(len(pick))] -= 1
        d *= (weight[y] * 1.0)[None, None, :] * (cols != PAD)[:, None, :] / max(1, (cols != PAD).sum())
        d_out = np.concatenate([np.einsum("tlb,thb->lh", d, fs), np.einsum("tlb,thb->lh", d, bs)], axis=1)
        d_fs = np.matmul(model.output[:, :HIDDEN].T, d)
        d_bs = np.matmul(model.output[:, HIDDEN:].T, d)[::-1]
        ft, fw = _backward(model.recurrent[0], cols, fk, d_fs)
        bt, bw = _backward(model.recurrent[1], back, bk, d_bs)
        rate = RATE * (1 - 0.8 * step / STEPS)
        for value, grad, m, v in zip(params, [ft, bt, fw, bw, d_out, d.sum(axis=(0, 2))], first, second):
            grad = np.clip(grad, -1, 1)
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def _sampled_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, spans = [], []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            rows = spans_of(prepared(text))
            for at in np.unique(np.linspace(0, len(rows) - 1, SPANS_PER_DOC).astype(int)) if len(rows) else ():
                langs.append(lang)
                spans.append(rows[at].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(spans, pa.binary())], ["lang", "span"])


def fit(docs: DataFrame) -> Model | None:
    """Train on rows (doc_id, text, lang) outside the held-out fold; None if none has a label.

    The sample is bounded: ``DOCS_PER_LANGUAGE`` documents per value of lang, the first in
    an order by hash of the id, and ``SPANS_PER_DOC`` stretches of each.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id")) != 0))
    # Ranked without the texts; each task keeps its first rows per language only.
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "key")
    narrow = stored(usable.select("doc_id", "lang", F.xxhash64("text").alias("key")), "usable")
    picked = (
        first_by_hash(narrow, "lang", F.xxhash64("doc_id"), DOCS_PER_LANGUAGE)
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= DOCS_PER_LANGUAGE)
        .select("doc_id", "lang", "key")
        .distinct()
    )
    d, p = usable.withColumn("key", F.xxhash64("text")).alias("d"), F.broadcast(stored(picked, "picked")).alias("p")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.lang") == F.col("p.lang")) & (F.col("d.key") == F.col("p.key"))
    sample = d.join(p, same, "left_semi").select("text", "lang").distinct()
    found = map_arrow(sample, _sampled_spans, "lang string, span binary").orderBy("lang", "span").toArrow()
    if not found.num_rows:
        return None
    langs = found.column("lang").to_pylist()
    labels = sorted(set(langs))
    rows = np.stack([np.frombuffer(s, np.int16) for s in found.column("span").to_pylist()])
    return train(rows, labels, np.array([labels.index(x) for x in langs]))


BLOCK = 2048


def _predictor(model: Model | None):
    """Appends (lang_pred, score) to batches whose first column is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            read = [i for i, t in enumerate(texts) if model is not None and t and _LETTER.search(t)]
            n_labels = len(model.labels) if model is not None else 1
            total = np.zeros((len(texts), n_labels))
            length = np.zeros(len(texts))

            def score(rows: list[np.ndarray], owners: list[np.ndarray]) -> None:
                rows, owners = np.concatenate(rows), np.concatenate(owners)
                for at in range(0, len(rows), BLOCK):
                    part, own = rows[at : at + BLOCK], owners[at : at + BLOCK]
                    p, _ = _probabilities(model, part)
                    p *= (part.T != PAD)[:, None, :]
                    np.add.at(total, own, p.sum(axis=0).T)
                    np.add.at(length, own, (part != PAD).sum(axis=1))

            rows, owners, pending = [], [], 0
            for i in read:
                rows.append(spans_of(prepared(texts[i])))
                owners.append(np.full(len(rows[-1]), i))
                pending += len(rows[-1])
                if pending >= 8 * BLOCK:
                    score(rows, owners)
                    rows, owners, pending = [], [], 0
            if rows:
                score(rows, owners)
            mean = total / np.maximum(length, 1)[:, None]
            known = length > 0
            names = [model.labels[k] if ok else "und" for k, ok in zip(mean.argmax(axis=1), known)] if len(texts) else []
            best = np.where(known, np.clip(mean.max(axis=1), 0, 1), 0.0) if len(texts) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()), pa.array(best, pa.float64())],
                [*batch.schema.names[1:], "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text, then any columns) without ``text``, with ``lang_pred`` and ``score``.

    Texts that are null or hold no letter, and all texts if there is no model, are ``und``
    with score 0. The whole text is read. Columns of the new names are replaced.
    """
    rest = [f for f in docs.schema.fields if f.name not in ("text", "lang_pred", "score")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["lang_pred string", "score double"])
    return map_arrow(docs.select("text", *[f"`{f.name}`" for f in rest]), _predictor(model), schema)


def identify(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) for all of ``docs`` (doc_id, text, lang).

    Learns from the rows outside the held-out fold that have a lang. Repeated rows give
    repeated results; an empty input gives an empty result.
    """
    model = fit(docs.select("doc_id", "text", "lang"))
    marked = docs.select("text", "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"))
    return predict(marked, model)


def keep_identified(docs: DataFrame, over_chance: float = 1.08) -> DataFrame:
    """``docs`` without texts that are null, hold no letter, or look like no learned language.

    A text stays if the mean probability of its best language is ``over_chance`` times what
    chance gives (one by the number of learned languages) or more; with one language all
    texts with a letter stay. All columns are kept as they are.
    """
    model = fit(docs.select("doc_id", "text", "lang"))
    least = over_chance / len(model.labels) if model and len(model.labels) > 1 else 0.0
    names = docs.columns
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    judged = predict(packed, model)
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")
