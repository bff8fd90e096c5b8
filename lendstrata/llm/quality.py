"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

A word's index vector has a few random +1 and -1 entries. Its context vector is the sum of the index
vectors of its neighbours over all documents. Words and runs of a punctuation mark share a fixed number
of hashed rows, which bounds the table that is broadcast; sums are integers, so they don't depend on the
order of rows. A document is pooled into the mean and deviation of its words' unit vectors and the
mean difference between neighbours, which is small in repetitive text. The network ends in a
logistic unit whose temperature is fitted on rows that the weights haven't seen.

Null and empty texts pool to zeros and are scored like others; very long texts are pooled whole. Repeated rows count as often as they
occur. A row without an id is scored, is not held out, and teaches nothing. An empty table gives no rows. Other columns are not read,
whatever their names. Without labels of both kinds every text gets the share of label 1 (one half without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.llm import labels as lab
from lendstrata.llm import text as tx


@dataclass(frozen=True)
class Params:
    rows: int = 20_000  # most labelled documents to learn from
    buckets: int = 1 << 14  # rows of the word table
    size: int = 32  # length of a vector
    marks: int = 4  # nonzero entries of an index vector
    window: int = 2  # neighbours on either side
    hidden: int = 32
    epochs: int = 60
    seed: int = 7


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray  # unit context vectors by bucket
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float


def index_vectors(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries, by bucket."""
    rng = np.random.default_rng(p.seed)
    places = np.argsort(rng.random((p.buckets, p.size)), axis=1)[:, : p.marks]
    return places, rng.choice([-1, 1], (p.buckets, p.marks))


def _buckets(w: tx.Words, p: Params) -> np.ndarray:
    return (tx.hashes(w) & np.uint64(p.buckets - 1)).astype(np.int64)


def _contexts(p: Params):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(p)
        total = np.zeros(p.buckets * p.size, np.int64)
        for batch in batches:
            for _, _, data, offsets in tx.slices(tx.text_of(batch, "text"), tx.LARGE_SLICE):
                w = tx.words(data, offsets, punctuation=True)
                own, owner = _buckets(w, p), w.owners()
                for step in range(1, p.window + 1):
                    near = owner[step:] == owner[:-step]
                    left, right = own[:-step][near], own[step:][near]
                    for word, other in ((left, right), (right, left)):
                        for k in range(p.marks):
                            cells = word * p.size + places[other, k]
                            total += np.bincount(cells, signs[other, k], minlength=len(total)).astype(np.int64)
        rows = total.reshape(p.buckets, p.size)
        some = np.flatnonzero(rows.any(axis=1))
        names = ["bucket", *(f"v{i}" for i in range(p.size))]
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(rows[some, i]) for i in range(p.size))], names)

    return count


def word_vectors(docs: DataFrame, p: Params = Params()) -> np.ndarray:
    """Unit context vectors from all documents; at most ``buckets`` rows come to the driver."""
    columns = [f"v{i}" for i in range(p.size)]
    schema = ", ".join(["bucket long", *(f"{c} long" for c in columns)])
    sums = docs.select("text").mapInArrow(_contexts(p), schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])
    found = sums.toPandas()
    out = np.zeros((p.buckets, p.size), np.float32)
    rows = found[columns].to_numpy(np.float64)
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    out[found["bucket"].to_numpy(np.int64)] = rows / np.maximum(length, 1e-12)
    return out


def pooled(texts: pa.Array, vectors: np.ndarray, p: Params) -> Iterator[np.ndarray]:
    """Feature rows of the texts, slice by slice."""
    for _, _, data, offsets in tx.slices(texts, tx.LARGE_SLICE):
        w = tx.words(data, offsets, punctuation=True)
        v = vectors[_buckets(w, p)]
        n = w.counts()
        mean, square = _sums(v, w.bounds), _sums(v * v, w.bounds)
        step = np.zeros_like(v)
        if len(v) > 1:
            step[1:] = np.abs(v[1:] - v[:-1])
            step[w.bounds[:-1][n > 0]] = 0  # no neighbour across texts
        many = np.maximum(n, 1)[:, None]
        mean, square = mean / many, square / many
        apart = _sums(step, w.bounds) / np.maximum(n - 1, 1)[:, None]
        yield np.hstack([mean, np.sqrt(np.maximum(square - mean**2, 0)), apart, np.log1p(n)[:, None]])


def _sums(v: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(bounds) - 1, v.shape[1]))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(v, bounds[some], axis=0, dtype=np.float64)
    return out


def _forward(x: np.ndarray, layers: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    h = np.tanh(x @ w1 + b1)
    return h, h @ w2 + b2[0]


def train(x: np.ndarray, y: np.ndarray, p: Params) -> tuple[np.ndarray, ...]:
    """Weights of the two layers by Adam over shuffled blocks of rows."""
    rng = np.random.default_rng(p.seed)
    layers = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], p.hidden)),
        np.zeros(p.hidden),
        rng.normal(0, 1 / np.sqrt(p.hidden), p.hidden),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers]
    t = 0
    for epoch in range(p.epochs):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / p.epochs))
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at : at + 128]
            h, z = _forward(x[rows], tuple(layers))
            error = (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - h**2)
            grads = [x[rows].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ error + 1e-4 * layers[2], np.array([error.sum()])]
            t += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(layers)


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section on its logarithm."""

    def loss(log_t: float) -> float:
        s = np.clip(z / np.exp(log_t), -500, 500)
        return float(np.mean(np.logaddexp(0, s) - y * s))

    low, high, g = np.log(0.25), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learns(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return lab.fold(doc_id, 5) != 0


def fit(docs: DataFrame, labels: DataFrame, learn: Column, p: Params = Params()) -> Model:
    vectors = word_vectors(docs, p)
    rows = lab.sample(labels, "quality", learn, p.rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.vstack([np.empty((0, 3 * p.size + 1)), *pooled(tx.text_of(batch, "text"), vectors, p)])
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells], ["doc_id", "label", "x"])

    found = (
        lab.labelled(docs, rows).select("doc_id", "label", "text").mapInArrow(features, "doc_id long, label int, x array<double>")
    ).toPandas()
    width = 3 * p.size + 1
    if found.label.nunique() < 2:
        share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
        empty = (np.zeros((width, p.hidden)), np.zeros(p.hidden), np.zeros(p.hidden), np.array([np.log(share / (1 - share))]))
        return Model(vectors, np.zeros(width), np.ones(width), empty, 1.0)
    x = np.stack(found.x.to_numpy())
    order = np.lexsort([*x.T[:3], found.doc_id.to_numpy()])
    x, y, ids = x[order], found.label.to_numpy(float)[order], found.doc_id.to_numpy(np.int64)[order]
    centre, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - centre) / scale
    held = ids.view(np.uint64) % np.uint64(6) == 0  # copies of an id stay on one side
    if len(np.unique(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    layers = train(x[~held], y[~held], p)
    return Model(vectors, centre, scale, layers, temperature(_forward(x[held], layers)[1], y[held]) if held.any() else 1.0)


def quality(model: Model, column: str, p: Params = Params()) -> Column:
    """Probability that a text has label 1."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [np.empty(0)]
            for x in pooled(texts, model.vectors, p):
                _, z = _forward((x - model.centre) / model.scale, model.layers)
                out.append(1 / (1 + np.exp(-np.clip(z / model.temperature, -500, 500))))
            yield pa.array(np.concatenate(out))

    return score(column)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: score and prediction."""
    model = fit(docs, labels, learns(F.col("doc_id")))
    own = docs.select("doc_id", quality(model, "text").alias("score"))
    return own.select(
        "doc_id",
        F.coalesce(~learns(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
