"""Toxic passages as maximal scoring segments.

Every word has a score, from its log-odds between toxic and clean documents under Dirichlet priors, as far as they are certain: the lower
confidence limit minus a small drift if that is positive, the upper one if that is below the drift's negative. Any other word, and
any unseen one, takes the drift off. Priors take the share of documents with the word over
the whole corpus. A linear scan finds all maximal scoring segments of a text. Their scores have an
extreme value distribution in clean text, whose constants are fitted, so that a segment of score S in
a text of n words has lambda * S - ln(K * n) nats of significance. A document's score is a logistic
curve over the sum of its significant segments.

Null and empty texts have no segment and get the score of a text without evidence. Very long texts are scanned whole. Repeated rows count
as often as they occur; a row without an id is scored, is not held out, and teaches nothing. Other columns are not read, whatever their names;
``drop_toxic`` passes them on and keeps the texts of all ids alike, null ids too. Without documents, or without labels of both kinds, every text gets the share
of toxic labels (one half without any label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.llm import labels as lab
from lendstrata.llm import text as tx

#: Bytes of a word's beginning that are a feature of their own, for words unseen in the labels.
STEM = 4
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)
#: Pseudo-features that every document has once: itself, and (as a sum) its words.
DOCS, WORDS = 0, 1


@dataclass(frozen=True)
class Params:
    rows: int = lab.SAMPLE_ROWS  # most labelled documents to learn from
    confidence: float = 3.0  # standard deviations below the log-odds
    prior: float = 0.1  # weight of the corpus shares, in clean documents
    least: int = 3  # toxic documents a word must occur in to speak for toxicity
    common: int = 3  # times as many clean ones it must occur in to speak against
    drift: float = 0.3  # taken off each word's score


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    scores: np.ndarray  # drift included where they are positive
    drift: float
    rate: float  # lambda
    log_k: float
    slope: float
    offset: float


def _features(w: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and of the beginning of longer words (0 for others)."""
    stems = tx.hashes(w, STEM) ^ _STEM_SALT
    return tx.hashes(w), np.where(w.ends - w.starts > STEM, stems, np.uint64(0))


def _incidence(w: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once."""
    whole, stems = _features(w)
    owner = w.owners()
    pairs = np.empty(2 * len(owner), [("text", np.int64), ("feature", np.uint64)])
    pairs["text"], pairs["feature"] = np.tile(owner, 2), np.concatenate([whole, stems])
    pairs = np.unique(pairs[pairs["feature"] != 0])
    return pairs["text"], pairs["feature"]


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = np.asarray(tx.text_of(batch, "label"))
        for first, last, data, offsets in tx.slices(tx.text_of(batch, "text")):
            w = tx.words(tx.lowered(data), offsets, punctuation=True)
            text, feature = _incidence(w)
            own = label[first:last]
            feature = np.concatenate([feature, np.full(len(own), DOCS, np.uint64), np.full(len(own), WORDS, np.uint64)])
            weight = np.concatenate([np.ones(len(text), np.int64), np.ones(len(own), np.int64), w.counts()])
            toxic = np.concatenate([own[text], own, own]) * weight
            keys, at = np.unique(feature, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(np.bincount(at, toxic).astype(np.int64)),
                    pa.array(np.bincount(at, weight - toxic).astype(np.int64)),
                ],
                ["feature", "toxic", "clean"],
            )


class _Lookup:
    """Index of each hash in a sorted array, or -1; a bit table passes over most hashes that are absent."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[keys & np.uint64((1 << 20) - 1)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        some = np.flatnonzero(self.maybe[hashes & np.uint64((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), max(0, len(self.keys) - 1))
        hit = self.keys[at] == hashes[some]
        out[some[hit]] = at[hit]
        return out


def _corpus_counts(keys: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total, docs = _Lookup(keys), np.zeros(len(keys), np.int64), 0
        for batch in batches:
            docs += len(batch)
            for _, _, data, offsets in tx.slices(tx.text_of(batch, "text")):
                w = tx.words(tx.lowered(data), offsets, punctuation=True)
                owner = w.owners()
                for found in map(find, _features(w)):
                    some = found >= 0
                    pairs = np.unique(owner[some] * len(keys) + found[some])
                    total += np.bincount(pairs % len(keys), minlength=len(keys))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(len(keys)), -1)), pa.array(np.append(total, docs))], ["at", "docs"]
        )

    return count


def segments(scores: np.ndarray, places: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last word, score) in one scan.

    ``scores`` are those of the words at ``places``; every other word scores ``-drift``. Each segment on
    the stack keeps the sums left and right of it; a new one joins back to the nearest one that starts lower.
    """
    stack: list[tuple[int, int, float, float]] = []
    total, before = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist()):
        total -= drift * (place - before - 1)
        before = place
        if score <= 0:
            total += score
            continue
        first, low, high = place, total, total + score
        total = high
        while stack:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= low:
                k -= 1
            if k < 0 or stack[k][3] >= high:
                break
            first, _, low, _ = stack[k]
            del stack[k:]
        stack.append((first, place, low, high))
    return [(a, b, high - low) for a, b, low, high in stack]


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.find = model, _Lookup(model.features)

    def segments(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """(number of words, segments) of each text."""
        m = self.model
        for first, last, data, offsets in tx.slices(texts):
            w = tx.words(tx.lowered(data), offsets, punctuation=True)
            if not len(m.features):
                yield from ((int(n), []) for n in w.counts())
                continue
            value = self.values(w)
            places = np.flatnonzero(value != -m.drift)
            cuts = np.searchsorted(places, w.bounds)
            for i in range(last - first):
                own = places[cuts[i] : cuts[i + 1]]
                found = segments(value[own], own - w.bounds[i], m.drift) if len(own) else []
                yield int(w.bounds[i + 1] - w.bounds[i]), found

    def values(self, w: tx.Words) -> np.ndarray:
        """Score of each word: the better one of the word and of its beginning, if that is positive, else the word's."""
        m = self.model
        whole, stem = (np.where((found := self.find(h)) >= 0, m.scores[found], -m.drift) for h in _features(w))
        return np.where(stem > 0, np.maximum(whole, stem), whole)

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> list[float]:
        """Significance of each segment in nats; positive ones are significant."""
        return [self.model.rate * s - self.model.log_k - math.log(max(n, 1)) for _, _, s in found]

    def score(self, nats: list[float]) -> float:
        x = self.model.slope * math.log1p(sum(x for x in nats if x > 0)) + self.model.offset
        return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


def _rate(scores: np.ndarray, shares: np.ndarray, drift: float) -> float:
    """The lambda at which clean words' scores have a mean exponential of 1."""
    low, high = 1e-6, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        total = np.sum(shares * np.exp(np.minimum(mid * scores, 500))) + (1 - shares.sum()) * math.exp(-mid * drift)
        low, high = (mid, high) if total < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a weak ridge so that separable labels end too."""
    a = np.stack([x, np.ones_like(x)], 1)
    b, ridge = np.zeros(2), np.diag([0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ b)
        b = b + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, params: Params = Params()) -> Model:
    tx.bound_batches(docs.sparkSession)
    rows = lab.sample(labels, "toxic", learn, params.rows)
    own = lab.labelled(docs, rows)
    base = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
    nothing = Model(np.empty(0, np.uint64), np.empty(0), params.drift, 1.0, 0.0, 0.0, math.log(base / (1 - base)))

    counted = (
        own.select("label", "text")
        .mapInArrow(_class_counts, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= params.least) | (F.col("clean") >= params.least * params.common) | F.col("feature").isin(DOCS, WORDS))
        .toPandas()
    )
    whole = counted[counted.feature.isin([DOCS, WORDS])].set_index("feature")
    if len(whole) < 2 or min(whole.loc[DOCS, "toxic"], whole.loc[DOCS, "clean"]) == 0:
        return nothing
    n1, n0 = int(whole.loc[DOCS, "toxic"]), int(whole.loc[DOCS, "clean"])
    words0 = int(whole.loc[WORDS, "clean"])
    # Only features that are more frequent in toxic documents can have a positive score, and a negative one only those that would be
    # in several toxic documents if they were as frequent there.
    above = (counted.toxic >= params.least) & (counted.toxic * n0 > counted.clean * n1)
    below = counted.clean * n1 >= params.confidence**2 * n0
    more = counted[~counted.feature.isin([DOCS, WORDS]) & (above | below & (counted.toxic * n0 < counted.clean * n1))]
    if not above[~counted.feature.isin([DOCS, WORDS])].any():
        return nothing
    keys, y1, y0 = more.feature.to_numpy().view(np.uint64), more.toxic.to_numpy(), more.clean.to_numpy()
    order = np.argsort(keys)
    keys, y1, y0 = keys[order], y1[order], y0[order]

    corpus = (
        docs.select("text").mapInArrow(_corpus_counts(keys), "at long, docs long").groupBy("at").agg(F.sum("docs").alias("docs"))
    ).toPandas()
    total = dict(zip(corpus["at"], corpus["docs"]))
    share = np.array([total.get(i, 0) for i in range(len(keys))]) / max(1, total.get(-1, 0))

    weight = params.prior * n0
    a1, a0 = y1 + weight * share, y0 + weight * share
    odds = np.log(a1 / (n1 + weight - a1 + weight * share)) - np.log(a0 / (n0 + weight - a0 + weight * share))
    unsure = params.confidence * np.sqrt(1 / a1 + 1 / a0)
    scores = np.where(odds - unsure > params.drift, odds - unsure - params.drift, np.where(odds + unsure < -params.drift, odds + unsure, 0.0))
    good = scores != 0
    keys, scores = keys[good], scores[good]
    if not (scores > 0).any():
        return nothing
    shares = (y0[good] + 0.5) / (words0 + 0.5 * len(keys) + 1)
    draft = Model(keys, scores, params.drift, _rate(scores, shares, params.drift), 0.0, 1.0, 0.0)

    seen = own.select("label", passages(draft, "text").alias("p")).select("label", "p.words", "p.nats").toPandas()
    # With K = 1 the nats of the best segment of a clean text are Gumbel distributed around ln K.
    best = np.array([max(x, default=-math.inf) if x is not None else -math.inf for x in seen.nats])
    clean = best[(seen.label == 0).to_numpy()]
    spread = np.exp(-clean[np.isfinite(clean)])
    # Texts without a segment have their best below that of the weakest feature.
    floor = math.exp(-(draft.rate * (float(scores[scores > 0].min()) + params.drift)))
    mean = (spread.sum() + (len(clean) - len(spread)) / floor) / max(1, len(clean))
    log_k = -math.log(mean) if mean > 0 else 0.0
    x = np.array([np.log1p(sum(max(0.0, v - log_k) for v in nats)) for nats in seen.nats])
    slope, offset = _logistic(x, seen.label.to_numpy(float))
    return Model(keys, scores, params.drift, draft.rate, log_k, slope, offset)


_PASSAGES = "struct<score: double, words: long, starts: array<long>, ends: array<long>, nats: array<double>>"


def passages(model: Model, column: str) -> Column:
    """Score of a text, its number of words, and each maximal segment: words [start, end) and nats."""
    shared = model

    @F.arrow_udf(_PASSAGES)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared)
        for texts in batches:
            rows = []
            for n, found in scorer.segments(texts):
                nats = scorer.evidence(n, found)
                rows.append((scorer.score(nats), n, [a for a, _, _ in found], [b + 1 for _, b, _ in found], nats))
            names = ["score", "words", "starts", "ends", "nats"]
            kinds = [pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return find(column)


def learns(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return lab.fold(doc_id, 4) != 2


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: score, prediction, and the number of its significant passages."""
    model = fit(docs, labels, learns(F.col("doc_id")))
    own = docs.select("doc_id", passages(model, "text").alias("p"))
    return own.select(
        "doc_id",
        F.coalesce(~learns(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("p.score").alias("score"),
        F.when(F.col("p.score") >= threshold, 1).otherwise(0).alias("predicted"),
        F.expr("cast(size(filter(p.nats, x -> x > 0)) as long)").alias("n_passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score is below the threshold, columns unchanged."""
    model = fit(docs, labels, learns(F.col("doc_id")))
    return docs.where(passages(model, "text").getField("score") < threshold)
