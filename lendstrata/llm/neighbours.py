"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables hashes a vector by floor((a.x + b) / w) for a few normal a. A query visits, in every
table, its own bucket and buckets that differ by one step in some coordinates, in the order of the estimated chance that a
neighbour lies there: the sum of squared distances to the bucket borders that are crossed. All vectors of visited
buckets are candidates. Buckets and visits meet by a shuffle on the bucket; each task compares them in blocks in
double precision and passes on the nearest per query; those are merged. Buckets with very many vectors are cut into pieces, each of which
gets the visits. Queries that found fewer vectors than they ask for are compared with all vectors, in bounded blocks.

The width w and the number of visits are fitted on a bounded sample, on which the recall must reach a target. If even the most visits
miss too many there, all queries are compared with all vectors that way. Vectors of very large components are scaled by a power of two
where they are compared, which changes no distance.

Vectors that are null or zero, hold a null or non-finite component, have another length than most of the sample, or have
no id take no part, neither as queries nor as candidates; an empty table gives no rows. Of rows with one id the nearest counts. Ties go to the smaller id. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lendstrata.llm import text as tx
from lendstrata.sources.sinks import materialize

#: Vectors that the widths are fitted on: those with the smallest id hashes.
SAMPLE_ROWS = 2_000
#: Vectors of a bucket that one task takes.
BUCKET_ROWS = 4_096
#: Rows (vectors and visits) of a task that compares.
PART_ROWS = 100_000
#: Hot buckets or queries that are sent to every task at most.
SENT_ROWS = 10_000


@dataclass(frozen=True)
class Params:
    nearest: int = 10
    tables: int = 8
    hashes: int = 8
    target: float = 0.96  # recall on the sample
    least: float = 0.92  # below it on the sample, with the most visits, all vectors are compared
    seed: int = 11


@dataclass(frozen=True)
class Index:
    lines: np.ndarray  # tables x size x hashes
    shifts: np.ndarray  # tables x hashes, in widths
    width: float
    sets: np.ndarray  # perturbations x (2 * hashes), 0 or 1
    visits: int


def perturbations(hashes: int, most: int = 4) -> np.ndarray:
    """All sets of up to ``most`` coordinates with a step down (first half) or up (second half)."""
    rows = []
    for k in range(min(most, hashes) + 1):
        for where in combinations(range(hashes), k):
            for signs in range(1 << k):
                row = np.zeros(2 * hashes, np.int8)
                row[[c + hashes * (signs >> i & 1) for i, c in enumerate(where)]] = 1
                rows.append(row)
    return np.array(rows)


def places(index: Index, x: np.ndarray, table: int) -> np.ndarray:
    """Coordinates of the vectors in one table, in bucket widths."""
    return x @ index.lines[table] / index.width + index.shifts[table]


def _keys(table: int, corners: np.ndarray) -> np.ndarray:
    """64-bit key of buckets."""
    h = np.full(corners.shape[:-1], table + 1, np.uint64)
    for i in range(corners.shape[-1]):
        corner = np.clip(np.nan_to_num(corners[..., i]), -(2.0**62), 2.0**62).astype(np.int64)
        h = tx.mix(h * np.uint64(0x9E3779B97F4A7C15) + corner.view(np.uint64))
    return h


def buckets(index: Index, x: np.ndarray, table: int) -> np.ndarray:
    return _keys(table, np.floor(places(index, x, table)))


def visited(index: Index, x: np.ndarray, table: int) -> np.ndarray:
    """Keys of the buckets that each vector visits, in order."""
    at = places(index, x, table)
    corner = np.floor(at)
    inside = at - corner
    crossed = np.hstack([inside, 1 - inside]) ** 2
    order = np.argsort(crossed @ index.sets.T, axis=1, kind="stable")[:, : index.visits]
    half = index.sets.shape[1] // 2
    steps = (index.sets[:, half:] - index.sets[:, :half])[order]
    return _keys(table, corner[:, None, :] + steps)


def vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors)."""
    found, rows = [], []
    column = column.cast(pa.list_(pa.float64()))
    for i, v in enumerate(column):
        if not v.is_valid or len(v) != size:
            continue
        x = v.values.to_numpy(zero_copy_only=False)  # null components become NaN
        if np.isfinite(x).all() and x.any():
            rows.append(i)
            found.append(x)
    return np.array(rows, np.int64), np.array(found).reshape(-1, size)


def fit(rows: DataFrame, p: Params = Params()) -> Index | None:
    """Widths and visits from a bounded sample; None if no vector takes part."""
    sample = rows.where("vec_id is not null and embedding is not null").select("vec_id", "embedding")
    got = sample.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    sizes = [len(r["embedding"]) for r in got]
    if not sizes:
        return None
    size = max(set(sizes), key=lambda s: (sizes.count(s), -s))
    _, x = vectors(pa.array([r["embedding"] for r in got], pa.list_(pa.float64())), size)
    if not len(x):
        return None
    rng = np.random.default_rng(p.seed)
    lines, shifts = rng.normal(size=(p.tables, size, p.hashes)), rng.random((p.tables, p.hashes))
    sets = perturbations(p.hashes)
    asked = x[:: max(1, len(x) // 200)][:200]
    far = _distances(asked, x)
    np.fill_diagonal(far[:, :: max(1, len(x) // 200)][:, : len(asked)], np.inf)
    k = min(p.nearest, len(x) - 1)
    if k < 1:
        return Index(lines, shifts, 1.0, sets, len(sets))
    nearest = np.argsort(far, axis=1, kind="stable")[:, :k]
    reach = float(np.median(np.take_along_axis(far, nearest, 1)[:, -1]))
    reach = reach if 0 < reach < np.inf else 1.0
    for factor in (1.5, 1.75, 2.0, 2.5, 3.0, 4.0):
        trial = Index(lines, shifts, factor * reach, sets, len(sets))
        mine = [buckets(trial, x, t) for t in range(p.tables)]
        found = [visited(trial, asked, t) for t in range(p.tables)]
        for visits in (50, 100, 150, 200):
            hit = np.zeros(nearest.shape, bool)
            for t in range(p.tables):
                hit |= (mine[t][nearest][:, :, None] == found[t][:, None, :visits]).any(axis=2)
            if hit.mean() >= p.target:
                return Index(lines, shifts, factor * reach, sets, visits)
    hit = np.zeros(nearest.shape, bool)
    for t in range(p.tables):
        hit |= (mine[t][nearest][:, :, None] == visited(Index(lines, shifts, 4 * reach, sets, 400), asked, t)[:, None]).any(axis=2)
    return Index(lines, shifts, 4 * reach, sets, 400 if hit.mean() >= p.least else 0)


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.maximum((q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * q @ x.T, 0)


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    down = _scale(q, x)
    return np.sqrt(_squares(q * down, x * down)) / down


def _scale(*parts: np.ndarray) -> float:
    """A power of two that keeps squares of the components in range."""
    most = max((float(np.abs(a).max()) for a in parts if a.size), default=0.0)
    return 2.0 ** -math.ceil(math.log2(most)) if most > 1e100 else 1.0


def _spell(index: Index, size: int, probing: bool):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = vectors(batch.column(1), size)
            ids = np.asarray(batch.column(0))[rows] if len(rows) else np.empty(0, np.int64)
            for t in range(len(index.lines)):
                for at in range(0, len(x), 500):
                    own, part = ids[at : at + 500], x[at : at + 500]
                    keys = visited(index, part, t) if probing else buckets(index, part, t)[:, None]
                    many = keys.shape[1]
                    yield _rows(keys.ravel(), np.repeat(own, many), np.repeat(part, many, axis=0))

    return spell


def _rows(keys: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    data = pa.array([v.tobytes() for v in x], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids), data], ["key", "id", "vector"])


class Best:
    """The nearest vectors so far of each query of a task."""

    def __init__(self, nearest: int) -> None:
        self.nearest, self.found = nearest, {}

    def compare(self, query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        for low in range(0, len(x), 4096):
            order = np.argsort(ids[low : low + 4096], kind="stable")
            own, part = ids[low : low + 4096][order], x[low : low + 4096][order]
            for at in range(0, len(q), 256):
                self._block(query_ids[at : at + 256], q[at : at + 256], own, part)

    def _block(self, query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """``ids`` ascend, so that rows of one id are neighbours."""
        down = _scale(q, x)
        q, x = q * down, x * down
        rough = _squares(q, x)
        # What rounding may do to a square, whose terms can be far larger than their difference.
        slack = 1e-12 * ((q**2).sum(axis=1) + (x**2).sum(axis=1).max(initial=0.0))
        rough[query_ids[:, None] == ids[None]] = np.inf
        firsts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        by_id = rough if len(firsts) == len(ids) else np.minimum.reduceat(rough, firsts, axis=1)
        for i, own in enumerate(query_ids.tolist()):
            best = self.found.get(own)
            row = rough[i]
            # The rough distance of a near vector may be off by rounding: all that could be among the nearest are measured.
            limit = np.partition(by_id[i], self.nearest - 1)[self.nearest - 1] if len(firsts) > self.nearest else np.inf
            if best is not None and len(best[0]) == self.nearest:
                limit = min(limit, (best[0][-1] * down) ** 2)
            near = np.flatnonzero((row <= limit * (1 + 1e-12) + 2 * slack[i]) & np.isfinite(row))
            if not len(near):
                continue
            exact, near_ids = np.sqrt(((x[near] - q[i]) ** 2).sum(axis=1)) / down, ids[near]
            if best is not None:
                exact, near_ids = np.concatenate([best[0], exact]), np.concatenate([best[1], near_ids])
            order = np.lexsort([near_ids, exact])
            exact, near_ids = exact[order], near_ids[order]
            _, first = np.unique(near_ids, return_index=True)
            first = np.sort(first)[: self.nearest]
            self.found[own] = exact[first], near_ids[first]

    def batch(self) -> pa.RecordBatch:
        sizes = [len(d) for d, _ in self.found.values()]
        queries = np.repeat(np.array(list(self.found), np.int64), np.array(sizes, np.int64))
        empty = [(np.empty(0), np.empty(0, np.int64))]
        scores, ids = (np.concatenate(c) for c in zip(*(list(self.found.values()) or empty)))
        return pa.RecordBatch.from_arrays([pa.array(queries), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])


FOUND = "query_id long, vec_id long, score double"


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _compared(size: int, nearest: int):
    """Nearest vectors per query among those that share a bucket (piece) in this task."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.asarray(b.column(0)), np.asarray(b.column(1)), np.asarray(b.column(2)), _matrix(b.column(3), size), b.column(4).to_numpy(zero_copy_only=False)) for b in batches]
        if not parts:
            return
        key, salt, ids, x, probe = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort([probe, salt, key])
        key, salt, ids, x, probe = key[order], salt[order], ids[order], x[order], probe[order]
        edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]), [True]]))
        best = Best(nearest)
        for a, b in zip(edges[:-1], edges[1:]):
            middle = a + int(np.searchsorted(probe[a:b], True))
            if a < middle < b:
                best.compare(ids[middle:b], x[middle:b], ids[a:middle], x[a:middle])
        yield best.batch()

    return compare


def _against(queries: list, size: int, nearest: int):
    """Nearest of this task's vectors for each of a bounded set of queries."""
    query_ids = np.array([r["vec_id"] for r in queries], np.int64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, q = vectors(pa.array([r["embedding"] for r in queries], pa.list_(pa.float64())), size)
        best = Best(nearest)
        for batch in batches:
            own, x = vectors(batch.column(1), size)
            if len(own):
                best.compare(query_ids[rows], q, np.asarray(batch.column(0))[own], x)
        yield best.batch()

    return compare


def _top(found: DataFrame, nearest: int) -> DataFrame:
    own = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return own.withColumn("rank", place).where(F.col("rank") <= nearest)


def search(rows: DataFrame, queries: DataFrame, p: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest vectors found. Both tables have vec_id and embedding."""
    spark = rows.sparkSession
    index = fit(rows, p)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = index.lines.shape[1]
    rows = rows.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    queries = queries.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    schema = "key long, id long, vector binary"
    stored = rows.mapInArrow(_spell(index, size, False), schema)
    visits = queries.mapInArrow(_spell(index, size, True), schema)

    sizes = stored.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)
    hot = materialize(sizes.select("key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("pieces")), "hot-buckets")
    side = F.broadcast(hot) if hot.count() <= SENT_ROWS else hot
    pieces = F.coalesce("pieces", F.lit(1))
    cut = stored.join(side, "key", "left").select("key", F.pmod(F.xxhash64("id"), pieces).cast("int").alias("salt"), "id", "vector", F.lit(False).alias("probe"))
    sent = visits.join(side, "key", "left").select("key", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("salt"), "id", "vector", F.lit(True).alias("probe"))
    many = rows.count() * len(index.lines) + queries.count() * len(index.lines) * index.visits
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(many / PART_ROWS))
    met = cut.unionByName(sent).repartition(parts, "key", "salt")
    found = materialize(met.mapInArrow(_compared(size, p.nearest), FOUND), "neighbours") if index.visits else spark.createDataFrame([], FOUND)
    top = _top(found, p.nearest)

    # Queries that found too few are compared with all vectors, a bounded number at a time.
    enough = top.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= p.nearest).select(F.col("query_id").alias("vec_id"))
    short = materialize(queries.join(enough, "vec_id", "left_anti"), "short-queries")
    blocks = math.ceil(short.count() / SENT_ROWS * 1.2)
    for block in range(blocks):
        own = short.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        rest = rows.mapInArrow(_against(own, size, p.nearest), FOUND)
        found = found.unionByName(materialize(rest, "neighbours"))
    return _top(found, p.nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_hundredths(rows: DataFrame) -> DataFrame:
    """The neighbours of all rows whose id is divisible by 100."""
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))
