"""Centroid clustering on whole numbers, with heap-ordered bounds.

A component x becomes floor(scale * x). Each vector belongs to the nearest centroid by squared Euclidean distance, ties to
the smaller number; a round replaces each centroid that has vectors by the componentwise floor of their mean.

Rounds don't compare every vector with every centroid. When a vector is scanned, the gap between its distance to the second
nearest and to the nearest centroid is kept. Centroids drift; by the triangle inequality the nearest one stays nearest as long
as the gap exceeds the drift of the own centroid and the largest drift of the others, added up since the scan. These sums
are one number per cluster, so gaps are stored as the sum at which they expire, and each cluster's vectors form a
heap of them: those at the top that have expired are popped and scanned exactly, the others are not touched. Rounding of
distances is allowed for by a margin, which only makes for more scans.

The state of a vector is a row of a table in the shared folder, rewritten once a round without a shuffle. Sums per cluster are
kept from round to round; tasks add up only the vectors that moved, at most two rows per cluster and component each.
The driver holds the centroids and one sum and one drift per cluster.

Vectors that are null, of another length, or with a null or non-finite component take no part and have no row in the result.
Whole numbers beyond 2^62 are cut there; squared distances and their sums beyond a long are given as its largest value.
Initial centroids are the vectors whose digests of seed and id come first; of equal digests (repeated ids) the smaller vector. A null id counts as
an empty text there. Fewer vectors than clusters make fewer clusters; equal centroids are allowed, the smaller number
takes the vectors. Repeated rows are vectors like others. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from heapq import heapify, heappop

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.sources.sinks import materialize

#: Components up to which squared distances are added up in 64 bits.
SMALL = 1 << 26
LIMIT = 1 << 62
LONGEST = (1 << 63) - 1
#: Allowance for rounding, relative to the distances.
MARGIN = 1e-9
#: Vectors scanned at once.
SCANNED = 4_096

_STATE = "vec_id long, x array<long>, cluster int, expires double, was int"
_MOVED = "cluster int, at int, n long, total decimal(38,0)"


@dataclass(frozen=True)
class Params:
    clusters: int = 16
    rounds: int = 3
    size: int = 64
    scale: int = 64
    seed: int = 1


def numbers(embedding: Column, p: Params) -> Column:
    """The vector as whole numbers; null if it takes no part."""
    x = embedding.cast("array<double>")
    fits = (F.size(x) == p.size) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    most = F.lit(float(LIMIT))
    return F.when(fits, F.transform(x, lambda c: F.floor(F.greatest(-most, F.least(most, c * float(p.scale))))))


def seeds(rows: DataFrame, p: Params) -> np.ndarray:
    """The initial centroids of rows (vec_id, x)."""
    digest = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = rows.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(p.clusters).collect()
    return np.array([r["x"] for r in found], dtype=object).reshape(-1, p.size)


def _fitting(*parts: np.ndarray) -> type:
    """Machine numbers if squared distances fit, else Python's."""
    most = max((max(-int(a.min()), int(a.max())) for a in parts if a.size), default=0)
    return np.int64 if most <= SMALL else object


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column per centroid."""
    kind = _fitting(x, centroids)
    x, centroids = x.astype(kind, copy=False), centroids.astype(kind)
    out = np.empty((len(x), len(centroids)), kind)
    for i, c in enumerate(centroids):
        d = x - c
        out[:, i] = (d * d).sum(axis=1)
    return out


def scanned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, gap to the second nearest less a margin) of each vector."""
    cluster, gap = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
    for at in range(0, len(x), SCANNED):
        own = slice(at, at + SCANNED)
        far = squares(x[own], centroids)
        cluster[own] = far.argmin(axis=1)
        if far.shape[1] > 1:
            near, second = np.sqrt(np.sort(far, axis=1)[:, :2].astype(np.float64)).T
            gap[own] = second - near - MARGIN * (second + near)
    return cluster, gap


def expired(cluster: np.ndarray, expires: np.ndarray, drifted: np.ndarray) -> np.ndarray:
    """Rows whose gap their cluster's drift has used up, popped from the clusters' heaps."""
    out: list[int] = []
    order = np.argsort(cluster, kind="stable")
    cuts = np.searchsorted(cluster[order], np.arange(len(drifted) + 1))
    for k, limit in enumerate(drifted.tolist()):
        own = order[cuts[k] : cuts[k + 1]]
        heap = list(zip(expires[own].tolist(), own.tolist()))
        heapify(heap)
        while heap and heap[0][0] <= limit:
            out.append(heappop(heap)[1])
    return np.array(sorted(out), np.int64)


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _states(ids: pa.Array, x: pa.Array, cluster: np.ndarray, expires: np.ndarray, was: pa.Array) -> pa.RecordBatch:
    columns = [ids, x, pa.array(cluster, pa.int32()), pa.array(expires, pa.float64()), was]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "cluster", "expires", "was"])


def _begun(centroids: np.ndarray, p: Params):
    """First assignment of rows (vec_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, gap = scanned(_vectors(batch.column(1), p.size), centroids)
            yield _states(batch.column(0), batch.column(1), cluster, gap, pa.nulls(len(batch), pa.int32()))

    return run


def _moved_on(centroids: np.ndarray, drifted: np.ndarray, p: Params):
    """Next assignment of states: only vectors whose gap expired are scanned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            was = batch.column(2)
            cluster, expires = was.to_numpy().astype(np.int64), batch.column(3).to_numpy().copy()
            again = expired(cluster, expires, drifted)
            if len(again):
                cluster[again], gap = scanned(_vectors(batch.column(1).take(pa.array(again)), p.size), centroids)
                expires[again] = gap + drifted[cluster[again]]
            yield _states(batch.column(0), batch.column(1), cluster, expires, was)

    return run


def _sums(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """What vectors that moved add to their cluster's sums, and take from the one they left."""
    total: dict[int, np.ndarray] = {}
    many: dict[int, int] = {}
    for batch in batches:
        x = _vectors(batch.column(0), p.size)
        for column, sign in ((1, 1), (2, -1)):
            side = batch.column(column).to_numpy(zero_copy_only=False)
            for k in np.unique(side[~np.isnan(side)]) if side.dtype.kind == "f" else np.unique(side):
                rows = x[side == k]
                if _fitting(rows) is object:
                    rows = rows.astype(object)
                total[int(k)] = total.get(int(k), 0) + sign * rows.sum(axis=0).astype(object)
                many[int(k)] = many.get(int(k), 0) + sign * len(rows)
    for k, sums in total.items():
        columns = [
            pa.array([k] * p.size, pa.int32()),
            pa.array(range(p.size), pa.int32()),
            pa.array([many[k]] * p.size, pa.int64()),
            pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "at", "n", "total"])


def change(states: DataFrame, p: Params, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors gained, sums gained) of each cluster since the round before."""
    moved = states.where("was is null or was <> cluster").select("x", "cluster", "was")
    added = moved.mapInArrow(lambda b: _sums(b, p), _MOVED).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    n, total = np.zeros(most, dtype=object), np.zeros((most, p.size), dtype=object)
    for r in added.collect():  # a row per cluster and component
        n[r["cluster"]], total[r["cluster"], r["at"]] = r["n"], int(r["total"])
    return n, total


def drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Of each cluster: how far its centroid moved, plus the largest move of another one; rounded up."""
    moves = np.array([float(((a - b) ** 2).sum()) ** 0.5 for a, b in zip(old, new)])
    others = np.array([np.delete(moves, i).max(initial=0.0) for i in range(len(moves))])
    return (moves + others) * (1 + MARGIN)


@dataclass(frozen=True)
class Clustering:
    """Final centroids, and the stored state (vec_id, x, cluster) of each vector that takes part."""

    centroids: np.ndarray
    states: DataFrame


def cluster(vectors: DataFrame, p: Params = Params()) -> Clustering:
    """Clusters rows (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), numbers(F.col("embedding"), p).alias("x")).where("x is not null")
    centroids = seeds(rows, p)
    if not len(centroids):
        return Clustering(centroids, rows.select("*", F.lit(0).alias("cluster")))
    n, total = np.zeros(len(centroids), dtype=object), np.zeros((len(centroids), p.size), dtype=object)
    drifted = np.zeros(len(centroids))
    states = materialize(rows.mapInArrow(_begun(centroids, p), _STATE), "clusters")
    for _ in range(p.rounds):
        gained, sums = change(states, p, len(centroids))
        n, total = n + gained, total + sums
        new = np.array([t // k if k else c for t, k, c in zip(total, n, centroids)], dtype=object)
        drifted = drifted + drift(centroids, new)
        centroids = new
        states = materialize(states.select("vec_id", "x", "cluster", "expires").mapInArrow(_moved_on(centroids, drifted, p), _STATE), "clusters")
    return Clustering(centroids, states)


def _distances(centroids: np.ndarray, p: Params):
    """Squared distance of each vector to its centroid."""

    @F.arrow_udf("long")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, own in batches:
            x, own = _vectors(x, p.size), centroids[own.to_numpy()]
            kind = _fitting(x, own)
            d = x.astype(kind) - own.astype(kind)
            yield pa.array(np.minimum((d * d).sum(axis=1), LONGEST).astype(np.int64))

    return run


def assigned(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per vector that takes part: cluster, distance, inertia of the cluster and of all, digest of the centroid."""
    found = cluster(vectors, p)
    spark = vectors.sparkSession
    distance = _distances(found.centroids, p)("x", "cluster") if len(found.centroids) else F.lit(0).cast("long")
    done = materialize(found.states.select("vec_id", "cluster", distance.alias("distance")), "assigned")
    inertia = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = min(LONGEST, sum(inertia.values()))
    facts = [(k, min(LONGEST, d), whole, hashlib.sha256(",".join(map(str, found.centroids[k])).encode()).hexdigest()) for k, d in sorted(inertia.items())]
    # A row per cluster.
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(p: Params = Params()) -> str:
    """SQL of the same rounds, without bounds."""
    places = f"range(1, {p.size + 1})"
    steps = [
        f"""k AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda v: CAST(floor({p.scale} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {p.size} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {p.size})""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('{p.seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS cluster, x FROM k
  ORDER BY cluster LIMIT {p.clusters})""",
    ]
    for r in range(p.rounds + 1):
        steps.append(f"""a{r} AS (SELECT id, vec_id, x, min({{'d': d, 'cluster': cluster}}) AS best FROM (SELECT id, vec_id, k.x, cluster,
  list_sum(list_transform({places}, lambda i: (k.x[i] - c{r}.x[i]) * (k.x[i] - c{r}.x[i]))) AS d FROM k, c{r}) GROUP BY ALL)""")
        if r < p.rounds:
            steps.append(f"""c{r + 1} AS (SELECT cluster, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
    SELECT best.cluster AS cluster, i, CAST(sum(x[i]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
    FROM a{r}, (SELECT unnest({places}) AS i) GROUP BY 1, 2) GROUP BY cluster) m USING (cluster))""")
    last = p.rounds
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(best.cluster AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{last}.x, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON c{last}.cluster = best.cluster"""


ORACLE = _oracle()
