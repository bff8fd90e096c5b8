"""Clustering against a version without bounds, and the bounds themselves."""

import hashlib
import math

import numpy as np
import pytest

from lendstrata.llm import clusters as cl

SCHEMA = "vec_id long, embedding array<double>, label int, x string, cluster string, was int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", "c", 2) for i, v in rows], SCHEMA)


def brute(rows, p):
    """Sorted (vec_id, cluster, distance, inertia of the cluster, inertia) with Python's whole numbers."""
    kept = [(i, [math.floor(p.scale * c) for c in v]) for i, v in rows if v is not None and len(v) == p.size and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{p.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[: p.clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))

    for _ in range(p.rounds):
        own = [nearest(x)[1] for _, x in kept]
        for k in range(len(centroids)):
            members = [x for (_, x), o in zip(kept, own) if o == k]
            if members:
                centroids[k] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(x)) for i, x in kept]
    out = []
    for i, d, k in found:
        sha = hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
        out.append((i, k, min(d, cl.LONGEST), min(cl.LONGEST, sum(e for _, e, o in found if o == k)), min(cl.LONGEST, sum(e for _, e, _ in found)), sha))
    return sorted(out, key=str)


def got(spark, rows, p):
    out = cl.assigned(frame(spark, rows), p)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_against_all_distances(spark):
    rng = np.random.default_rng(5)
    p = cl.Params(clusters=5, rounds=4, size=3, scale=8)
    centres = rng.normal(size=(6, 3)) * 4
    rows = [(i, (centres[i % 6] + rng.normal(size=3)).tolist()) for i in range(300)]
    assert got(spark, rows, p) == brute(rows, p)


def test_ties_copies_and_rows_without_part(spark):
    p = cl.Params(clusters=4, rounds=3, size=2, scale=1)
    rows = [(i, [i % 3, 0]) for i in range(12)] + [(3, [0, 0]), (3, [0, 0]), (3, [5, 5]), (None, [1, 1]), (None, [1, 1])]
    want = brute(rows, p)
    rows += [(50, None), (51, []), (52, [1]), (53, [1, 2, 3]), (54, [1, None]), (55, [math.nan, 1]), (56, [math.inf, 0]), (None, None)]
    assert got(spark, rows, p) == want == brute(rows, p) and len(want) == 17


def test_very_large_components(spark):
    p = cl.Params(clusters=2, rounds=2, size=2, scale=1)
    rows = [(i, [i, -i]) for i in range(6)] + [(i, [2.0**40 + i, 0.5]) for i in range(6, 9)]
    assert got(spark, rows, p) == brute(rows, p)
    beyond = got(spark, rows + [(20, [1e300, -1e300])], p)
    assert len(beyond) == 10 and all(0 <= r[2] <= cl.LONGEST for r in beyond)


def test_few_and_no_vectors(spark):
    p = cl.Params(clusters=16, rounds=3, size=2, scale=64)
    rows = [(1, [0.5, -0.5]), (2, [0.25, 1])]
    assert got(spark, rows, p) == brute(rows, p)
    assert got(spark, [], p) == got(spark, [(1, None)], p) == []


def test_only_expired_gaps_are_scanned():
    """Rounds by bounds in numpy: the same clusters as by all distances, from far fewer scans on vectors that lie in clumps."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 4)) * 2_000
    x = (centres[rng.integers(8, size=4_000)] + rng.normal(size=(4_000, 4)) * 60).astype(np.int64)
    centroids = np.array([x[np.flatnonzero(((x - c) ** 2).sum(1) < 60_000)[0]] for c in centres], dtype=object)
    own, expires = cl.scanned(x, centroids)
    drifted, scans = np.zeros(8), []
    for _ in range(4):
        new = np.array([[int(s) // int((own == k).sum()) for s in x[own == k].sum(0)] for k in range(8)], dtype=object)
        drifted = drifted + cl.drift(centroids, new)
        centroids = new
        again = cl.expired(own, expires, drifted)
        scans.append(len(again))
        own[again], gap = cl.scanned(x[again], centroids)
        expires[again] = gap + drifted[own[again]]
        assert (own == cl.squares(x, centroids).argmin(axis=1)).all()
    assert max(scans) < 400


@pytest.mark.parametrize("limit", [0.0, 1.5, math.inf])
def test_heaps_give_what_has_expired(limit):
    rng = np.random.default_rng(2)
    own, expires = rng.integers(3, size=200), rng.normal(size=200)
    want = np.flatnonzero(expires <= np.array([limit, 0.0, -9.0])[own])
    assert cl.expired(own, expires, np.array([limit, 0.0, -9.0])).tolist() == want.tolist()
