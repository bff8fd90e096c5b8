"""Drift from stored sketches and from a stream, and the chi-square tail."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from lendstrata.operators import drift, sketches
from lendstrata.streaming import drift as stream


# ---- chi-square -----------------------------------------------------------


def brute_tail(x, k):
    """Finite sums for whole numbers of degrees of freedom, in logarithms."""
    half = x / 2
    if k % 2 == 0:
        logs = [j * math.log(half) - half - math.lgamma(j + 1) for j in range(k // 2)]
        rest = 0.0
    else:
        logs = [(j + 0.5) * math.log(half) - half - math.lgamma(j + 1.5) for j in range(k // 2)]
        rest = math.erfc(math.sqrt(half))
    return rest + math.fsum(math.exp(v) for v in logs)


@pytest.mark.parametrize("k", [1, 2, 3, 10, 99, 200, 201, 1000, 20_001, 300_000])
def test_chi_square_tail(spark, k):
    xs = [max(0.01, k + z * math.sqrt(2 * k)) for z in (-6, -2, -0.5, 0, 0.01, 1, 3, 8)]
    df = spark.createDataFrame([(x, k) for x in xs], "x double, k long")
    got = [r[0] for r in df.select(drift.chi2_p(F.col("x"), F.col("k"))).collect()]
    assert got == pytest.approx([brute_tail(x, k) for x in xs], rel=1e-6, abs=1e-11)


def test_chi_square_tail_at_its_ends(spark):
    df = spark.createDataFrame([(None, 3), (5.0, None), (0.0, 3), (5.0, 0), (float("inf"), 3), (1e6, 2)], "x double, k long")
    got = [r[0] for r in df.select(drift.chi2_p(F.col("x"), F.col("k"))).collect()]
    assert got == [None, None, 1.0, 1.0, 0.0, 0.0]


# ---- sketches -------------------------------------------------------------


@pytest.fixture(scope="module")
def two_sides(spark):
    rng = random.Random(4)
    rows = []
    for i in range(30_000):
        side = i % 2
        rows.append((side, i % 10, rng.gauss(0.4 * side, 1), float(rng.randrange(4 + side)), None if i % 3 else rng.random(), 1.0 if side else None))
    return spark.createDataFrame(rows, "side int, day int, a double, b double, c double, d double").repartition(4).cache()


def test_merged_sketches_are_near_the_exact_statistics(two_sides):
    names = ["a", "b", "c", "d"]
    days = sketches.numeric_sketches(two_sides, names, F.struct("side", "day")).cache()
    assert days.count() == 10 * 4 and days.where("feature = 'a'").agg(F.sum("present")).first()[0] == 30_000
    ref, cur = (sketches.merge_sketches(days.where(F.col("batch.side") == i)) for i in (0, 1))
    got = {r["feature"]: r for r in sketches.drift_sketched(ref, cur).collect()}
    exact = drift.drift_numeric(two_sides.where("side = 0"), two_sides.where("side = 1"), names)
    for r in exact.collect():
        own = got[r["feature"]]
        assert (own["n_ref"], own["n_cur"], own["drifted"]) == (r["n_ref"], r["n_cur"], r["drifted"])
        if r["feature"] == "d":  # values on one side only
            assert own["ks_statistic"] is None and own["drifted"] == 1
            continue
        assert abs(own["ks_statistic"] - r["ks_statistic"]) <= sketches.statistic_error()
        assert abs(own["wasserstein"] - r["wasserstein"]) <= own["wasserstein_error"]
        assert own["mean_shift"] == pytest.approx(r["mean_shift"])
    assert sketches.statistic_error() < 0.01


def test_merging_is_the_same_in_any_order_of_batches(two_sides):
    """Merged counts and moments are exact; quantiles stay within the bound whatever was merged first."""
    days = sketches.numeric_sketches(two_sides, ["a"], F.col("day")).cache()
    whole = sketches.merge_sketches(days).first()
    halves = [sketches.merge_sketches(days.where(f"batch % 2 = {i}")) for i in (0, 1)]
    again = sketches.merge_sketches(halves[0].unionByName(halves[1])).first()
    assert whole["present"] == again["present"] == 30_000 and whole["total"] == pytest.approx(again["total"])
    assert (whole["low"], whole["high"]) == (again["low"], again["high"])


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None, float("nan"))], "day int, a double, b double")
    days = sketches.numeric_sketches(df, ["a", "b"], F.col("day"))
    assert {(r["feature"], r["rows"], r["present"]) for r in days.collect()} == {("a", 1, 0), ("b", 1, 0)}
    none = sketches.merge_sketches(days)
    assert none.count() == 0 and sketches.drift_sketched(none, none).count() == 0


# ---- stream ---------------------------------------------------------------

EDGES, TEXTS = {"x": [1.0, 2.0]}, {"t": ["a"]}
SCHEMA = "at timestamp, x double, t string"


def lines(folder, name, rows):
    with open(f"{folder}/{name}.json", "w") as f:
        for at, x, t in rows:
            f.write(json.dumps({"at": at, "x": x, "t": t}) + "\n")


def test_stream_counts_once_with_late_rows_and_restarts(spark, tmp_path):
    source, out = tmp_path / "in", f"{tmp_path}/out"
    source.mkdir()

    def run():
        rows = spark.readStream.schema(SCHEMA).json(str(source))
        counts = stream.window_counts(rows, "at", EDGES, TEXTS, "1 hour", "30 minutes")
        query = stream.count_stream(counts, out)
        query.awaitTermination()
        found = spark.read.parquet(out).select("window_start", "feature", "bin", "n").collect()
        return {(r["window_start"].hour, r["feature"], r["bin"]): r["n"] for r in found}, len(found)

    lines(source, "1", [("2024-01-01T10:05:00Z", 0.5, "a"), ("2024-01-01T10:50:00Z", 1.5, "b"), ("2024-01-01T11:10:00Z", None, None)])
    got, many = run()
    assert got == {} and many == 0  # 10:00 to 11:00 is open until 11:30 is seen
    lines(source, "2", [("2024-01-01T10:59:00Z", 9.0, "a"), ("2024-01-01T11:40:00Z", 2.0, "a")])  # late, but within the watermark
    ten = {(10, "x", "0"): 1, (10, "x", "1"): 1, (10, "x", "2"): 1, (10, "t", "=a"): 2, (10, "t", "other"): 1}
    got, many = run()
    assert got == ten and many == 5
    lines(source, "3", [("2024-01-01T10:20:00Z", 0.1, "a"), ("2024-01-01T13:00:00Z", 0.1, "a")])  # later than the watermark: left out
    eleven = {(11, "x", "missing"): 1, (11, "x", "1"): 1, (11, "t", "missing"): 1, (11, "t", "=a"): 1}
    got, many = run()
    assert got == ten | eleven and many == 9
    got, many = run()  # nothing new
    assert got == ten | eleven and many == 9


def test_windows_against_a_reference(spark):
    reference = spark.createDataFrame([(x / 10, "a" if x % 2 else None) for x in range(40)], "x double, t string")
    base = stream.reference_counts(reference, EDGES, TEXTS)
    rows = [("2024-01-01 10:00:00", x / 10, "a" if x % 2 else None) for x in range(40)] + [("2024-01-01 11:00:00", 9.0, "new")] * 5
    table = spark.createDataFrame(rows, "at string, x double, t string").withColumn("at", F.col("at").cast("timestamp"))
    counts = stream.window_counts(table, "at", EDGES, TEXTS, "1 hour")
    got = {(r["window_start"].hour, r["feature"]): r for r in stream.window_drift(counts, base).collect()}
    assert len(got) == 4
    for f in ("x", "t"):
        assert got[10, f]["chi_square"] == 0 and got[10, f]["jensen_shannon"] == 0 and got[10, f]["drifted"] == 0
        assert got[11, f]["drifted"] == 1 and got[11, f]["n_cur"] == 5
    assert got[11, "t"]["chi_square"] == float("inf") and got[11, "t"]["chi_square_p"] == 0
    share = {"0": 11 / 40, "1": 10 / 40, "2": 19 / 40}
    assert got[11, "x"]["chi_square"] == pytest.approx(sum((5 * (b == "2") - 5 * p) ** 2 / (5 * p) for b, p in share.items()))


def test_edges_and_texts_of_a_reference(spark):
    df = spark.createDataFrame([(float(i % 100), "t" + str(i % 3), None) for i in range(1000)], "x double, t string, n double")
    edges = stream.bin_edges(df, ["x", "n"], 4)
    assert edges["n"] == [] and edges["x"] == pytest.approx([24, 49, 74], abs=1.5)
    assert stream.known_texts(df, ["t"], 2) == {"t": ["t0", "t1"]}
