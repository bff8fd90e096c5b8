"""The paths for hot keys and large tables must give what the simple paths give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lendstrata.operators import evaluate, folds, history, ordered
from lendstrata.operators.ordered import hot_keys, lag_within, lookup, quantiles, running, value_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, with many equal months and missing values."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        key = 1 if i < 2000 else rng.randrange(2, 400)
        rows.append((key, rng.randrange(-3, 0), i, None if rng.random() < 0.2 else rng.random()))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, month int, tie int, v double").repartition(5).cache()


def test_hot_keys_are_found(skewed):
    assert [tuple(r) for r in hot_keys(skewed, "k", 100).table.collect()] == [(1, 2000)]
    assert hot_keys(skewed, "k", 10_000).rows == 0


def test_many_small_hot_keys_are_all_cut(spark):
    """200 keys of 0.4 % each beside a long tail: none stays whole."""
    rows = [(i % 200, i % 7, i, float(i % 13)) for i in range(8000)] + [(1000 + i, 0, i, 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, month int, tie int, v double").repartition(4)
    assert hot_keys(df, "k", 30).rows == 200
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("month", "tie")))
    cut = lag_within(df, "k", ["month", "tie"], "v", "p", hot_rows=30)
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_lag_of_a_hot_key(skewed):
    plain = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("month", "tie")))
    cut = lag_within(skewed, "k", ["month", "tie"], "v", "p", hot_rows=150)
    assert "_piece" not in cut.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_lag_does_not_depend_on_partitions(skewed):
    def run(df):
        return sorted(map(str, lag_within(df, "k", ["month", "tie"], "v", "p", 150).collect()))

    assert run(skewed) == run(skewed.repartition(11, "tie"))


def test_many_pieces(spark):
    """One key only, cut into several blocks of pieces."""
    df = spark.range(8000).select(
        F.lit(1).alias("k"), (F.col("id") % 90).alias("month"), F.xxhash64("id").alias("tie"), F.rand(1).alias("v")
    ).repartition(3).cache()
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("month", "tie")))
    cut = lag_within(df, "k", ["month", "tie"], "v", "p", hot_rows=20)
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_rows_without_a_key_have_no_previous_value(spark, skewed):
    for share in (0.3, 0.001):
        df = skewed.withColumn("k", F.when(F.col("tie") % 1000 >= 1000 * share, F.col("k")))
        plain = df.withColumn("p", F.when(F.col("k").isNotNull(), F.lag("v").over(Window.partitionBy("k").orderBy("month", "tie"))))
        for rows in (150, 10_000):
            cut = lag_within(df, "k", ["month", "tie"], "v", "p", hot_rows=rows)
            assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_running_in_buckets(spark):
    rng = random.Random(5)
    rows = [(g, float(x), rng.randrange(5), rng.randrange(5)) for g in "ab" for x in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, x double, m int, n int")
    small = running(df, ["g"], "x", ["m", "n"])
    large = running(df, ["g"], "x", ["m", "n"], bucket_rows=10)
    order = small.columns
    assert sorted(map(tuple, large.select(order).collect()), key=str) == sorted(map(tuple, small.collect()), key=str)
    one = running(df.where("g = 'a'").drop("g"), [], "x", ["m"], bucket_rows=10)
    assert one.agg(F.max("m_before")).first()[0] > 0


def test_installments_of_a_hot_loan(spark):
    rng = random.Random(13)
    rows = [
        (
            1 if i % 3 == 0 else rng.randrange(2, 300),
            rng.randrange(1, 40),
            rng.choice([None, 0.0, 1.0, 2.0]),
            float(rng.randrange(-800, 0)),
            rng.choice([None, float(rng.randrange(-800, 0))]),
            float(rng.randrange(100)),
            rng.choice([None, float(rng.randrange(100))]),
        )
        for i in range(4500)
    ]
    df = spark.createDataFrame(
        rows,
        "SK_ID_PREV int, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT double, "
        "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    )
    placed, combined = history.install_loan(df), history.install_loan(df.repartition(7), hot_rows=1000)
    plain, split = (x._jdf.queryExecution().executedPlan().toString() for x in (placed, combined))
    assert "REPARTITION_BY_COL" in plain and "LeftAnti" not in plain and "max_by" not in plain
    assert "REPARTITION_BY_COL" in split and "LeftAnti" in split and "LeftSemi" in split and "max_by" in split

    def rounded(out):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.fillna(-1e6).collect())

    assert rounded(placed) == rounded(combined)


def _auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_all_pairs(spark):
    rng = random.Random(9)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    rows += [(0.5, 0)] * 200  # one score holds a third of the rows
    df = spark.createDataFrame(rows, "s double, y int")
    want = _auc(rows)
    assert evaluate.auc(df, "s", "y").first()[0] == pytest.approx(want, abs=1e-12)
    assert evaluate.auc(df, "s", "y", bucket_rows=5).first()[0] == pytest.approx(want, abs=1e-12)
    assert evaluate.auc(df.where("y = 1"), "s", "y").first()[0] is None


def test_quantiles_against_sorted_values(spark):
    rng = random.Random(11)
    xs = [rng.gauss(0, 1) for _ in range(501)] + [0.25] * 250
    df = spark.createDataFrame([(x, None if i % 3 else x) for i, x in enumerate(xs)], "x double, y double")

    def exact(vals, q):
        vals = sorted(v for v in vals if v is not None)
        at = q * (len(vals) - 1)
        low, high = vals[int(at)], vals[min(int(at) + 1, len(vals) - 1)]
        return low + (high - low) * (at - int(at))

    for q in (0.5, 0.99, 0.0, 1.0):
        for options in ({}, {"bucket_rows": 3}):
            got = dict(quantiles(df, ["x", "y"], q, **options).collect())
            for c in ("x", "y"):
                assert got[c] == pytest.approx(exact([r[c] for r in df.collect()], q), abs=1e-12)


def test_folds_are_even_within_labels(spark):
    df = spark.range(5003).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    out = folds.stratified_folds(df, "id", "label", k=5)
    sizes = out.groupBy("label", "fold").count().groupBy("label").agg(F.max("count") - F.min("count")).collect()
    assert out.count() == 5003 and all(r[1] <= 1 for r in sizes)
    again = folds.stratified_folds(df.repartition(9), "id", "label", k=5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_lookup_is_broadcast_only_in_its_bound(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 2)
    big = spark.range(1000)
    small, large = lookup(df), lookup(df, max_bytes=10)
    assert small.small and not large.small
    joined = big.join(large.side(), "id", "left")
    assert joined.where("v IS NOT NULL").count() == 50


def test_value_counts_leave_missing_out(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (3, 2.0)], "a int, b double")
    got = sorted(map(tuple, value_counts(df, ["a", "b"]).collect()))
    assert got == [("a", 1.0, 2), ("a", 3.0, 1), ("b", 2.0, 2)]


def test_default_bounds_are_finite():
    assert ordered.BROADCAST_BYTES <= 100_000_000 and ordered.BUCKET_ROWS <= 10_000_000


def test_hot_keys_are_counted_alone_only_where_places_are_full(spark, skewed, monkeypatch):
    """Places that hold several keys, the missing key, and no count per key where no place is full."""
    df = skewed.withColumn("k", F.when(F.col("tie") % 50 != 0, F.col("k")))
    counts = {r[0]: r[1] for r in df.groupBy("k").count().collect()}
    stored = []
    real = ordered.lookup
    monkeypatch.setattr(ordered, "lookup", lambda table, *more: stored.append(table.columns) or real(table, *more))
    for places, each in ((65_536, 64), (1, 0), (3, 0)):
        monkeypatch.setattr(ordered, "HOT_PLACES", places)
        monkeypatch.setattr(ordered, "PLACES_EACH", each)
        for limit in (1, 12, 100, 1_900, 2_500):
            stored.clear()
            found = hot_keys(df, "k", limit)
            assert {r["k"]: r["hot_rows"] for r in found.table.collect()} == {k: n for k, n in counts.items() if n > limit}
            assert found.rows == sum(n > limit for n in counts.values())
            if places == 65_536:
                assert stored == ([["_place"], ["k", "hot_rows"]] if limit < 2_500 else [["_place"]])
