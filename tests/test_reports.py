"""Explanations, tiers and drift statistics on small cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lendstrata.operators import drift, evaluate, explain, target
from lendstrata.plans import monitoring

NAMES = ["EXT_SOURCE_2", "CREDIT_INCOME_RATIO", "AGE_YEARS"]


@pytest.fixture(scope="module")
def contributions(spark):
    return spark.createDataFrame([([0.3, -0.2, 0.1], [0.5, None, 33.12345])], "c array<double>, v array<double>")


def top(df, n):
    names = F.array(*[F.lit(x) for x in NAMES])
    return df.select(explain.top_factors(F.col("c"), names, F.col("v"), n).alias("t")).first()["t"]


def test_top_factors(contributions):
    out = top(contributions, 2)
    assert [tuple(f) for f in out] == [
        ("EXT_SOURCE_2", 0.3, "increases_risk", 0.5),
        ("CREDIT_INCOME_RATIO", -0.2, "decreases_risk", None),
    ]
    sizes = [abs(f["contribution"]) for f in top(contributions, 3)]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) == 3
    assert top(contributions, 3)[2]["feature_value"] == 33.1235


def test_texts(contributions):
    names = F.array(*[F.lit(x) for x in NAMES])
    factors = explain.top_factors(F.col("c"), names, F.col("v"), 2)
    out = explain.render_explanation(contributions, F.lit(0.07123), F.lit(0.08), F.lit("MEDIUM"), factors).first()
    assert out["explanation"].split("\n")[-2:] == [
        "  - EXT_SOURCE_2: increases default risk (value: 0.5), SHAP impact: 0.3",
        "  - CREDIT_INCOME_RATIO: decreases default risk (value: unknown), SHAP impact: -0.2",
    ]
    assert out["fallback"] == (
        "This application has a 7.12% estimated default probability and is classified as MEDIUM risk. "
        "Narrative explanation unavailable."
    )


def test_tiers(spark):
    df = spark.createDataFrame([(p,) for p in (0.0499, 0.05, 0.1499, 0.15, 0.2999, 0.3, None)], "p double")
    got = [r[0] for r in df.select(evaluate.risk_tier("p")).collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "VERY_HIGH", None]


def test_first_model_always_wins(spark):
    df = spark.createDataFrame([(0.2, 0), (0.8, 1)], "s double, y int")
    assert evaluate.compare_models(df, "s", None, "y").first()["promote"] == 1
    # a tie is not enough
    assert evaluate.compare_models(df.withColumn("t", F.col("s")), "s", "t", "y").first()["promote"] == 0


def test_target_encoding_by_hand(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 0, 1), ("b", 1, 1), (None, 0, 0)], "g string, y int, fold int")
    full = target.target_encode_full(df, ["g"], "y")
    assert full.global_mean == 0.5
    got = [r["g"] for r in full.transform(spark.createDataFrame([("a",), ("zz",), (None,)], "g string")).collect()]
    assert got == pytest.approx([(1 + 5) / 12, 0.5, 0.5])
    folds = target.target_encode_folds(df, ["g"], "y", "fold", k=2)
    out = {(r["fold"], i): r["g"] for i, r in enumerate(folds.out_of_fold(df).orderBy("fold", "y").collect())}
    # fold 0 is encoded from fold 1 (mean 0.5), fold 1 from fold 0 (mean 0.5)
    assert list(out.values()) == pytest.approx([0.5, (0 + 5) / 11, (1 + 5) / 11, 0.5])


@pytest.mark.parametrize(
    "x, df, p",
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307, 10, 0.05), (0.0, 4, 1.0), (341.3951, 300, 0.05), (1e6, 150, 0.0)],
)
def test_chi_square_tail(spark, x, df, p):
    row = spark.createDataFrame([(x, df)], "x double, k int").select(drift.chi2_p(F.col("x"), F.col("k"))).first()
    assert row[0] == pytest.approx(p, abs=1e-5)


def test_vanished_features_are_drifted(spark):
    ref = spark.createDataFrame([(1.0, None, None, "a", None, True)] * 9, "x double, y double, z double, s string, t string, b boolean")
    cur = spark.createDataFrame([(None, 2.0, None, None, None, True)] * 9, "x double, y double, z double, s string, t string, b boolean")
    found = {r["feature"]: r for test in ("ks", "wasserstein") for r in drift.drift_numeric(ref, cur, ["x", "y", "z"], test).collect()}
    assert [found[c]["drifted"] for c in "xyz"] == [1, 1, 0]
    assert (found["x"]["n_ref"], found["x"]["n_cur"], found["x"]["ks_p"]) == (9, 0, None)
    words = {r["feature"]: r for r in drift.drift_categorical(ref, cur, ["s", "t", "b"], "chisquare").collect()}
    assert [words[c]["drifted"] for c in "stb"] == [1, 0, 0] and words["s"]["jensen_shannon"] is None
    report = monitoring.monitor(ref, cur)
    assert report.features.count() == 6 and report.summary.first()["n_drifted_features"] == 3


def test_missing_contributions_are_no_factors(spark):
    df = spark.createDataFrame([([0.5, None, -2.0], [1.0, 2.0, 3.0])], "c array<double>, v array<double>")
    assert [f["feature"] for f in top(df, 3)] == ["AGE_YEARS", "EXT_SOURCE_2"]


def test_any_number_of_factors(spark):
    names = F.array(*[F.lit(f"f{i}") for i in range(200)])
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: i.cast("double")).alias("c"))
    row = df.select(explain.top_factors(F.col("c"), names, F.col("c"), 100).alias("t")).first()
    assert len(row["t"]) == 100


@pytest.fixture(scope="module")
def two_samples():
    rng = random.Random(1)
    return [rng.gauss(0, 1) for _ in range(300)], [round(rng.gauss(0.5, 1), 1) for _ in range(200)]


def test_numeric_drift_by_hand(spark, two_samples):
    a, b = two_samples
    ref, cur = (spark.createDataFrame([(x,) for x in s], "x double") for s in two_samples)
    grid = sorted(set(a) | set(b))

    def cdf(s, v):
        return sum(x <= v for x in s) / len(s)

    ks = max(abs(cdf(a, v) - cdf(b, v)) for v in grid)
    distance = sum(abs(cdf(a, v) - cdf(b, v)) * (w - v) for v, w in zip(grid, grid[1:]))
    mean = sum(a) / len(a)
    std = math.sqrt(sum((x - mean) ** 2 for x in a) / len(a))
    for options in ({}, {"bucket_rows": 20}):
        out = drift.drift_numeric(ref, cur, ["x"], **options).first()
        assert out["ks_statistic"] == pytest.approx(ks, abs=1e-12)
        assert out["wasserstein"] == pytest.approx(distance / std, abs=1e-9)
        assert out["mean_shift"] == pytest.approx(sum(b) / len(b) - mean, abs=1e-9)
        assert out["drifted"] == 1
    assert drift.drift_numeric(ref, ref, ["x"], test="ks").first()["drifted"] == 0


def test_categorical_drift_by_hand(spark):
    ref = spark.createDataFrame([("a",)] * 60 + [("b",)] * 40, "g string")
    cur = spark.createDataFrame([("a",)] * 20 + [("b",)] * 25 + [("c",)] * 5, "g string")
    out = drift.drift_categorical(ref, cur, ["g"]).first()
    assert out["chi_square"] == pytest.approx((20 - 30) ** 2 / 30 + (25 - 20) ** 2 / 20)
    assert (out["new_categories"], out["lost_categories"], out["chi_square_p"]) == (1, 0, 0.0)
    p, q = (0.6, 0.4, 0.0), (0.4, 0.5, 0.1)
    js = math.sqrt(sum(x * math.log(2 * x / (x + y)) for s, t in ((p, q), (q, p)) for x, y in zip(s, t) if x) / 2)
    assert out["jensen_shannon"] == pytest.approx(js)
    two = drift.drift_categorical(ref, cur.where("g <> 'c'"), ["g"], test="z").first()
    pooled = (40 + 25) / 145
    z = (0.4 - 25 / 45) / math.sqrt(pooled * (1 - pooled) * (1 / 100 + 1 / 45))
    assert two["z_p"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-9)


def test_injected_drift_is_seen(spark):
    df = spark.range(500).select(F.rand(3).alias("u"), F.randn(4).alias("v"), F.randn(5).alias("w"))
    moved = drift.inject_drift(df)
    chosen = drift.drifted_columns(df.columns)
    assert len(chosen) == 1
    found = drift.drift_numeric(df, moved, df.columns)
    assert {r["feature"] for r in found.where("drifted = 1").collect()} == set(chosen)
    summary = drift.drift_summary(found, df, moved, df.columns).first()
    assert summary["n_drifted_features"] == 1 and summary["dataset_drift_detected"] == 0
    assert summary["share_missing_values_current"] == 0.0
