"""Distribution drift between a reference and a current table, over all rows.

Both sides are counted per feature and value in one pass; the statistics then need only these
counts. Tests and thresholds are arguments. Every listed feature has a row: one that is missing on one side
is drifted, one that is missing on both is not; their statistics are missing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import flag
from lendstrata.operators.columns import missing_profile, numeric_columns
from lendstrata.operators.ordered import running

# Defaults of the monitored report.
DRIFT_SHARE = 0.15
DRIFT_SHIFT = 1.5
P_VALUE = 0.05
DISTANCE = 0.1
DATASET_SHARE = 0.5
_SMALL_STD = 0.001


def drifted_columns(columns: list[str], share: float = DRIFT_SHARE, seed: int = 0) -> list[str]:
    """Seeded choice of the columns to shift, at least one."""
    n = max(1, int(len(columns) * share))
    return sorted(columns, key=lambda c: hashlib.md5(f"{c}:{seed}".encode()).hexdigest())[:n]


def inject_drift(
    df: DataFrame, columns: list[str] | None = None, share: float = DRIFT_SHARE, shift: float = DRIFT_SHIFT, seed: int = 0
) -> DataFrame:
    """Shift a seeded share of the numeric columns by a multiple of their deviation (test data)."""
    chosen = drifted_columns(columns or numeric_columns(df), share, seed)
    spread = df.agg(*[F.stddev_samp(c).alias(c) for c in chosen]).first()
    moved = {c: F.col(c) + F.lit(shift * spread[c]) for c in chosen if spread[c] and spread[c] > 0}
    return df.withColumns(moved) if moved else df


def _two_sides(reference: DataFrame, current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    def side(df: DataFrame, current_side: int) -> DataFrame:
        return df.select(*[F.col(c).cast(kind).alias(c) for c in columns], F.lit(current_side).alias("side"))

    return side(reference, 0).unionByName(side(current, 1))


def kolmogorov_p(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample KS statistic."""
    en = F.sqrt(F.try_divide(n * m, n + m))
    lam = (en + 0.12 + F.try_divide(F.lit(0.11), en)) * statistic
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * lam * lam * j * j),
    )
    series = 2 * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), series))
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), bounded)


def _listed(stats: DataFrame, columns: list[str], counts: list[str]) -> DataFrame:
    """A row for each listed feature; the counts of those without values are 0."""
    names = stats.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(stats, "feature", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def _vanished() -> Column:
    return (F.col("n_ref") == 0) != (F.col("n_cur") == 0)


def drift_numeric(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    test: str = "wasserstein",
    threshold: float | None = None,
    **options,
) -> DataFrame:
    """Per feature: KS statistic and p, Wasserstein distance over the reference deviation, mean shift.

    ``test`` names what decides ``drifted``: ``ks`` (p below 0.05) or ``wasserstein`` (0.1 or more).
    """
    numbered = [F.struct(F.lit(i).alias("feature"), F.col(c).alias("value")) for i, c in enumerate(columns)]
    long = _two_sides(reference, current, columns, "double").select("side", F.inline(F.array(*numbered)))
    by_value = (
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))
    )
    ranked = running(by_value, ["feature"], "value", ["ref", "cur"], **options)
    # one row per column name
    sums = ranked.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"),
        F.sum("cur").alias("n_cur"),
        (F.sum(F.col("value") * F.col("ref")) / F.nullif(F.sum("ref"), F.lit(0))).alias("mean_ref"),
        (F.sum(F.col("value") * F.col("cur")) / F.nullif(F.sum("cur"), F.lit(0))).alias("mean_cur"),
    )
    gap = F.abs(
        F.try_divide(F.col("ref_before") + F.col("ref"), F.col("n_ref"))
        - F.try_divide(F.col("cur_before") + F.col("cur"), F.col("n_cur"))
    )
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    deviation = (F.col("value") - F.col("mean_ref")) * (F.col("value") - F.col("mean_ref")) * F.col("ref")
    stats = (
        ranked.join(F.broadcast(sums), "feature")
        .groupBy("feature", "n_ref", "n_cur", "mean_ref", "mean_cur")
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.sum(gap * width).alias("_distance"),
            F.sqrt(F.try_divide(F.sum(deviation), F.col("n_ref"))).alias("_std"),
        )
    )
    named = F.get(F.array(*[F.lit(c) for c in columns]), F.col("feature")).alias("feature")
    with_tests = stats.select(
        named,
        "n_ref",
        "n_cur",
        "ks_statistic",
        kolmogorov_p(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")).alias("ks_p"),
        (F.col("_distance") / F.greatest(F.col("_std"), F.lit(_SMALL_STD))).alias("wasserstein"),
        (F.col("mean_cur") - F.col("mean_ref")).alias("mean_shift"),
    )
    found = _listed(with_tests, columns, ["n_ref", "n_cur"])
    return found.withColumn("drifted", _decide(test, threshold, {"ks": "ks_p"}, {"wasserstein": "wasserstein"}))


def _decide(test: str, threshold: float | None, p_values: dict[str, str], distances: dict[str, str]) -> Column:
    if test in p_values:
        apart = F.col(p_values[test]) < (P_VALUE if threshold is None else threshold)
    elif test in distances:
        apart = F.col(distances[test]) >= (DISTANCE if threshold is None else threshold)
    else:
        raise ValueError(f"unknown test: {test}")
    return flag(_vanished() | F.coalesce(apart, F.lit(False)))


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0, by its series far from 0."""
    z = a + 8
    near = F.ln(a * (a + 1) * (a + 2) * (a + 3)) + F.ln((a + 4) * (a + 5) * (a + 6) * (a + 7))
    return (z - 0.5) * F.ln(z) - z + 0.5 * F.ln(2 * F.pi()) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - near


def chi2_p(statistic: Column, degrees: Column) -> Column:
    """Upper tail of the chi-square distribution: its series below the mean, its continued fraction above.

    Both converge in a number of steps that follows the root of the degrees of freedom.
    """
    a, x = degrees / 2.0, statistic / 2.0
    inside = statistic.isNotNull() & (degrees >= 1) & (statistic > 0) & (statistic < float("inf"))
    a, x = F.when(inside, a).otherwise(1.0), F.when(inside, x).otherwise(1.0)
    steps = F.sequence(F.lit(1), (200 + 12 * F.sqrt(a)).cast("int"))
    scale = F.exp(a * F.ln(x) - x - log_gamma(a))

    def term(s: Column, i: Column) -> Column:
        new = s["term"] * x / (a + i)
        return F.struct(new.alias("term"), (s["sum"] + new).alias("sum"))

    series = F.aggregate(steps, F.struct((1 / a).alias("term"), (1 / a).alias("sum")), term, lambda s: s["sum"])

    def away(c: Column) -> Column:
        return F.when(F.abs(c) < 1e-300, 1e-300).otherwise(c)

    def fraction(s: Column, i: Column) -> Column:
        part = -i * (i - a)
        b = s["b"] + 2
        c, d = away(b + part / s["c"]), 1 / away(part * s["d"] + b)
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    first = 1 / away(x + 1 - a)
    start = F.struct((x + 1 - a).alias("b"), F.lit(1e300).alias("c"), first.alias("d"), first.alias("h"))
    tail = F.when(x < a + 1, 1 - scale * series).otherwise(scale * F.aggregate(steps, start, fraction, lambda s: s["h"]))
    return (
        F.when(statistic.isNull() | degrees.isNull(), F.lit(None).cast("double"))
        .when((degrees < 1) | (statistic <= 0), F.lit(1.0))
        .when(statistic == float("inf"), F.lit(0.0))
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))
    )


def drift_categorical(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    test: str = "jensenshannon",
    threshold: float | None = None,
    p_values: bool = True,
) -> DataFrame:
    """Per feature: chi-square against the scaled reference, Jensen-Shannon distance, new and lost values.

    The chi-square sum covers categories the reference has. ``test`` is ``chisquare``, ``z`` (two
    categories) or ``jensenshannon``.
    """
    counts = (
        _two_sides(reference, current, columns, "string")
        .unpivot(["side"], columns, "feature", "category")
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur"))
    )
    # one row per column name
    sizes = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")
    expected = F.col("ref") * F.try_divide("n_cur", "n_ref")

    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)

    def divergence(a: Column) -> Column:
        return F.when(a > 0, a * F.ln(F.nullif(2 * a / (p + q), F.lit(0.0)))).otherwise(0.0)

    stats = (
        counts.join(F.broadcast(sizes), "feature")
        .groupBy("feature", "n_ref", "n_cur")
        .agg(
            F.count("*").alias("n_categories"),
            F.sum(
                F.when(expected > 0, F.try_divide((F.col("cur") - expected) * (F.col("cur") - expected), expected))
            ).alias("chi_square"),
            F.when(both, F.sqrt(F.greatest(F.lit(0.0), F.sum(divergence(p) + divergence(q)) / 2))).alias("jensen_shannon"),
            F.count_if((F.col("ref") == 0) & (F.col("cur") > 0)).alias("new_categories"),
            F.count_if((F.col("ref") > 0) & (F.col("cur") == 0)).alias("lost_categories"),
            F.max(F.struct("category", p.alias("p"), q.alias("q"))).alias("_one"),
        )
    )
    pooled = (F.col("_one.p") * F.col("n_ref") + F.col("_one.q") * F.col("n_cur")) / (F.col("n_ref") + F.col("n_cur"))
    z_square = F.try_divide(
        (F.col("_one.p") - F.col("_one.q")) * (F.col("_one.p") - F.col("_one.q")),
        pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("n_ref")) + F.try_divide(F.lit(1), F.col("n_cur"))),
    )
    # a value the reference never had is infinitely unlikely under it
    statistic = F.when(both & (F.col("new_categories") > 0), F.lit(float("inf"))).otherwise(F.col("chi_square"))
    tail_columns = [
        chi2_p(statistic, F.col("n_categories") - 1).alias("chi_square_p"),
        F.when(F.col("n_categories") == 2, chi2_p(z_square, F.lit(1))).alias("z_p"),
    ]
    found = stats.select(
        "feature",
        "n_ref",
        "n_cur",
        "n_categories",
        "chi_square",
        *(tail_columns if p_values else []),
        "jensen_shannon",
        "new_categories",
        "lost_categories",
    )
    out = _listed(found, columns, ["n_ref", "n_cur", "n_categories", "new_categories", "lost_categories"])
    tests = {"chisquare": "chi_square_p", "z": "z_p"} if p_values else {}
    return out.withColumn("drifted", _decide(test, threshold, tests, {"jensenshannon": "jensen_shannon"}))


def drift_summary(
    features: DataFrame, reference: DataFrame, current: DataFrame, columns: list[str], dataset_share: float = DATASET_SHARE
) -> DataFrame:
    """One row over a per-feature table with ``drifted``: counts, shares, dataset flag, missing shares."""

    def missing(df: DataFrame) -> Column:
        return missing_profile(df, columns).agg(F.avg("missing_share")).scalar()

    totals = features.agg(F.sum("drifted").alias("n_drifted"), F.count("*").alias("n_features"))
    share = F.try_divide("n_drifted", "n_features")
    return totals.select(
        F.round(share, 4).alias("share_drifted_features"),
        F.col("n_drifted").alias("n_drifted_features"),
        F.col("n_features").alias("n_total_features"),
        flag(share > dataset_share).alias("dataset_drift_detected"),
        F.round(missing(current), 4).alias("share_missing_values_current"),
        F.round(missing(reference), 4).alias("share_missing_values_reference"),
    )
