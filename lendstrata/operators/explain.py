"""Contribution vectors: top factors per row, global importance, factor texts.

A row carries its contributions as an array in feature order. Everything per row is array work
inside the row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.text import decimal_text

# Fixed values of the reports.
TOP_N = 10
GLOBAL_TOP = 20
MIXED_ABOVE = 0.1
UP, DOWN = "increases_risk", "decreases_risk"
FACTOR_LINE = "  - %s: %s default risk (value: %s), SHAP impact: %s"
SUMMARY = (
    "Assessment summary:\n"
    "- Default probability: %s%% (population baseline: %s%%)\n"
    "- Risk tier: %s\n"
    "\n"
    "Top factors driving this assessment:\n"
    "%s"
)
FALLBACK = (
    "This application has a %s%% estimated default probability and is classified as %s risk. "
    "Narrative explanation unavailable."
)


def top_factors(contributions: Column, names: Column, values: Column, n: int = TOP_N) -> Column:
    """Array of the n largest contributions by size, ties in feature order; missing ones are left out.

    ``names`` and ``values`` are arrays aligned with the contributions.
    """
    keyed = F.transform(
        contributions,
        lambda c, i: F.struct(
            (-F.abs(c)).alias("_key"),
            i.alias("_at"),
            F.get(names, i).alias("feature"),
            F.round(c.cast("double"), 6).alias("contribution"),
            F.when(c > 0, F.lit(UP)).otherwise(F.lit(DOWN)).alias("direction"),
            F.round(F.get(values, i).cast("double"), 4).alias("feature_value"),
        ),
    )
    present = F.filter(keyed, lambda s: s["contribution"].isNotNull())
    top = F.slice(F.array_sort(present), 1, n)
    return F.transform(
        top,
        lambda s: F.struct(
            s["feature"].alias("feature"),
            s["contribution"].alias("contribution"),
            s["direction"].alias("direction"),
            s["feature_value"].alias("feature_value"),
        ),
    )


def explain_top_n(
    df: DataFrame, contributions: Column, names: Column, values: Column, n: int = TOP_N, out: str = "top_features"
) -> DataFrame:
    return df.withColumn(out, top_factors(contributions, names, values, n))


def global_importance(df: DataFrame, contributions: Column, names: list[str], top: int | None = GLOBAL_TOP) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    spread = df.select(F.posexplode(contributions).alias("_at", "c"))
    means = spread.groupBy("_at").agg(F.avg(F.abs(F.col("c").cast("double"))).alias("importance"))
    listed = F.array(*[F.lit(n) for n in names])
    named = means.select(F.get(listed, F.col("_at")).alias("feature"), "importance")
    return named if top is None else top_n_importance(named, top)


def top_n_importance(importance: DataFrame, n: int) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def mixed_signal_rows(df: DataFrame, contributions: Column, threshold: float = MIXED_ABOVE) -> DataFrame:
    """Rows pushed clearly both ways, with the number of factors on either side."""
    return df.where((F.array_max(contributions) > threshold) & (F.array_min(contributions) < -threshold)).select(
        "*",
        F.size(F.filter(contributions, lambda c: c > 0)).alias("n_positive"),
        F.size(F.filter(contributions, lambda c: c < 0)).alias("n_negative"),
    )


def factor_lines(factors: Column) -> Column:
    """One text line per factor, in order."""

    def line(f: Column) -> Column:
        verb = F.when(f["direction"] == UP, F.lit("increases")).otherwise(F.lit("decreases"))
        value = F.coalesce(decimal_text(f["feature_value"], 4), F.lit("unknown"))
        return F.format_string(FACTOR_LINE, f["feature"], verb, value, decimal_text(f["contribution"], 3))

    return F.array_join(F.transform(factors, line), "\n")


def percent_text(probability: Column) -> Column:
    return decimal_text(probability * 100, 2)


def fallback_text(probability: Column, tier: Column) -> Column:
    """Fixed sentence for a scored row without a written explanation."""
    return F.when(probability.isNotNull(), F.format_string(FALLBACK, percent_text(probability), tier))


def summary_text(probability: Column, baseline: Column, tier: Column, factors: Column) -> Column:
    """Assessment summary: probability against the baseline, tier and the factor lines."""
    text = F.format_string(SUMMARY, percent_text(probability), percent_text(baseline), tier, factor_lines(factors))
    return F.when(probability.isNotNull(), text)


def render_explanation(
    df: DataFrame, probability: Column, baseline: Column, tier: Column, factors: Column
) -> DataFrame:
    return df.select(
        "*",
        summary_text(probability, baseline, tier, factors).alias("explanation"),
        fallback_text(probability, tier).alias("fallback"),
    )
