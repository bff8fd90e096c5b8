"""Scores, tiers and exact ranking quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import flag
from lendstrata.operators.ordered import running

# Fixed values of the reports.
TIERS = [(0.05, "LOW"), (0.15, "MEDIUM"), (0.30, "HIGH")]
TOP_TIER = "VERY_HIGH"
PROMOTION_MARGIN = 0.001
MEAN_TOLERANCE = 0.02


def auc(df: DataFrame, score: str, label: str, by: list[str] | None = None, **options) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; one row, or one per group.

    Rows are first counted per score, so heavy ties shrink before anything is ordered. Missing when
    a class is absent.
    """
    by = by or []
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    won = pos * (F.col("_neg_before") + neg / 2)
    return (
        running(counts, by, "_score", ["_neg"], **options)
        .groupBy(*by)
        .agg(F.try_divide(F.sum(won), F.sum(pos) * F.sum(neg)).alias("auc"))
    )


def auc_by_fold(df: DataFrame, score: str, label: str, fold: str, **options) -> DataFrame:
    """One row per fold with its AUC and, repeated, the mean and population deviation over folds."""
    folds = auc(df, score, label, [fold], **options)
    overall = folds.agg(F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"))
    return folds.select(
        fold,
        "auc",
        overall.select("mean_auc").scalar().alias("mean_auc"),
        overall.select("std_auc").scalar().alias("std_auc"),
    )


def compare_models(
    df: DataFrame, challenger: str, champion: str | None, label: str, margin: float = PROMOTION_MARGIN, **options
) -> DataFrame:
    """One row: both AUCs and whether the challenger wins; it does if there is no champion."""
    if champion is None:
        return auc(df, challenger, label, **options).select(
            F.lit(None).cast("double").alias("champion_auc"),
            F.col("auc").alias("challenger_auc"),
            F.lit(1).alias("promote"),
        )
    long = df.select(label, F.col(challenger).alias("challenger"), F.col(champion).alias("champion")).unpivot(
        [label], ["challenger", "champion"], "model", "score"
    )
    sides = auc(long, "score", label, ["model"], **options).agg(
        *[F.max(F.when(F.col("model") == m, F.col("auc"))).alias(f"{m}_auc") for m in ("champion", "challenger")]
    )
    return sides.select("*", flag(F.col("challenger_auc") - F.col("champion_auc") > margin).alias("promote"))


def risk_tier(probability: Column | str) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    chain = F.when(p.isNull(), F.lit(None).cast("string"))
    for below, name in TIERS:
        chain = chain.when(p < below, F.lit(name))
    return chain.otherwise(F.lit(TOP_TIER))


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def baseline_probability(df: DataFrame, raw_score: Column | str) -> DataFrame:
    """One row: the probability at the mean raw score, 6 decimals."""
    return df.agg(F.round(sigmoid(F.avg(raw_score)), 6).alias("baseline_probability"))


def logistic_score(weights: dict[str, float], intercept: float, means: dict[str, float] | None = None) -> Column:
    """Raw score of a linear model; a missing feature adds nothing."""
    raw = F.lit(intercept)
    for contribution in linear_contributions(weights, means):
        raw = raw + F.coalesce(contribution, F.lit(0.0))
    return raw


def linear_contributions(weights: dict[str, float], means: dict[str, float] | None = None) -> list[Column]:
    """Per feature its weight times the distance from the mean."""
    means = means or {}
    return [F.lit(w) * (F.col(c) - F.lit(means.get(c, 0.0))) for c, w in weights.items()]


def score_probability(df: DataFrame, raw: Column) -> DataFrame:
    """Add the probability, rounded to 6 decimals, and the tier of the unrounded one."""
    probability = sigmoid(raw)
    return df.select(
        "*", F.round(probability, 6).alias("default_probability"), risk_tier(probability).alias("risk_tier")
    )


def prediction_mean_check(
    scored: DataFrame, score: str, train: DataFrame, label: str, tolerance: float = MEAN_TOLERANCE
) -> DataFrame:
    """One row: mean score, mean label, distance, and a warning flag beyond the tolerance."""
    both = scored.agg(F.avg(score).alias("predicted_mean")).select(
        "predicted_mean", train.agg(F.avg(label)).scalar().alias("train_mean")
    )
    difference = F.abs(F.col("predicted_mean") - F.col("train_mean"))
    return both.select("*", difference.alias("difference"), flag(difference > tolerance).alias("warning"))
