"""Requests to scores with the fitted parts of a training run; the same for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendstrata.operators.encode import EncodingPlan
from lendstrata.operators.evaluate import baseline_probability, linear_contributions, logistic_score, score_probability, sigmoid
from lendstrata.operators.explain import TOP_N, explain_top_n, render_explanation
from lendstrata.operators.quality import Field, apply_defaults, serving_features, validate_rules
from lendstrata.plans.training import FinalModel
from lendstrata.streaming.score import Scorer


def request_scorer(plan: EncodingPlan, model: FinalModel, *keep: str) -> Scorer:
    """Scorer of request rows: engineered and encoded as in training, then scored by the model."""

    def scorer(requests: DataFrame) -> DataFrame:
        carried = [c for c in requests.columns if c in keep]
        return model.score(serving_features(requests, plan, model.columns, keep=carried), *carried)

    return scorer


def score_requests(
    requests: DataFrame, fields: dict[str, Field], plan: EncodingPlan, model: FinalModel, id_column: str = "SK_ID_CURR"
) -> DataFrame:
    """Score a table of requests; rejected ones keep their violations and get no score."""
    checked = validate_rules(apply_defaults(requests, fields, [id_column]), fields)
    scored = request_scorer(plan, model, id_column, "valid", "violations")(checked)
    return scored.select(
        id_column,
        F.when(F.col("valid"), F.col("default_probability")).alias("default_probability"),
        F.when(F.col("valid"), F.col("risk_tier")).alias("risk_tier"),
        "valid",
        "violations",
    )


def explain_linear(
    df: DataFrame, weights: dict[str, float], intercept: float, means: dict[str, float] | None = None, n: int = TOP_N
) -> DataFrame:
    """Rows with probability, tier, the baseline probability of the table, top factors and the written summary.

    The contributions of a linear model are exact; a missing feature contributes nothing and is no factor.
    """
    raw = logistic_score(weights, intercept, means)
    baseline = baseline_probability(df, raw).select(F.col("baseline_probability").alias("baseline"))
    names = F.array(*[F.lit(c) for c in weights])
    values = F.array(*[F.col(c).cast("double") for c in weights])
    scored = score_probability(df, raw).withColumn("baseline", baseline.scalar())
    explained = explain_top_n(scored, F.array(*linear_contributions(weights, means)), names, values, n)
    return render_explanation(
        explained, F.col("default_probability"), F.col("baseline"), F.col("risk_tier"), F.col("top_features")
    )


def explain_trees(df: DataFrame, model: FinalModel, n: int = TOP_N, *keep: str) -> DataFrame:
    """Rows with probability, tier, the baseline probability of the ensemble, top factors and the written summary.

    Contributions are Shapley values of the trees; a missing feature contributes by being missing, with a null value.
    """
    found = score_probability(model.contributions(df, *keep), F.col("raw_score"))
    names = F.array(*[F.lit(c) for c in model.columns])
    explained = explain_top_n(found, F.col("contributions"), names, F.col("feature_values"), n)
    baseline = F.round(sigmoid(F.lit(model.trees.expected)), 6)
    rendered = render_explanation(
        explained.withColumn("baseline", baseline), F.col("default_probability"), baseline, F.col("risk_tier"), F.col("top_features")
    )
    return rendered.select(*keep, "default_probability", "risk_tier", "baseline", "top_features", "explanation", "fallback")
