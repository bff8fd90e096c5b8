"""Stored quantile sketches of numeric features, and drift between merged ones.

A batch (a day, a file) is sketched once, in one pass and one row per feature, whatever its size. Sketches of batches merge, so that
any two sets of batches can be compared without reading their rows again. Ranks from a sketch are off by at most
``rank_error`` with a confidence of 99 %, which bounds the statistics; ``drift_numeric`` compares rows exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import flag
from lendstrata.operators.drift import DISTANCE, kolmogorov_p

#: Size parameter of a sketch, and quantiles of each side at which two of them are compared.
SIZE = 2048
POINTS = 512
_SMALL_STD = 0.001


def rank_error(size: int = SIZE) -> float:
    """Bound on the error of a rank, as a share of the rows: the published fit for this kind of sketch."""
    return 2.296 / size**0.9021


def statistic_error(size: int = SIZE, points: int = POINTS) -> float:
    """Bound on the error of the KS statistic between two sketches, and of the distance as a share of the range of values."""
    return 2 * (rank_error(size) + 1 / points)


def numeric_sketches(df: DataFrame, columns: list[str], batch: Column, size: int = SIZE) -> DataFrame:
    """Rows (batch, feature, rows, present, total, squares, low, high, sketch), one per batch and feature; null and NaN are missing."""

    def figures(c: str) -> Column:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        return F.struct(
            F.lit(c).alias("feature"),
            F.count("*").alias("rows"),
            F.count(x).alias("present"),
            F.sum(x).alias("total"),
            F.sum(x * x).alias("squares"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
            F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"),
        )

    sketched = df.groupBy(batch.alias("batch")).agg(F.array(*[figures(c) for c in columns]).alias("_all"))
    return sketched.select("batch", F.inline("_all"))


def merge_sketches(sketches: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """Sketches of all batches together, per feature (and per ``by``)."""
    some = sketches.where("present > 0").groupBy(*(by or []), "feature")
    return some.agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def drift_sketched(reference: DataFrame, current: DataFrame, threshold: float = DISTANCE, points: int = POINTS) -> DataFrame:
    """Per feature of two tables of merged sketches: KS statistic and p, normed Wasserstein distance, mean shift, drifted.

    The statistics are those of ``drift_numeric`` up to ``statistic_error``: the KS statistic by that much, the distance by that share of
    the range of both sides over the reference deviation. A feature with values on one side only is drifted.
    """
    both = reference.alias("r").join(current.alias("c"), F.col("r.feature") == F.col("c.feature"), "full")
    levels = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    at = {side: F.kll_sketch_get_quantile_double(f"{side}.sketch", levels) for side in "rc"}
    with_points = both.select(
        F.coalesce("r.feature", "c.feature").alias("feature"),
        *[F.coalesce(f"{side}.present", F.lit(0)).alias(f"n_{name}") for side, name in (("r", "ref"), ("c", "cur"))],
        (F.col("r.total") / F.col("r.present")).alias("mean_ref"),
        (F.col("c.total") / F.col("c.present")).alias("mean_cur"),
        (F.col("r.squares") / F.col("r.present")).alias("square_ref"),
        (F.greatest("r.high", "c.high") - F.least("r.low", "c.low")).alias("range"),
        F.col("r.sketch").alias("sketch_ref"),
        F.col("c.sketch").alias("sketch_cur"),
        at["r"].alias("at_ref"),
        at["c"].alias("at_cur"),
    )
    def below(side: str, x: Column) -> Column:
        return F.size(F.filter(side, lambda v: v <= x))

    gaps = F.transform(F.array_union("at_ref", "at_cur"), lambda x: F.abs(below("at_ref", x) - below("at_cur", x)) / points)
    apart = F.zip_with("at_ref", "at_cur", lambda a, b: F.abs(a - b))
    distance = F.aggregate(apart, F.lit(0.0), lambda total, x: total + x) / points
    deviation = F.sqrt(F.greatest(F.col("square_ref") - F.col("mean_ref") * F.col("mean_ref"), F.lit(0.0)))
    scale = F.greatest(deviation, F.lit(_SMALL_STD))
    two = F.col("sketch_ref").isNotNull() & F.col("sketch_cur").isNotNull()
    found = with_points.select(
        "feature",
        "n_ref",
        "n_cur",
        F.when(two, F.array_max(gaps)).alias("ks_statistic"),
        F.when(two, distance / scale).alias("wasserstein"),
        (F.col("mean_cur") - F.col("mean_ref")).alias("mean_shift"),
        F.when(two, F.lit(statistic_error(points=points)) * F.col("range") / scale).alias("wasserstein_error"),
        two.alias("_two"),
    )
    return found.select(
        "feature",
        "n_ref",
        "n_cur",
        "ks_statistic",
        kolmogorov_p(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")).alias("ks_p"),
        "wasserstein",
        "wasserstein_error",
        "mean_shift",
        flag(~F.col("_two") | F.coalesce(F.col("wasserstein") >= threshold, F.lit(False))).alias("drifted"),
    )
