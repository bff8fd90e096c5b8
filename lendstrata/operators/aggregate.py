"""Configured aggregates per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import sum0

FUNCTIONS: dict[str, Callable[[str], Column]] = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": sum0,
    "std": F.stddev_samp,
    "count": F.count,
}


def agg_numeric(df: DataFrame, key: str, columns: list[str], functions: list[str]) -> DataFrame:
    """The listed aggregates of the listed columns per present key, named ``<column>_<function>``."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[FUNCTIONS[f](c).alias(f"{c}_{f}") for c in columns for f in functions])
    )
