"""All registered queries: importing the modules registers them."""

from catalog import file_queries, model_queries, rollup_queries, row_queries, service_queries  # noqa: F401
from catalog.registry import INTERCEPT, MEANS, ORACLES, QUERIES, WEIGHTS
from catalog.rollup_queries import build_features

__all__ = ["INTERCEPT", "MEANS", "ORACLES", "QUERIES", "WEIGHTS", "build_features"]
