"""Drift of current data against the data a model was trained on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendstrata.operators.columns import numeric_columns, text_columns
from lendstrata.operators.drift import drift_categorical, drift_numeric, drift_summary
from lendstrata.operators.rows import select_features
from lendstrata.sources.sinks import materialize, sink_json


@dataclass
class DriftReport:
    """Rows (feature, kind, distance, p_value, drifted) and the one-row summary."""

    features: DataFrame
    summary: DataFrame

    def write(self, folder: str) -> None:
        sink_json(self.features, f"{folder}/drift_features")
        sink_json(self.summary, f"{folder}/drift_metrics")


def monitor(
    reference: DataFrame,
    current: DataFrame,
    numeric_test: str = "wasserstein",
    categorical_test: str = "jensenshannon",
    threshold: float | None = None,
    dataset_share: float = 0.5,
) -> DriftReport:
    """Compare all rows of both tables, feature by feature; ids and the target are left out."""
    reference, current = select_features(reference), select_features(current)
    shared = [c for c in reference.columns if c in current.columns]
    numbers = [c for c in numeric_columns(reference) if c in shared]
    texts = [c for c in text_columns(reference) if c in shared]
    switches = [f.name for f in reference.schema.fields if isinstance(f.dataType, T.BooleanType) and f.name in shared]
    texts += switches  # two-valued, compared by their names
    parts = []
    if numbers:
        parts.append(
            drift_numeric(reference, current, numbers, numeric_test, threshold).selectExpr(
                "feature", "'numeric' AS kind", "wasserstein AS distance", "ks_p AS p_value", "drifted"
            )
        )
    if texts:
        parts.append(
            drift_categorical(reference, current, texts, categorical_test, threshold).selectExpr(
                "feature", "'text' AS kind", "jensen_shannon AS distance", "chi_square_p AS p_value", "drifted"
            )
        )
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    stored = materialize(found, "drift")
    return DriftReport(stored, drift_summary(stored, reference, current, numbers + texts, dataset_share))
