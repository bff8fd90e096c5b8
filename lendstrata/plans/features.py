"""Feature build: application spine, history groups, interactions, missing-share cut.

Train and test run as one spine, so every history is rolled up and joined once. The three loan
histories share one join chain over the earlier loans and one client aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendstrata.operators.application import app_features, cross_features, fix_anomalies
from lendstrata.operators.bureau import bureau_client
from lendstrata.operators.columns import MISSING_ABOVE, Observed, store_observed
from lendstrata.operators.encode import HIGH_CARDINALITY_COLUMNS, EncodingPlan, fit_encoding
from lendstrata.operators.history import card_loan, history_client, install_loan, pos_loan
from lendstrata.operators.rows import feature_columns
from lendstrata.sources.sinks import sink_json, sink_parquet

KEY = "SK_ID_CURR"
SPLIT = "split"
GROUPS = ("bureau", "previous_app", "pos_cash", "installments", "credit_card")


@dataclass
class FeatureConfig:
    """Which groups to build and how; tie columns give rows of one version or month an order.

    ``placed`` says that the histories are stored by their keys (``store_histories``), so that none of them is shuffled.
    """

    groups: tuple[str, ...] = GROUPS
    high_cardinality: list[str] = field(default_factory=lambda: list(HIGH_CARDINALITY_COLUMNS))
    missing_above: float = MISSING_ABOVE
    monthly_balance: bool = True
    installment_ties: list[str] | None = None
    card_ties: list[str] | None = None
    placed: bool = False


def application_clean(
    df: DataFrame, plan: EncodingPlan | None = None, high_cardinality: list[str] | None = None
) -> DataFrame:
    """Clean, engineer, encode and rename one application table; fits the encoding if none is given."""
    engineered = app_features(fix_anomalies(df))
    return (plan or fit_encoding(engineered, high_cardinality)).transform(engineered)


def join_spine(spine: DataFrame, *groups: DataFrame) -> DataFrame:
    """Every application with its history features. All joins share the key and one partitioning."""
    for group in groups:
        spine = spine.join(group, KEY, "left")
    return spine


def client_groups(tables: dict[str, DataFrame], config: FeatureConfig) -> list[DataFrame]:
    """History features per client: at most two tables, bureau and earlier loans."""
    out = []
    if "bureau" in config.groups:
        out.append(bureau_client(tables["bureau"], tables["bureau_balance"] if config.monthly_balance else None))
    makers = {
        "pos_cash": lambda: pos_loan(tables["pos_cash"]),
        "installments": lambda: install_loan(tables["installments"], config.installment_ties, placed=config.placed),
        "credit_card": lambda: card_loan(tables["credit_card"], config.card_ties),
    }
    loans = {name: make() for name, make in makers.items() if name in config.groups}
    if loans or "previous_app" in config.groups:
        out.append(history_client(tables["previous_app"], loans, "previous_app" in config.groups))
    return out


@dataclass
class FeatureSet:
    """The finished matrix, train and test told apart by ``split``, with what was counted while it was stored."""

    matrix: DataFrame
    dropped: list[str]
    plan: EncodingPlan
    observed: Observed

    @property
    def train(self) -> DataFrame:
        return self.matrix.where(F.col(SPLIT) == "train").drop(SPLIT)

    @property
    def test(self) -> DataFrame:
        return self.matrix.where(F.col(SPLIT) == "test").drop(SPLIT, "TARGET")

    def report(self) -> DataFrame:
        """One row on the matrix, without another pass over it."""
        features = len(self.matrix.columns) - 3  # id, target and split
        return self.observed.report(self.matrix.sparkSession, features, self.dropped)

    def class_balance(self) -> DataFrame:
        return self.observed.class_balance(self.matrix.sparkSession)

    def write(self, folder: str) -> None:
        """Parquet by split in one write, and the report as JSON."""
        sink_parquet(self.matrix, f"{folder}/features", [SPLIT])
        sink_json(self.report(), f"{folder}/feature_report")


def build_matrix(tables: dict[str, DataFrame], config: FeatureConfig) -> tuple[DataFrame, EncodingPlan]:
    """All features before the missing-share cut, as one lazy plan."""
    train = app_features(fix_anomalies(tables["application_train"]))
    test = app_features(fix_anomalies(tables["application_test"]))
    plan = fit_encoding(train, config.high_cardinality)
    both = (
        plan.transform(train)
        .withColumn(SPLIT, F.lit("train"))
        .unionByName(plan.transform(test).withColumn(SPLIT, F.lit("test")), allowMissingColumns=True)
    )
    return cross_features(join_spine(both, *client_groups(tables, config))), plan


def build_features(tables: dict[str, DataFrame], config: FeatureConfig | None = None) -> FeatureSet:
    """The full build. The matrix is stored once; the profile that decides on columns is counted on the way."""
    config = config or FeatureConfig()
    matrix, plan = build_matrix(tables, config)
    stored, observed = store_observed(matrix, "features", SPLIT, [c for c in feature_columns(matrix) if c != SPLIT])
    dropped = observed.high_missing(config.missing_above)
    return FeatureSet(stored.drop(*dropped), dropped, plan, observed)
