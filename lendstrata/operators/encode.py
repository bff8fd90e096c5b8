"""Text-column encoding: the policy is fitted once on train and applied as one projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstrata.functions.nulls import flag
from lendstrata.functions.text import clean_column_names
from lendstrata.operators.columns import label_sets, text_columns
from lendstrata.sources.sinks import sink_json

# Fixed values of the policy.
HIGH_CARDINALITY_COLUMNS = ["ORGANIZATION_TYPE", "OCCUPATION_TYPE"]
ONE_HOT_UP_TO = 10
UNKNOWN = "Unknown"
_PLAN_SCHEMA = "column_name string, n_unique bigint, action string, categories array<string>"


def label_encode(c: str, labels: list[str], missing: str = "class") -> Column:
    """Position in the sorted labels; a missing value is one class after them, or stays missing (``null``)."""
    if missing not in ("class", "null"):
        raise ValueError(f"missing values as class or null, not {missing}")
    chain = F.when(F.col(c).isNull(), F.lit(len(labels) if missing == "class" else None).cast("int"))
    for i, label in enumerate(labels):
        chain = chain.when(F.col(c) == label, F.lit(i))
    return chain


def one_hot(c: str, categories: list[str]) -> list[Column]:
    """One 0/1 column per fitted category; unseen and missing values are 0 in all of them."""
    return [flag(F.col(c) == v).alias(f"{c}_{v}") for v in categories]


def decide(column: str, n_unique: int, keep: list[str], one_hot_up_to: int = ONE_HOT_UP_TO) -> str:
    if n_unique == 2:
        return "label"
    if column in keep:
        return "keep"
    return "one_hot" if n_unique <= one_hot_up_to else "drop"


@dataclass
class EncodingPlan:
    """What to do with each text column, with the categories seen in train.

    ``n_unique`` counts labels up to one more than can be encoded.
    """

    actions: dict[str, str]
    n_unique: dict[str, int]
    categories: dict[str, list[str]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Encoded table with clean column names; text columns absent from ``df`` count as missing."""
        absent = [c for c in self.actions if c not in df.columns]
        df = df.withColumns({c: F.lit(None).cast("string") for c in absent})
        out: list[Column] = []
        dummies: list[Column] = []
        for c in df.columns:
            action = self.actions.get(c)
            if action is None:
                out.append(F.col(c))
            elif action == "label":
                out.append(label_encode(c, self.categories[c]).alias(c))
            elif action == "keep":
                out.append(F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c))
            elif action == "one_hot":
                dummies += one_hot(c, self.categories[c])
        return clean_column_names(df.select(*out, *dummies))

    def table(self, spark: SparkSession) -> DataFrame:
        """The decision per column as rows."""
        return self._rows(spark).drop("categories")

    def _rows(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.n_unique[c], a, self.categories.get(c)) for c, a in self.actions.items()]
        return spark.createDataFrame(rows, _PLAN_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        sink_json(self._rows(spark).coalesce(1), path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> EncodingPlan:
        rows = spark.read.schema(_PLAN_SCHEMA).json(path).collect()
        return EncodingPlan(
            {r["column_name"]: r["action"] for r in rows},
            {r["column_name"]: r["n_unique"] for r in rows},
            {r["column_name"]: list(r["categories"]) for r in rows if r["categories"] is not None},
        )


def fit_encoding(
    train: DataFrame, keep: list[str] | None = None, one_hot_up_to: int = ONE_HOT_UP_TO
) -> EncodingPlan:
    """One pass over the text columns, whose sets of labels end where there are too many to encode."""
    keep = HIGH_CARDINALITY_COLUMNS if keep is None else keep
    most = max(2, one_hot_up_to)
    labels = label_sets(train, text_columns(train), most)
    n_unique = {c: most + 1 if found is None else len(found) for c, found in labels.items()}
    actions = {c: decide(c, n, keep, one_hot_up_to) for c, n in n_unique.items()}
    categories = {c: labels[c] for c, a in actions.items() if a in ("label", "one_hot")}
    return EncodingPlan(actions, n_unique, categories)


def drop_high_card(df: DataFrame, plan: EncodingPlan) -> DataFrame:
    return df.drop(*[c for c, a in plan.actions.items() if a == "drop"])
