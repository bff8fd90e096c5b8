"""Column profiles, and cleaning steps that are fitted on one table and applied to others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstrata.operators.ordered import quantiles
from lendstrata.operators.rows import feature_columns
from lendstrata.sources.sinks import materialize

MISSING_ABOVE = 0.8


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column_name, missing_share), from one pass that only counts present values."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot(["_rows"], columns, "column_name", "present").select(
        "column_name", F.try_divide(F.col("_rows") - F.col("present"), F.col("_rows")).alias("missing_share")
    )


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nunique_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column_name, n_unique): distinct present values of the text columns, in one pass.

    Values are told apart by 96 bits of hash, so that no text is shuffled.
    """
    columns = columns or text_columns(df)
    marks = [F.struct(F.lit(i).alias("at"), F.xxhash64(c).alias("h"), F.hash(c).alias("g"), F.col(c).isNotNull().alias("present")) for i, c in enumerate(columns)]
    long = df.select(F.inline(F.array(*marks))).where("present").select("at", "h", "g")
    counts = long.distinct().groupBy("at").agg(F.count("*").alias("n_unique"))
    listed = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in columns])).alias("at", "column_name"))
    return listed.join(counts, "at", "left").select("column_name", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"))


#: Items that a sketch of labels holds; far more than are asked for, so that few labels are counted exactly.
TRACKED = 1024


def label_sets(df: DataFrame, columns: list[str], up_to: int) -> dict[str, list[str] | None]:
    """The sorted labels of each text column; None for those with more than ``up_to``, at most a hundred.

    One aggregation of bounded sketches: a task passes on at most ``TRACKED`` labels of a column, however many it has. The sketch of
    frequent labels is exact as long as it is not full; that it may be full, the estimated count tells, which for few labels is never
    far off.
    """
    if not 0 < up_to <= 100:
        raise ValueError("1 to 100 labels")
    if not columns:
        return {}
    found = df.agg(
        *[F.approx_count_distinct(c).alias(f"{i}_about") for i, c in enumerate(columns)],
        *[F.expr(f"approx_top_k(`{c}`, {up_to + 1}, {TRACKED}) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"{i}_top") for i, c in enumerate(columns)],
    ).first()
    out: dict[str, list[str] | None] = {}
    for i, c in enumerate(columns):
        labels = [r["item"] for r in found[f"{i}_top"] or ()]
        out[c] = sorted(labels) if len(labels) <= up_to and found[f"{i}_about"] <= 2 * up_to else None
    return out


def high_missing(train: DataFrame, threshold: float = MISSING_ABOVE) -> list[str]:
    """Feature columns whose missing share in ``train`` is above the threshold."""
    profile = missing_profile(train, feature_columns(train))
    return sorted(r[0] for r in profile.where(F.col("missing_share") > threshold).collect())


def drop_high_missing(
    train: DataFrame, test: DataFrame, threshold: float = MISSING_ABOVE
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Drop from both tables what is mostly missing in ``train``."""
    dropped = high_missing(train, threshold)
    return train.drop(*dropped), test.drop(*dropped), dropped


def align_schema(train: DataFrame, test: DataFrame, target: str = "TARGET") -> DataFrame:
    """``test`` with the columns of ``train``: absent ones become 0, others and the target go."""
    return test.select(
        [
            F.col(f.name) if f.name in test.columns else F.lit(0).cast(f.dataType).alias(f.name)
            for f in train.schema.fields
            if f.name != target
        ]
    )


# ---- imputation and outliers ----------------------------------------------


def impute_values(df: DataFrame, columns: list[str], strategy: str = "median", **options) -> dict[str, float]:
    """Fitted fill value per column: exact ``median``, ``mean`` or ``zero``."""
    if strategy == "zero":
        return dict.fromkeys(columns, 0.0)
    if strategy == "median":
        return dict(quantiles(df, columns, 0.5, **options).collect())
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    raise ValueError(f"unknown strategy: {strategy}")


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def fill_category(df: DataFrame, columns: list[str], value: str = "Unknown") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def winsor_limits(df: DataFrame, columns: list[str], q: float = 0.99, **options) -> dict[str, float]:
    """Fitted upper limit per column: the exact quantile."""
    return dict(quantiles(df, columns, q, **options).collect())


def winsorize(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.when(F.col(c) > v, F.lit(v)).otherwise(F.col(c).cast("double")) for c, v in limits.items()}
    )


# ---- reports --------------------------------------------------------------


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (table_name, row_count, column_count); counting needs no column data."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def class_balance(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Rows (label, row_count, share, imbalance): counts per class and the 0:1 ratio."""
    counts = df.agg(F.count_if(F.col(target) == 0).alias("zeros"), F.count_if(F.col(target) == 1).alias("ones"))
    total = F.col("zeros") + F.col("ones")
    return counts.select(
        F.expr("stack(2, 0, zeros, 1, ones)").alias("label", "row_count"),
        total.alias("total"),
        F.try_divide("zeros", "ones").alias("imbalance"),
    ).select("label", "row_count", F.try_divide("row_count", "total").alias("share"), "imbalance")


@dataclass
class Observed:
    """What a stored feature matrix holds, counted while it was written."""

    train_rows: int
    test_rows: int
    ones: int
    zeros: int
    target_sum: float
    present: dict[str, int]  # rows of train with a value

    def high_missing(self, threshold: float = MISSING_ABOVE) -> list[str]:
        """Features whose missing share in train is above the threshold."""
        return sorted(c for c, n in self.present.items() if self.train_rows and (self.train_rows - n) / self.train_rows > threshold)

    def report(self, spark: SparkSession, feature_count: int, dropped: list[str]) -> DataFrame:
        """The row of ``feature_report``."""
        labelled = self.ones + self.zeros
        row = (self.train_rows, self.test_rows, feature_count, ",".join(dropped), self.target_sum / labelled if labelled else None)
        return spark.createDataFrame([row], "train_rows long, test_rows long, feature_count int, dropped_high_missing string, target_mean double")

    def class_balance(self, spark: SparkSession) -> DataFrame:
        """The rows of ``class_balance``."""
        total = self.ones + self.zeros
        ratio = self.zeros / self.ones if self.ones else None
        rows = [(label, n, n / total if total else None, ratio) for label, n in ((0, self.zeros), (1, self.ones))]
        return spark.createDataFrame(rows, "label int, row_count long, share double, imbalance double")


def store_observed(df: DataFrame, name: str, split: str, features: list[str], target: str = "TARGET") -> tuple[DataFrame, Observed]:
    """The matrix as a stored table, and its figures from the same pass."""
    train = F.col(split) == "train"
    seen = Observation(name)
    watched = df.observe(
        seen,
        F.count_if(train).alias("train_rows"),
        F.count_if(F.col(split) == "test").alias("test_rows"),
        F.count_if(train & (F.col(target) == 1)).alias("ones"),
        F.count_if(train & (F.col(target) == 0)).alias("zeros"),
        F.coalesce(F.sum(F.when(train, F.col(target).cast("double"))), F.lit(0.0)).alias("target_sum"),
        *[F.count_if(train & F.col(f"`{c}`").isNotNull()).alias(f"present {c}") for c in features],
    )
    stored = materialize(watched, name)
    found = dict(seen.get)
    present = {c: found.pop(f"present {c}") for c in features}
    return stored, Observed(**found, present=present)


def feature_report(train: DataFrame, test: DataFrame, dropped: list[str], target: str = "TARGET") -> DataFrame:
    """One row on the finished feature tables."""
    counts = train.agg(F.count("*").alias("train_rows"), F.avg(target).alias("target_mean"))
    test_rows = test.agg(F.count("*").alias("test_rows"))
    return counts.select(
        "train_rows",
        test_rows.scalar().alias("test_rows"),
        F.lit(len(train.columns) - 2).alias("feature_count"),
        F.concat_ws(",", *[F.lit(d) for d in dropped]).alias("dropped_high_missing"),
        "target_mean",
    )
