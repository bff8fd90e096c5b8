"""Registration of queries, and what several of them use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from lendstrata.operators import application
from lendstrata.plans import features


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, keep: list[str], digits: int = 4) -> DataFrame:
    """All columns but the kept ones as rounded doubles, as in ``oracle.rounded``."""
    shift = float(o.shift(digits))
    return df.select(
        *keep,
        *[
            (F.round(F.col(c).cast("double") + F.lit(shift), digits) + F.lit(0.0)).alias(c)
            for c in df.columns
            if c not in keep
        ],
    )


def events(s: SparkSession, d: str) -> DataFrame:
    return fx.fixture(s, d, "fx_events")


def app(s: SparkSession, d: str) -> DataFrame:
    return fx.fixture(s, d, "fx_application")


def engineered(s: SparkSession, d: str) -> DataFrame:
    return application.app_features(application.fix_anomalies(app(s, d)))


def train_of(df: DataFrame) -> DataFrame:
    return df.where("split = 'train'").drop("split")


def test_of(df: DataFrame) -> DataFrame:
    return df.where("split = 'test'").drop("split", "TARGET")


CONFIG = features.FeatureConfig(installment_ties=fx.INSTALLMENT_TIES, card_ties=fx.CARD_TIES)


def groups(s: SparkSession, d: str) -> list[DataFrame]:
    return features.client_groups(fx.tables(s, d), CONFIG)


def matrix(s: SparkSession, d: str) -> features.FeatureSet:
    return features.build_features(fx.tables(s, d), CONFIG)


APP_CLEAN = (
    "SK_ID_CURR TARGET CODE_GENDER FLAG_OWN_CAR ORGANIZATION_TYPE AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY "
    "AMT_GOODS_PRICE CNT_FAM_MEMBERS DAYS_BIRTH DAYS_EMPLOYED DAYS_LAST_PHONE_CHANGE EXT_SOURCE_1 EXT_SOURCE_2 "
    "EXT_SOURCE_3 MOSTLY_MISSING OBS_30_CNT_SOCIAL_CIRCLE DEF_30_CNT_SOCIAL_CIRCLE OBS_60_CNT_SOCIAL_CIRCLE "
    "DEF_60_CNT_SOCIAL_CIRCLE FLAG_DOCUMENT_2 FLAG_DOCUMENT_3 DAYS_EMPLOYED_ANOMALY AGE_YEARS EMPLOYED_YEARS "
    "CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO CREDIT_GOODS_RATIO ANNUITY_CREDIT_RATIO INCOME_PER_PERSON "
    "EXT_SOURCE_MEAN EXT_SOURCE_MIN EXT_SOURCE_2_3 EXT_SOURCE_PROD DOCS_PROVIDED DEF_30_RATE DEF_60_RATE"
).split() + [f"NAME_INCOME_TYPE_{s}" for s in o.SEGMENTS]


def missing_sql(names: list[str], table: str, where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END) AS missing_share "
        f"FROM {table} WHERE {where}"
        for c in names
    )


APP_RAW = (
    "CODE_GENDER FLAG_OWN_CAR NAME_INCOME_TYPE ORGANIZATION_TYPE NAME_FREE_TEXT AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY "
    "AMT_GOODS_PRICE CNT_FAM_MEMBERS DAYS_BIRTH DAYS_EMPLOYED DAYS_LAST_PHONE_CHANGE EXT_SOURCE_1 EXT_SOURCE_2 "
    "EXT_SOURCE_3 MOSTLY_MISSING"
).split()


INST_COLUMNS = (
    "days_late days_late_pos days_early_pos payment_ratio payment_deficit is_late is_very_late is_underpaid is_early is_missing"
).split()


TEXTS = ["CODE_GENDER", "FLAG_OWN_CAR", "NAME_INCOME_TYPE", "ORGANIZATION_TYPE", "NAME_FREE_TEXT"]


def encoding_sql(where: str) -> str:
    return f"""
SELECT ORGANIZATION_TYPE AS category, (sum(TARGET) + g.m * 10) / (count(*) + 10) AS encoded, any_value(g.m) AS m
FROM app_clean, (SELECT avg(TARGET) AS m FROM app_clean WHERE {where}) g
WHERE {where} GROUP BY ORGANIZATION_TYPE, g.m"""


TIER_SQL = "CASE WHEN {0} < 0.05 THEN 'LOW' WHEN {0} < 0.15 THEN 'MEDIUM' WHEN {0} < 0.30 THEN 'HIGH' ELSE 'VERY_HIGH' END"


# Any fixed linear model will do for the check.
WEIGHTS = {"EXT_SOURCE_MEAN": -3.0, "CREDIT_INCOME_RATIO": 0.01, "AGE_YEARS": -0.02, "EMPLOYED_YEARS": -0.015, "DEF_30_RATE": 0.4}
MEANS = {"EXT_SOURCE_MEAN": 0.5, "CREDIT_INCOME_RATIO": 40.0, "AGE_YEARS": 43.0, "EMPLOYED_YEARS": 12.0}
INTERCEPT = -1.75


# Names of the array elements that serve as contributions.
DIMENSIONS = [f"f{i}" for i in range(64)]
