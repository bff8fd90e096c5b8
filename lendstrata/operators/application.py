"""The application spine: anomalies and engineered columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import (
    days_to_years,
    ratio,
    row_mean,
    row_min,
    row_product,
    row_sum,
    sentinel_flag,
    sentinel_to_null,
)

# Placeholders that stand for a missing value.
SENTINELS = {"DAYS_EMPLOYED": 365243, "CODE_GENDER": "XNA", "DAYS_LAST_PHONE_CHANGE": 0}
DAY_COLUMNS = ["DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE"]
EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def fix_anomalies(df: DataFrame) -> DataFrame:
    """Placeholders become missing; DAYS_EMPLOYED stays numeric and always gets its flag."""
    cleaned = {c: sentinel_to_null(c, s) for c, s in SENTINELS.items() if c in df.columns}
    if "DAYS_EMPLOYED" in df.columns:
        cleaned["DAYS_EMPLOYED_ANOMALY"] = sentinel_flag("DAYS_EMPLOYED", SENTINELS["DAYS_EMPLOYED"])
    return df.withColumns(cleaned)


def day_columns_to_years(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``<name>_YEARS`` for day offsets before the application; absent columns are skipped."""
    present = [c for c in columns or DAY_COLUMNS if c in df.columns]
    return df.withColumns({f"{c.removeprefix('DAYS_')}_YEARS": days_to_years(c) for c in present})


def app_features(df: DataFrame) -> DataFrame:
    """The engineered application columns, in one projection."""
    documents = [c for c in df.columns if "FLAG_DOCUMENT" in c]
    return df.withColumns(
        {
            "AGE_YEARS": days_to_years("DAYS_BIRTH"),
            "EMPLOYED_YEARS": days_to_years("DAYS_EMPLOYED"),
            "CREDIT_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            "ANNUITY_INCOME_RATIO": ratio("AMT_ANNUITY", F.col("AMT_INCOME_TOTAL") / 12),
            "CREDIT_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
            "ANNUITY_CREDIT_RATIO": ratio("AMT_ANNUITY", "AMT_CREDIT"),
            "INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
            "EXT_SOURCE_MEAN": row_mean(*EXTERNAL_SCORES),
            "EXT_SOURCE_MIN": row_min(*EXTERNAL_SCORES),
            "EXT_SOURCE_2_3": row_product("EXT_SOURCE_2", "EXT_SOURCE_3"),
            "EXT_SOURCE_PROD": row_product(*EXTERNAL_SCORES),
            "DOCS_PROVIDED": row_sum(*documents),
            "DEF_30_RATE": ratio("DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE"),
            "DEF_60_RATE": ratio("DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
        }
    )


def cross_features(df: DataFrame) -> DataFrame:
    """Interactions across feature groups; an absent source column counts as missing."""

    def c(name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    return df.withColumns(
        {
            "ext2_x_inst_ratio": c("EXT_SOURCE_2") * c("inst_payment_ratio_mean"),
            "credit_income_x_cc_util": c("CREDIT_INCOME_RATIO") * c("cc_utilization_mean"),
            "prev_refusal_x_active": c("prev_refusal_rate") * c("buro_active_count"),
            "pos_cc_behavior": c("pos_completion_mean") * c("cc_paid_full_rate_mean"),
            "inst_payment_deterioration": c("inst_recent_payment_ratio") - c("inst_payment_ratio_mean"),
            "age_x_buro_clean": c("AGE_YEARS") * (1 - F.coalesce(c("buro_ever_overdue"), F.lit(0))),
        }
    )
