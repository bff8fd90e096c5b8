"""Credit bureau records: month -> credit -> client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.functions.nulls import (
    any_flag,
    flag,
    map_codes,
    of_subset,
    only,
    ratio,
    subset_count,
    subset_sum,
    sum0,
)
from lendstrata.functions.text import add_prefix

# Month status codes. C is a closed credit, X an unknown status.
STATUS_NUMBERS = {"0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "C": -1, "X": None}
PAST_DUE_STATUSES = ["1", "2", "3", "4", "5"]
RECENT_MONTHS = -12


def status_number(status: Column | str = "STATUS") -> Column:
    return map_codes(status, STATUS_NUMBERS)


def bureau_balance_loan(bureau_balance: DataFrame) -> DataFrame:
    """One row per bureau credit: history length, months past due, worst and recent status.

    Lifetime and recent figures come from one conditional aggregation, so the largest input
    is scanned and shuffled once, after map-side combining.
    """
    past_due = F.col("STATUS").isin(PAST_DUE_STATUSES)
    recent = F.col("MONTHS_BALANCE") >= RECENT_MONTHS
    number = status_number()
    return (
        bureau_balance.where(F.col("SK_ID_BUREAU").isNotNull())
        .groupBy("SK_ID_BUREAU")
        .agg(
            F.count("MONTHS_BALANCE").alias("bb_months_count"),
            F.min("MONTHS_BALANCE").alias("bb_months_min"),
            F.count_if(past_due).alias("bb_dpd_count"),
            F.count_if(F.col("STATUS") == "C").alias("bb_status_C_count"),
            F.max(number).alias("bb_status_num_max"),
            F.avg(number).alias("bb_status_num_mean"),
            subset_count(recent, past_due).alias("bb_recent_dpd_count"),
            F.max(only(recent, number)).alias("bb_recent_worst"),
        )
        .withColumn("bb_dpd_rate", ratio("bb_dpd_count", "bb_months_count"))
    )


def join_rollup(bureau: DataFrame, balance_loan: DataFrame) -> DataFrame:
    """Every bureau credit with its monthly summary, if it has one."""
    return bureau.join(balance_loan, "SK_ID_BUREAU", "left")


def bureau_client(bureau: DataFrame, bureau_balance: DataFrame | None) -> DataFrame:
    """One row per client, columns prefixed ``buro_``; without monthly balances, those of the credits only."""
    credits = bureau.where(F.col("SK_ID_CURR").isNotNull())
    active = F.col("CREDIT_ACTIVE") == "Active"
    aggregates = {
        "loan_count": F.count("SK_ID_BUREAU"),
        "active_count": F.count_if(active),
        "closed_count": F.count_if(F.col("CREDIT_ACTIVE") == "Closed"),
        "prolonged_sum": sum0("CNT_CREDIT_PROLONG"),
        "credit_sum_mean": F.avg("AMT_CREDIT_SUM"),
        "credit_sum_max": F.max("AMT_CREDIT_SUM"),
        "debt_sum": sum0("AMT_CREDIT_SUM_DEBT"),
        "overdue_sum": sum0("AMT_CREDIT_SUM_OVERDUE"),
        "overdue_max": F.max("AMT_CREDIT_SUM_OVERDUE"),
        "dpd_max": F.max("CREDIT_DAY_OVERDUE"),
        "ever_overdue": any_flag(F.col("CREDIT_DAY_OVERDUE") > 0),
        "days_credit_max": F.max("DAYS_CREDIT"),
        "days_credit_mean": F.avg("DAYS_CREDIT"),
        "active_credit_mean": F.avg(only(active, "AMT_CREDIT_SUM")),
        "active_debt_sum": subset_sum(active, "AMT_CREDIT_SUM_DEBT"),
        "active_overdue_max": of_subset(active, F.max(only(active, "AMT_CREDIT_SUM_OVERDUE"))),
    }
    derived = {
        "active_ratio": ratio("active_count", "loan_count"),
        "overdue_ratio": flag(F.col("overdue_sum") > 0),
        "debt_ratio": ratio("debt_sum", "credit_sum_mean"),
    }
    if bureau_balance is not None:
        credits = join_rollup(credits, bureau_balance_loan(bureau_balance))
        aggregates |= {
            "worst_status": F.max("bb_status_num_max"),
            "dpd_total": sum0("bb_dpd_count"),
            "dpd_rate_mean": F.avg("bb_dpd_rate"),
            "months_total": sum0("bb_months_count"),
            "recent_dpd_sum": sum0("bb_recent_dpd_count"),
            "recent_worst": F.max("bb_recent_worst"),
        }
        derived["recent_vs_overall"] = F.col("recent_worst") - F.col("worst_status")
    totals = credits.groupBy("SK_ID_CURR").agg(*[a.alias(c) for c, a in aggregates.items()])
    return add_prefix(totals.withColumns(derived), "buro_", keep=["SK_ID_CURR"])
