"""Earlier loans of a client and their payment histories.

Each history table is first rolled up to one row per loan. A loan table row then picks up the
rolled-up histories by ``SK_ID_PREV`` and one aggregation by ``SK_ID_CURR`` finishes all groups,
so every group counts all earlier loans of a client, with or without history rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendstrata.functions.nulls import (
    any_flag,
    clip_high,
    clip_low,
    first_present,
    flag,
    last_present,
    nulls_last,
    of_subset,
    only,
    ratio,
    sentinel_to_null,
    subset_count,
    subset_sum,
    sum0,
)
from lendstrata.operators.ordered import HOT_ROWS, hot_keys, lag_within

# Fixed values of the data.
DAY_SENTINEL = 365243
DAY_SENTINEL_COLUMNS = [
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
]
DUE_STATUSES = ["Active", "Completed", "Demand"]
RECENT_MONTHS = -12
RECENT_DAYS = -365
VERY_LATE_DAYS = 30
UTILIZATION_CAP = 1.5
MAXED_ABOVE = 0.9
OVER_LIMIT_ABOVE = 1.0


# ---- previous applications ------------------------------------------------


def previous_clean(previous: DataFrame) -> DataFrame:
    """Day columns without the 'no event' sentinel."""
    return previous.withColumns(
        {c: sentinel_to_null(c, DAY_SENTINEL) for c in DAY_SENTINEL_COLUMNS if c in previous.columns}
    )


def _decision_order() -> Column:
    """Decision day, missing last, then loan id, as one number.

    A number, unlike a struct, keeps the client aggregation a hash aggregation. Ids have fewer
    than 20 digits, so the day always decides first.
    """
    day = F.coalesce(F.col("DAYS_DECISION").cast("decimal(11,0)"), F.lit(10**10).cast("decimal(11,0)"))
    return day * F.lit(str(10**20)).cast("decimal(21,0)") + F.col("SK_ID_PREV").cast("decimal(20,0)")


def last_status_flag() -> Column:
    """Aggregate: 1 if the newest application was refused."""
    return flag(last_present(F.col("NAME_CONTRACT_STATUS") == "Refused", _decision_order()))


def first_last_ask() -> tuple[Column, Column]:
    """Aggregates: the oldest and the newest requested amount."""
    order = _decision_order()
    return first_present("AMT_APPLICATION", order), last_present("AMT_APPLICATION", order)


def growth_first_last() -> Column:
    """Aggregate: newest requested amount over the oldest one."""
    first, last = first_last_ask()
    return ratio(last, first)


def previous_aggregates() -> dict[str, Column]:
    status = F.col("NAME_CONTRACT_STATUS")
    approved = status == "Approved"
    return {
        "prev_app_count": F.count("SK_ID_PREV"),
        "prev_approved_count": F.count_if(approved),
        "prev_refused_count": F.count_if(status == "Refused"),
        "prev_canceled_count": F.count_if(status == "Canceled"),
        "prev_unused_count": F.count_if(status == "Unused offer"),
        "prev_ever_refused_HC": any_flag(F.col("CODE_REJECT_REASON") == "HC"),
        "prev_ever_refused_SCOFR": any_flag(F.col("CODE_REJECT_REASON") == "SCOFR"),
        "prev_credit_mean": F.avg(only(approved, "AMT_CREDIT")),
        "prev_credit_max": F.max(only(approved, "AMT_CREDIT")),
        "prev_annuity_mean": F.avg(only(approved, "AMT_ANNUITY")),
        "prev_application_mean": F.avg(only(approved, "AMT_APPLICATION")),
        "prev_term_mean": F.avg(only(approved, "CNT_PAYMENT")),
        "prev_insured_rate": F.avg(only(approved, "NFLAG_INSURED_ON_APPROVAL")),
        "prev_approval_ratio": F.avg(only(approved, ratio("AMT_CREDIT", "AMT_APPLICATION"))),
        "prev_days_decision_max": F.max("DAYS_DECISION"),
        "prev_days_decision_mean": F.avg("DAYS_DECISION"),
        "prev_refusal_rate": ratio(F.count_if(status == "Refused"), F.count("SK_ID_PREV")),
        "prev_days_since_last_app": -F.max("DAYS_DECISION"),
        "prev_last_was_refused": last_status_flag(),
        "prev_credit_ask_growth": growth_first_last(),
    }


# ---- point-of-sale and cash loans -----------------------------------------


def pos_loan(pos_cash: DataFrame) -> DataFrame:
    """One row per loan. Days past due only count on rows where a payment could be due."""
    status = F.col("NAME_CONTRACT_STATUS")
    due = status.isin(DUE_STATUSES)
    recent = due & (F.col("MONTHS_BALANCE") >= RECENT_MONTHS)
    late = F.col("SK_DPD") > 0
    return (
        pos_cash.where(F.col("SK_ID_PREV").isNotNull())
        .groupBy("SK_ID_PREV")
        .agg(
            F.count("MONTHS_BALANCE").alias("pos_months_count"),
            F.max("CNT_INSTALMENT").alias("pos_instalment_total"),
            F.min("CNT_INSTALMENT_FUTURE").alias("pos_instalment_future"),
            any_flag(status == "Demand").alias("pos_ever_demand"),
            any_flag(status == "Completed").alias("pos_completed"),
            F.max(only(due, "SK_DPD")).alias("pos_dpd_max"),
            F.avg(only(due, "SK_DPD")).alias("pos_dpd_mean"),
            subset_count(due, late).alias("pos_late_count"),
            F.max(only(due, "SK_DPD_DEF")).alias("pos_dpd_def_max"),
            F.max(only(recent, "SK_DPD")).alias("pos_recent_dpd_max"),
            subset_count(recent, late).alias("pos_recent_late_count"),
            of_subset(recent, any_flag(recent & (status == "Demand"))).alias("pos_recent_demand"),
        )
        .withColumns(
            {
                "pos_completion_ratio": 1 - ratio("pos_instalment_future", "pos_instalment_total"),
                "pos_late_rate": ratio("pos_late_count", "pos_months_count"),
            }
        )
    )


def pos_aggregates() -> dict[str, Column]:
    return {
        "pos_loan_count": F.count("SK_ID_PREV"),
        "pos_dpd_max": F.max("pos_dpd_max"),
        "pos_dpd_mean": F.avg("pos_dpd_mean"),
        "pos_late_rate_mean": F.avg("pos_late_rate"),
        "pos_ever_demand": F.max("pos_ever_demand"),
        "pos_completed_count": sum0("pos_completed"),
        "pos_completion_mean": F.avg("pos_completion_ratio"),
        "pos_recent_dpd_max": F.max("pos_recent_dpd_max"),
        "pos_recent_demand": F.max("pos_recent_demand"),
    }


# ---- installments ---------------------------------------------------------


def install_row_features(installments: DataFrame, late_above: int = 0) -> DataFrame:
    """Lateness and completeness of each payment row; late is more than ``late_above`` days."""
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    deficit = F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")
    return installments.select(
        "*",
        late.alias("days_late"),
        clip_low(late, 0).alias("days_late_pos"),
        clip_low(-late, 0).alias("days_early_pos"),
        ratio("AMT_PAYMENT", "AMT_INSTALMENT").alias("payment_ratio"),
        deficit.alias("payment_deficit"),
        flag(late > late_above).alias("is_late"),
        flag(late > VERY_LATE_DAYS).alias("is_very_late"),
        flag(deficit > 0).alias("is_underpaid"),
        flag(late < 0).alias("is_early"),
        F.col("DAYS_ENTRY_PAYMENT").isNull().cast("int").alias("is_missing"),
    )


INSTALLMENT_TIES = ["DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"]


_VERSION_SETS = {
    "DAYS_INSTALMENT": ["DAYS_INSTALMENT"],
    "days_late": ["days_late", "days_late_pos", "days_early_pos"],
    "payment_deficit": ["payment_ratio", "payment_deficit"],
    "is_missing": ["is_late", "is_very_late", "is_underpaid", "is_early", "is_missing"],
}
_VERSION_KEY = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]


def latest_version(rows: DataFrame, ties: list[str] | None = None, combine: bool = False) -> DataFrame:
    """One row per (loan, installment): for each column the newest version's present value.

    ``ties`` order the rows of one version; a missing version counts as the newest. Columns that are missing
    together come from one row. One sort per key finds these rows, and plain maxima pick them. With ``combine``
    each task first picks among its own rows, for tables where one key has very many.
    """
    rows = rows.where(F.col("SK_ID_PREV").isNotNull() & F.col("NUM_INSTALMENT_NUMBER").isNotNull())
    ties = ties or INSTALLMENT_TIES
    if combine:
        order = F.struct(*nulls_last("NUM_INSTALMENT_VERSION", 0.0), *[F.col(t) for t in ties])
        newest = [
            F.max_by(F.struct(*fields), F.when(F.col(c).isNotNull(), order)).alias(f"_{c}")
            for c, fields in _VERSION_SETS.items()
        ]
        picked = rows.groupBy(*_VERSION_KEY).agg(*newest)
        return picked.select(*_VERSION_KEY, *[F.col(f"_{c}.{x}") for c, fields in _VERSION_SETS.items() for x in fields])
    version = F.col("NUM_INSTALMENT_VERSION")
    newest_first = [version.isNull().desc(), version.desc(), *[F.col(t).desc_nulls_last() for t in ties]]
    so_far = (
        Window.partitionBy(*_VERSION_KEY).orderBy(*newest_first).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = rows.select("*", *[F.count(c).over(so_far).alias(f"_seen_{c}") for c in _VERSION_SETS])
    picked = [
        F.max(F.when((F.col(f"_seen_{c}") == 1) & F.col(c).isNotNull(), F.col(x))).alias(x)
        for c, fields in _VERSION_SETS.items()
        for x in fields
    ]
    return numbered.groupBy(*_VERSION_KEY).agg(*picked)


def install_loan(
    installments: DataFrame, ties: list[str] | None = None, hot_rows: int = HOT_ROWS, placed: bool = False
) -> DataFrame:
    """One row per loan, from the newest version of each installment.

    Rows placed by loan serve both aggregations with one shuffle; a table that is stored that way (``placed``) needs none. Loans that
    are too large for one task, and only they, go another way, on which each aggregation combines before its own shuffle.
    """
    rows = installments.where(F.col("SK_ID_PREV").isNotNull())
    hot = hot_keys(installments, "SK_ID_PREV", hot_rows)

    def by_loan(some: DataFrame) -> DataFrame:
        return _loan_figures(latest_version(install_row_features(some if placed else some.repartition("SK_ID_PREV")), ties))

    if not hot.rows:
        return by_loan(rows)
    keys = hot.side(hot.table.where(F.col("SK_ID_PREV").isNotNull()).select("SK_ID_PREV"))
    cold = by_loan(rows.join(keys, "SK_ID_PREV", "left_anti"))
    warm = rows.join(keys, "SK_ID_PREV", "left_semi")
    return cold.unionByName(_loan_figures(latest_version(install_row_features(warm), ties, combine=True)))


def _loan_figures(newest: DataFrame) -> DataFrame:
    recent = F.col("DAYS_INSTALMENT") >= RECENT_DAYS
    return (
        newest.groupBy("SK_ID_PREV")
        .agg(
            F.count("NUM_INSTALMENT_NUMBER").alias("inst_count"),
            F.max("days_late").alias("inst_days_late_max"),
            F.avg("days_late").alias("inst_days_late_mean"),
            sum0("days_late_pos").alias("inst_days_late_sum"),
            sum0("is_late").alias("inst_late_count"),
            sum0("is_very_late").alias("inst_very_late_count"),
            sum0("is_early").alias("inst_early_count"),
            F.avg("days_early_pos").alias("inst_days_early_mean"),
            F.avg("payment_ratio").alias("inst_payment_ratio_mean"),
            F.min("payment_ratio").alias("inst_payment_ratio_min"),
            sum0("payment_deficit").alias("inst_payment_deficit_sum"),
            F.max("payment_deficit").alias("inst_payment_deficit_max"),
            sum0("is_underpaid").alias("inst_underpaid_count"),
            sum0("is_missing").alias("inst_missing_count"),
            F.max(only(recent, "days_late")).alias("inst_recent_days_late_max"),
            subset_sum(recent, "is_late").alias("inst_recent_late_count"),
            F.avg(only(recent, "payment_ratio")).alias("inst_recent_payment_ratio"),
            subset_sum(recent, "payment_deficit").alias("inst_recent_deficit_sum"),
        )
        .withColumns(
            {
                "inst_late_rate": ratio("inst_late_count", "inst_count"),
                "inst_very_late_rate": ratio("inst_very_late_count", "inst_count"),
                "inst_early_rate": ratio("inst_early_count", "inst_count"),
            }
        )
    )


def install_aggregates() -> dict[str, Column]:
    return {
        "inst_loan_count": F.count("SK_ID_PREV"),
        "inst_days_late_max": F.max("inst_days_late_max"),
        "inst_days_late_mean": F.avg("inst_days_late_mean"),
        "inst_late_rate_mean": F.avg("inst_late_rate"),
        "inst_very_late_rate_mean": F.avg("inst_very_late_rate"),
        "inst_payment_ratio_mean": F.avg("inst_payment_ratio_mean"),
        "inst_payment_ratio_min": F.min("inst_payment_ratio_min"),
        "inst_deficit_sum": sum0("inst_payment_deficit_sum"),
        "inst_early_rate_mean": F.avg("inst_early_rate"),
        "inst_days_early_mean": F.avg("inst_days_early_mean"),
        "inst_missing_sum": sum0("inst_missing_count"),
        "inst_recent_days_late_max": F.max("inst_recent_days_late_max"),
        "inst_recent_payment_ratio": F.avg("inst_recent_payment_ratio"),
        "inst_recent_deficit_sum": sum0("inst_recent_deficit_sum"),
    }


# ---- credit cards ---------------------------------------------------------

CARD_TIES = ["AMT_BALANCE", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_DRAWINGS_CURRENT"]


def card_row_features(credit_card: DataFrame, ties: list[str] | None = None, **lag_options) -> DataFrame:
    """Utilization, payment, cash-advance and balance-trend signals of each card month."""
    utilization = clip_high(ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), UTILIZATION_CAP)
    paid = F.col("AMT_PAYMENT_TOTAL_CURRENT")
    ordered = lag_within(
        credit_card,
        key="SK_ID_PREV",
        order=["MONTHS_BALANCE", *(ties or CARD_TIES)],
        value="AMT_BALANCE",
        out="previous_balance",
        **lag_options,
    )
    return ordered.select(
        *credit_card.columns,
        utilization.alias("utilization"),
        flag(paid >= F.col("AMT_INST_MIN_REGULARITY")).alias("paid_min"),
        flag(paid >= F.col("AMT_BALANCE")).alias("paid_full"),
        F.coalesce(ratio("AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT"), F.lit(0.0)).alias("atm_ratio"),
        (F.col("AMT_BALANCE") - F.col("previous_balance")).alias("balance_change"),
        flag(utilization > MAXED_ABOVE).alias("is_maxed"),
        flag(utilization > OVER_LIMIT_ABOVE).alias("is_overlimit"),
    )


def card_loan(credit_card: DataFrame, ties: list[str] | None = None, **lag_options) -> DataFrame:
    recent = F.col("MONTHS_BALANCE") >= RECENT_MONTHS
    rows = card_row_features(credit_card.where(F.col("SK_ID_PREV").isNotNull()), ties, **lag_options)
    return (
        rows.groupBy("SK_ID_PREV")
        .agg(
            F.count("MONTHS_BALANCE").alias("cc_months_count"),
            F.avg("utilization").alias("cc_utilization_mean"),
            F.max("utilization").alias("cc_utilization_max"),
            sum0("is_maxed").alias("cc_maxed_count"),
            sum0("is_overlimit").alias("cc_overlimit_count"),
            F.avg("paid_min").alias("cc_paid_min_rate"),
            F.avg("paid_full").alias("cc_paid_full_rate"),
            F.avg("atm_ratio").alias("cc_atm_ratio_mean"),
            F.count_if(F.col("AMT_DRAWINGS_ATM_CURRENT") > 0).alias("cc_atm_months"),
            F.avg("AMT_DRAWINGS_CURRENT").alias("cc_drawings_mean"),
            F.avg("AMT_BALANCE").alias("cc_balance_mean"),
            F.max("SK_DPD").alias("cc_dpd_max"),
            F.avg("SK_DPD").alias("cc_dpd_mean"),
            F.count_if(F.col("SK_DPD") > 0).alias("cc_late_count"),
            any_flag(F.col("NAME_CONTRACT_STATUS") == "Demand").alias("cc_ever_demand"),
            F.avg("balance_change").alias("cc_balance_change_mean"),
            F.avg(only(recent, "utilization")).alias("cc_recent_utilization"),
            F.max(only(recent, "SK_DPD")).alias("cc_recent_dpd_max"),
            F.avg(only(recent, "paid_full")).alias("cc_recent_paid_full"),
            F.avg(only(recent, "atm_ratio")).alias("cc_recent_atm_ratio"),
        )
        .withColumns(
            {
                "cc_maxed_rate": ratio("cc_maxed_count", "cc_months_count"),
                "cc_late_rate": ratio("cc_late_count", "cc_months_count"),
                "cc_util_trend": F.col("cc_recent_utilization") - F.col("cc_utilization_mean"),
            }
        )
    )


def card_aggregates() -> dict[str, Column]:
    return {
        "cc_card_count": F.count("SK_ID_PREV"),
        "cc_utilization_mean": F.avg("cc_utilization_mean"),
        "cc_utilization_max": F.max("cc_utilization_max"),
        "cc_maxed_rate_mean": F.avg("cc_maxed_rate"),
        "cc_overlimit_ever": any_flag(F.col("cc_overlimit_count") > 0),
        "cc_paid_full_rate_mean": F.avg("cc_paid_full_rate"),
        "cc_paid_min_rate_mean": F.avg("cc_paid_min_rate"),
        "cc_atm_ratio_mean": F.avg("cc_atm_ratio_mean"),
        "cc_dpd_max": F.max("cc_dpd_max"),
        "cc_ever_demand": F.max("cc_ever_demand"),
        "cc_util_trend_mean": F.avg("cc_util_trend"),
        "cc_balance_change_mean": F.avg("cc_balance_change_mean"),
        "cc_recent_utilization": F.avg("cc_recent_utilization"),
        "cc_recent_dpd_max": F.max("cc_recent_dpd_max"),
    }


# ---- loan -> client -------------------------------------------------------

AGGREGATES: dict[str, Callable[[], dict[str, Column]]] = {
    "previous_app": previous_aggregates,
    "pos_cash": pos_aggregates,
    "installments": install_aggregates,
    "credit_card": card_aggregates,
}


def join_bridge(previous: DataFrame, *loan_tables: DataFrame) -> DataFrame:
    """Loans with their rolled-up histories, loans without history included.

    All joins share the key, so the loan table is shuffled once for any number of histories.
    """
    joined = previous
    for table in loan_tables:
        joined = joined.join(table, "SK_ID_PREV", "left")
    return joined


def history_client(previous: DataFrame, loan_tables: dict[str, DataFrame], with_previous: bool = True) -> DataFrame:
    """One row per client for the chosen groups, by one join chain and one aggregation.

    ``loan_tables`` is keyed ``pos_cash``, ``installments``, ``credit_card``; ``previous`` needs
    only its two id columns when its own group is left out.
    """
    bridge = previous.where(F.col("SK_ID_CURR").isNotNull())
    if not with_previous:
        bridge = bridge.select("SK_ID_PREV", "SK_ID_CURR")
    groups = (["previous_app"] if with_previous else []) + list(loan_tables)
    aggregates = {name: agg for g in groups for name, agg in AGGREGATES[g]().items()}
    return (
        join_bridge(bridge, *loan_tables.values())
        .groupBy("SK_ID_CURR")
        .agg(*[agg.alias(name) for name, agg in aggregates.items()])
    )


def previous_client(previous: DataFrame) -> DataFrame:
    return history_client(previous, {})


def pos_client(pos_cash: DataFrame, previous: DataFrame) -> DataFrame:
    return history_client(previous, {"pos_cash": pos_loan(pos_cash)}, with_previous=False)


def install_client(installments: DataFrame, previous: DataFrame, ties: list[str] | None = None) -> DataFrame:
    return history_client(previous, {"installments": install_loan(installments, ties)}, with_previous=False)


def card_client(credit_card: DataFrame, previous: DataFrame, ties: list[str] | None = None, **lag_options) -> DataFrame:
    return history_client(
        previous, {"credit_card": card_loan(credit_card, ties, **lag_options)}, with_previous=False
    )
