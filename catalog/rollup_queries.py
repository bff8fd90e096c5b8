"""Joins, aggregations, ordered work and the feature groups."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from catalog.registry import (
    DIMENSIONS,
    APP_CLEAN,
    APP_RAW,
    CONFIG,
    INST_COLUMNS,
    TEXTS,
    Query,
    app,
    encoding_sql,
    groups,
    matrix,
    missing_sql,
    query,
    rounded,
    train_of,
)
from lendstrata.functions import nulls as n
from lendstrata.operators import aggregate, application, bureau, columns, encode, explain, folds, history, ordered, target
from lendstrata.plans import features
from lendstrata.sources import buckets, sinks


# ---- joins ----------------------------------------------------------------

_GROUP_CTES = ["buro_client", "prev_client", "pos_client", "inst_client", "card_client"]

@query(
    "join_spine",
    o.rounded(
        "SELECT * FROM (SELECT SK_ID_CURR FROM fx_application) "
        + " ".join(f"LEFT JOIN {c} USING (SK_ID_CURR)" for c in _GROUP_CTES),
        ["SK_ID_CURR"],
        "fx_application",
        *_GROUP_CTES,
    ),
)
def _(s, d):
    return rounded(features.join_spine(app(s, d).select("SK_ID_CURR"), *groups(s, d)), ["SK_ID_CURR"])


@query(
    "join_rollup",
    o.rounded(
        "SELECT SK_ID_BUREAU, SK_ID_CURR, AMT_CREDIT_SUM, bb_months_count, bb_dpd_count, bb_status_num_max, bb_dpd_rate FROM buro_rows",
        ["SK_ID_BUREAU", "SK_ID_CURR"],
        "buro_rows",
    ),
)
def _(s, d):
    joined = bureau.join_rollup(
        fx.fixture(s, d, "fx_bureau"), bureau.bureau_balance_loan(fx.fixture(s, d, "fx_bureau_balance"))
    )
    ids = ["SK_ID_BUREAU", "SK_ID_CURR"]
    return rounded(
        joined.select(*ids, "AMT_CREDIT_SUM", "bb_months_count", "bb_dpd_count", "bb_status_num_max", "bb_dpd_rate"), ids
    )


@query(
    "join_bridge",
    o.rounded(
        "SELECT p.SK_ID_PREV, p.SK_ID_CURR, l.* EXCLUDE (SK_ID_PREV) FROM fx_previous p LEFT JOIN pos_loan l USING (SK_ID_PREV)",
        ["SK_ID_PREV", "SK_ID_CURR"],
        "fx_previous",
        "pos_loan",
    ),
)
def _(s, d):
    bridge = fx.fixture(s, d, "fx_previous").select("SK_ID_PREV", "SK_ID_CURR")
    return rounded(history.join_bridge(bridge, history.pos_loan(fx.fixture(s, d, "fx_pos"))), ["SK_ID_PREV", "SK_ID_CURR"])


_SUBSET_SQL = """
SELECT t.SK_ID_CURR, loan_count, active_debt_sum, active_credit_mean FROM
 (SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS loan_count FROM fx_bureau WHERE SK_ID_CURR IS NOT NULL GROUP BY 1) t
 LEFT JOIN (SELECT SK_ID_CURR, coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS active_debt_sum,
   avg(AMT_CREDIT_SUM) AS active_credit_mean FROM fx_bureau WHERE CREDIT_ACTIVE = 'Active' GROUP BY 1) a USING (SK_ID_CURR)"""


def _subset(s: SparkSession, d: str) -> DataFrame:
    active = F.col("CREDIT_ACTIVE") == "Active"
    out = (
        fx.fixture(s, d, "fx_bureau")
        .where("SK_ID_CURR IS NOT NULL")
        .groupBy("SK_ID_CURR")
        .agg(
            F.count("SK_ID_BUREAU").alias("loan_count"),
            n.subset_sum(active, "AMT_CREDIT_SUM_DEBT").alias("active_debt_sum"),
            F.avg(n.only(active, "AMT_CREDIT_SUM")).alias("active_credit_mean"),
        )
    )
    return rounded(out, ["SK_ID_CURR"])


query("join_subset_agg", o.rounded(_SUBSET_SQL, ["SK_ID_CURR"], "fx_bureau"))(_subset)
_RECENT_SQL = (
    "SELECT SK_ID_CURR, sum(AMT_CREDIT_SUM) FILTER (WHERE DAYS_CREDIT >= -1500) AS recent_sum, max(CREDIT_DAY_OVERDUE) FILTER (WHERE DAYS_CREDIT >= -1500) "
    "AS recent_overdue, CASE WHEN count(*) FILTER (WHERE DAYS_CREDIT >= -1500) > 0 THEN count(*) FILTER (WHERE DAYS_CREDIT >= -1500 AND CNT_CREDIT_PROLONG > 0) END "
    "AS recent_prolonged FROM fx_bureau WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR"
)


@query("agg_subset", o.rounded(_RECENT_SQL, ["SK_ID_CURR"], "fx_bureau"))
def _(s, d):
    """Sum, maximum and count of a subset that some clients have no row in."""
    recent = F.col("DAYS_CREDIT") >= -1500
    out = (
        fx.fixture(s, d, "fx_bureau")
        .where("SK_ID_CURR IS NOT NULL")
        .groupBy("SK_ID_CURR")
        .agg(
            n.subset_sum(recent, "AMT_CREDIT_SUM").alias("recent_sum"),
            F.max(n.only(recent, "CREDIT_DAY_OVERDUE")).alias("recent_overdue"),
            n.subset_count(recent, F.col("CNT_CREDIT_PROLONG") > 0).alias("recent_prolonged"),
        )
    )
    return rounded(out, ["SK_ID_CURR"])


@query(
    "join_encoding",
    o.rounded(
        f"SELECT a.SK_ID_CURR, coalesce(e.encoded, (SELECT avg(TARGET) FROM app_clean)) AS ORGANIZATION_TYPE "
        f"FROM app_clean a LEFT JOIN ({encoding_sql('TRUE')}) e ON a.ORGANIZATION_TYPE = e.category",
        ["SK_ID_CURR"],
        "app_clean",
        digits=6,
    ),
)
def _(s, d):
    df = columns.fill_category(app(s, d), ["ORGANIZATION_TYPE"])
    fitted = target.target_encode_full(df, ["ORGANIZATION_TYPE"], "TARGET")
    joined = target.join_encoding(df, fitted.table, fitted.columns, F.lit(fitted.global_mean))
    return rounded(joined.select("SK_ID_CURR", "ORGANIZATION_TYPE"), ["SK_ID_CURR"], 6)


# ---- aggregations ---------------------------------------------------------

_BASIC = ["mean", "max", "min", "sum", "count"]


@query(
    "agg_basic",
    o.rounded(
        "SELECT SK_ID_PREV, avg(AMT_PAYMENT) AS AMT_PAYMENT_mean, max(AMT_PAYMENT) AS AMT_PAYMENT_max, min(AMT_PAYMENT) AS "
        "AMT_PAYMENT_min, coalesce(sum(AMT_PAYMENT), 0) AS AMT_PAYMENT_sum, count(AMT_PAYMENT) AS AMT_PAYMENT_count "
        "FROM fx_installments GROUP BY SK_ID_PREV",
        ["SK_ID_PREV"],
        "fx_installments",
    ),
)
def _(s, d):
    return rounded(
        aggregate.agg_numeric(fx.fixture(s, d, "fx_installments"), "SK_ID_PREV", ["AMT_PAYMENT"], _BASIC), ["SK_ID_PREV"]
    )


@query(
    "agg_std",
    o.rounded(
        "SELECT SK_ID_PREV, stddev_samp(AMT_INSTALMENT) AS AMT_INSTALMENT_std, stddev_samp(AMT_PAYMENT) AS AMT_PAYMENT_std "
        "FROM fx_installments GROUP BY SK_ID_PREV",
        ["SK_ID_PREV"],
        "fx_installments",
    ),
)
def _(s, d):
    out = aggregate.agg_numeric(
        fx.fixture(s, d, "fx_installments"), "SK_ID_PREV", ["AMT_INSTALMENT", "AMT_PAYMENT"], ["std"]
    )
    return rounded(out, ["SK_ID_PREV"])


def _previous(s: SparkSession, d: str, *names: str) -> DataFrame:
    """Chosen aggregates of the earlier loans per client."""
    chosen = history.previous_aggregates()
    return (
        fx.fixture(s, d, "fx_previous")
        .where("SK_ID_CURR IS NOT NULL")
        .groupBy("SK_ID_CURR")
        .agg(*[chosen[c].alias(c) for c in names])
    )


def _previous_query(name: str, *names: str) -> None:
    sql = o.rounded(f"SELECT SK_ID_CURR, {', '.join(names)} FROM prev_client", ["SK_ID_CURR"], "prev_client")
    query(name, sql)(lambda s, d: rounded(_previous(s, d, *names), ["SK_ID_CURR"]))


_previous_query("agg_count_if", "prev_approved_count", "prev_refused_count", "prev_canceled_count", "prev_unused_count")
_previous_query("agg_mean_ratio", "prev_approval_ratio")
_previous_query("last_status_flag", "prev_last_was_refused")
_previous_query("growth_first_last", "prev_credit_ask_growth")


@query(
    "agg_any",
    o.sql(
        "SELECT SK_ID_PREV, max(CASE WHEN NAME_CONTRACT_STATUS = 'Demand' THEN 1 ELSE 0 END) AS ever_demand, "
        "max(CASE WHEN CNT_INSTALMENT_FUTURE > 20 THEN 1 ELSE 0 END) AS ever_long FROM fx_pos GROUP BY SK_ID_PREV",
        "fx_pos",
    ),
)
def _(s, d):
    return fx.fixture(s, d, "fx_pos").groupBy("SK_ID_PREV").agg(
        n.any_flag(F.col("NAME_CONTRACT_STATUS") == "Demand").alias("ever_demand"),
        n.any_flag(F.col("CNT_INSTALMENT_FUTURE") > 20).alias("ever_long"),
    )


@query(
    "agg_recent",
    o.rounded("SELECT SK_ID_BUREAU, bb_dpd_count, bb_recent_dpd_count, bb_recent_worst FROM bb_loan", ["SK_ID_BUREAU"], "bb_loan"),
)
def _(s, d):
    out = bureau.bureau_balance_loan(fx.fixture(s, d, "fx_bureau_balance"))
    return rounded(out.select("SK_ID_BUREAU", "bb_dpd_count", "bb_recent_dpd_count", "bb_recent_worst"), ["SK_ID_BUREAU"])


@query(
    "agg_two_level",
    o.rounded("SELECT SK_ID_CURR, pos_dpd_mean, pos_late_rate_mean, pos_completion_mean FROM pos_client", ["SK_ID_CURR"], "pos_client"),
)
def _(s, d):
    out = history.pos_client(fx.fixture(s, d, "fx_pos"), fx.fixture(s, d, "fx_previous"))
    return rounded(out.select("SK_ID_CURR", "pos_dpd_mean", "pos_late_rate_mean", "pos_completion_mean"), ["SK_ID_CURR"])


@query("agg_first_last", o.rounded("SELECT SK_ID_CURR, first_ask, last_ask FROM prev_first_last", ["SK_ID_CURR"], "prev_first_last"))
def _(s, d):
    first, last = history.first_last_ask()
    previous = fx.fixture(s, d, "fx_previous").where("SK_ID_CURR IS NOT NULL")
    out = previous.groupBy("SK_ID_CURR").agg(first.alias("first_ask"), last.alias("last_ask"))
    return rounded(out, ["SK_ID_CURR"])


@query("trend_delta", o.rounded("SELECT SK_ID_PREV, cc_recent_utilization, cc_utilization_mean, cc_util_trend FROM card_loan", ["SK_ID_PREV"], "card_loan"))
def _(s, d):
    out = history.card_loan(fx.fixture(s, d, "fx_credit_card"), fx.CARD_TIES)
    return rounded(out.select("SK_ID_PREV", "cc_recent_utilization", "cc_utilization_mean", "cc_util_trend"), ["SK_ID_PREV"])


@query(
    "nunique_profile",
    o.sql(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM app_fixed" for c in TEXTS), "app_fixed"),
)
def _(s, d):
    return columns.nunique_profile(application.fix_anomalies(app(s, d)), TEXTS)


@query(
    "missing_profile",
    o.rounded(missing_sql(APP_RAW, "app_fixed", "TRUE"), ["column_name"], "app_fixed", digits=6),
)
def _(s, d):
    return rounded(columns.missing_profile(application.fix_anomalies(app(s, d)), APP_RAW), ["column_name"], 6)


# ---- windows, folds, samples ----------------------------------------------

@query(
    "window_diff",
    o.rounded("SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS change FROM events", ["event_id"]),
)
def _(s, d):
    out = ordered.lag_within(
        fx.source(s, d, "events").select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], "value", "before"
    )
    return rounded(out.select("event_id", (F.col("value") - F.col("before")).alias("change")), ["event_id"])


_LATEST_IDS = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]


@query(
    "latest_version",
    o.rounded(f"SELECT {', '.join(_LATEST_IDS)}, DAYS_INSTALMENT, {', '.join(INST_COLUMNS)} FROM inst_latest", _LATEST_IDS, "inst_latest"),
)
def _(s, d):
    out = history.latest_version(history.install_row_features(fx.fixture(s, d, "fx_installments")), fx.INSTALLMENT_TIES)
    return rounded(out.select(*_LATEST_IDS, "DAYS_INSTALMENT", *INST_COLUMNS), _LATEST_IDS)


@query("stratified_folds", o.sql("SELECT id, label, fold FROM folded", "folded"))
def _(s, d):
    return folds.stratified_folds(fx.fixture(s, d, "fx_scored"), "id", "label").select("id", "label", "fold")


@query(
    "sample_n",
    "SELECT event_id, user_id, value FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id LIMIT 1000",
)
def _(s, d):
    return folds.sample_n(fx.source(s, d, "events").select("event_id", "user_id", "value"), "event_id", 1000)


_IMPORTANCE_SQL = (
    "SELECT 'f' || CAST(i - 1 AS VARCHAR) AS feature, avg(abs(CAST(c AS DOUBLE))) AS importance FROM "
    "(SELECT unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i "
    "ORDER BY importance DESC, feature LIMIT "
)
def _importance(s: SparkSession, d: str, top: int) -> DataFrame:
    df = fx.source(s, d, "embeddings").select("embedding")
    return rounded(explain.global_importance(df, F.col("embedding"), DIMENSIONS, top), ["feature"], 6)


@query(
    "top_n_importance",
    "SELECT p_brand AS feature, round(avg(p_retailprice), 6) AS importance FROM part GROUP BY p_brand ORDER BY avg(p_retailprice) DESC, feature LIMIT 7",
)
def _(s, d):
    """The largest rows of any importance table."""
    table = fx.source(s, d, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.avg("p_retailprice"), 6).alias("importance"))
    return explain.top_n_importance(table, 7)


query("global_importance", o.rounded(_IMPORTANCE_SQL + "20", ["feature"], digits=6))(lambda s, d: _importance(s, d, 20))


# ---- feature groups -------------------------------------------------------

def _group(name: str, cte: str, key: str, build: Query) -> None:
    query(name, o.rounded(f"SELECT * FROM {cte}", [key], cte))(lambda s, d: rounded(build(s, d), [key]))


_group("bureau_balance_loan", "bb_loan", "SK_ID_BUREAU", lambda s, d: bureau.bureau_balance_loan(fx.fixture(s, d, "fx_bureau_balance")))
_group("bureau_client", "buro_client", "SK_ID_CURR", lambda s, d: bureau.bureau_client(fx.fixture(s, d, "fx_bureau"), fx.fixture(s, d, "fx_bureau_balance")))
_group("previous_client", "prev_client", "SK_ID_CURR", lambda s, d: history.previous_client(fx.fixture(s, d, "fx_previous")))
_group("pos_loan", "pos_loan", "SK_ID_PREV", lambda s, d: history.pos_loan(fx.fixture(s, d, "fx_pos")))
_group("pos_client", "pos_client", "SK_ID_CURR", lambda s, d: history.pos_client(fx.fixture(s, d, "fx_pos"), fx.fixture(s, d, "fx_previous")))
_group("install_loan", "inst_loan", "SK_ID_PREV", lambda s, d: history.install_loan(fx.fixture(s, d, "fx_installments"), fx.INSTALLMENT_TIES))
_group(
    "install_client",
    "inst_client",
    "SK_ID_CURR",
    lambda s, d: history.install_client(fx.fixture(s, d, "fx_installments"), fx.fixture(s, d, "fx_previous"), fx.INSTALLMENT_TIES),
)
_group("card_loan", "card_loan", "SK_ID_PREV", lambda s, d: history.card_loan(fx.fixture(s, d, "fx_credit_card"), fx.CARD_TIES))
_group(
    "card_client",
    "card_client",
    "SK_ID_CURR",
    lambda s, d: history.card_client(fx.fixture(s, d, "fx_credit_card"), fx.fixture(s, d, "fx_previous"), fx.CARD_TIES),
)


@query(
    "application_clean",
    o.rounded(f"SELECT {', '.join(APP_CLEAN)}, split FROM app_clean", ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"], "app_clean"),
)
def _(s, d):
    raw = app(s, d)
    fitted = encode.fit_encoding(application.app_features(application.fix_anomalies(train_of(raw))))
    # the split marker is not a feature, so the plan leaves it alone
    return rounded(features.application_clean(raw, fitted).select(*APP_CLEAN, "split"), ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"])


@query(
    "build_features",
    o.rounded(
        "SELECT * EXCLUDE (MOSTLY_MISSING) REPLACE (CASE WHEN split = 'train' THEN TARGET END AS TARGET) FROM crossed",
        ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"],
        "crossed",
    ),
)
def build_features(s: SparkSession, d: str) -> DataFrame:
    return rounded(matrix(s, d).matrix, ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"])


@query(
    "build_features_bucketed",
    o.rounded(
        "SELECT * EXCLUDE (MOSTLY_MISSING) REPLACE (CASE WHEN split = 'train' THEN TARGET END AS TARGET) FROM crossed",
        ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"],
        "crossed",
    ),
)
def _(s, d):
    """The full build over histories that were stored by their keys."""
    name = uuid.uuid4().hex
    stored = buckets.store_histories(fx.tables(s, d), f"{sinks.work_folder(s)}/histories-{name}", f"h_{name}")
    built = features.build_features(stored, replace(CONFIG, placed=True))
    buckets.drop_histories(s, f"h_{name}")
    return rounded(built.matrix, ["SK_ID_CURR", "split", "ORGANIZATION_TYPE"])
