"""SQL for the checks, written the long way: filtered subsets are aggregated apart and joined back."""

from __future__ import annotations

from catalog import fixtures


def clip(x: str, low: str = "1") -> str:
    return f"(CASE WHEN {x} < {low} THEN {low} ELSE {x} END)"


def ratio(a: str, b: str) -> str:
    return f"(({a}) * 1.0E0 / {clip(b)})"


def flag(p: str) -> str:
    return f"(CASE WHEN {p} THEN 1 ELSE 0 END)"


def _app_features() -> str:
    return f"""
SELECT * EXCLUDE (CODE_GENDER, DAYS_EMPLOYED, DAYS_LAST_PHONE_CHANGE),
  CODE_GENDER, DAYS_EMPLOYED, DAYS_LAST_PHONE_CHANGE,
  {flag('DAYS_EMPLOYED IS NULL')} AS DAYS_EMPLOYED_ANOMALY,
  -DAYS_BIRTH / 365.0E0 AS AGE_YEARS, -DAYS_EMPLOYED / 365.0E0 AS EMPLOYED_YEARS,
  {ratio('AMT_CREDIT', 'AMT_INCOME_TOTAL')} AS CREDIT_INCOME_RATIO,
  {ratio('AMT_ANNUITY', '(AMT_INCOME_TOTAL / 12)')} AS ANNUITY_INCOME_RATIO,
  {ratio('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS CREDIT_GOODS_RATIO,
  {ratio('AMT_ANNUITY', 'AMT_CREDIT')} AS ANNUITY_CREDIT_RATIO,
  {ratio('AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')} AS INCOME_PER_PERSON,
  list_avg([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS EXT_SOURCE_MEAN,
  list_min([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS EXT_SOURCE_MIN,
  EXT_SOURCE_2 * EXT_SOURCE_3 AS EXT_SOURCE_2_3,
  EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 AS EXT_SOURCE_PROD,
  coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0) AS DOCS_PROVIDED,
  {ratio('DEF_30_CNT_SOCIAL_CIRCLE', 'OBS_30_CNT_SOCIAL_CIRCLE')} AS DEF_30_RATE,
  {ratio('DEF_60_CNT_SOCIAL_CIRCLE', 'OBS_60_CNT_SOCIAL_CIRCLE')} AS DEF_60_RATE
FROM app_fixed"""


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_VALID = "('Active', 'Completed', 'Demand')"
_ORDER = "ORDER BY NUM_INSTALMENT_VERSION ASC NULLS LAST, TIE_1, TIE_2, TIE_3"


def _newest(c: str) -> str:
    return f"last({c} {_ORDER}) FILTER (WHERE {c} IS NOT NULL) AS {c}"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    name: ((), fixtures.duck_sql(name)) for name in fixtures._VIEWS
}
CTES |= {
    "app_fixed": (
        ("fx_application",),
        """
SELECT * REPLACE (nullif(CODE_GENDER, 'XNA') AS CODE_GENDER, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED,
  nullif(DAYS_LAST_PHONE_CHANGE, 0) AS DAYS_LAST_PHONE_CHANGE) FROM fx_application""",
    ),
    "app_engineered": (("app_fixed",), _app_features()),
    "app_clean": (
        ("app_engineered",),
        """
SELECT * EXCLUDE (NAME_INCOME_TYPE, NAME_FREE_TEXT) REPLACE (
    CASE CODE_GENDER WHEN 'F' THEN 0 WHEN 'M' THEN 1 ELSE 2 END AS CODE_GENDER,
    CASE FLAG_OWN_CAR WHEN 'N' THEN 0 ELSE 1 END AS FLAG_OWN_CAR,
    coalesce(ORGANIZATION_TYPE, 'Unknown') AS ORGANIZATION_TYPE), """
        + ", ".join(
            f"CASE WHEN NAME_INCOME_TYPE = '{s}' THEN 1 ELSE 0 END AS NAME_INCOME_TYPE_{s}" for s in SEGMENTS
        )
        + " FROM app_engineered",
    ),
    "bb": (
        ("fx_bureau_balance",),
        """
SELECT *, CASE WHEN STATUS = 'C' THEN -1 WHEN STATUS = 'X' THEN NULL ELSE CAST(STATUS AS INT) END AS num,
  CASE WHEN STATUS IN ('1', '2', '3', '4', '5') THEN 1 ELSE 0 END AS dpd FROM fx_bureau_balance""",
    ),
    "bb_loan": (
        ("bb",),
        f"""
SELECT a.*, r.bb_recent_dpd_count, r.bb_recent_worst, {ratio('bb_dpd_count', 'bb_months_count')} AS bb_dpd_rate FROM
 (SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS bb_months_count, min(MONTHS_BALANCE) AS bb_months_min,
    sum(dpd) AS bb_dpd_count, sum({flag("STATUS = 'C'")}) AS bb_status_C_count,
    max(num) AS bb_status_num_max, avg(num) AS bb_status_num_mean FROM bb GROUP BY SK_ID_BUREAU) a
 LEFT JOIN (SELECT SK_ID_BUREAU, sum(dpd) AS bb_recent_dpd_count, max(num) AS bb_recent_worst
    FROM bb WHERE MONTHS_BALANCE >= -12 GROUP BY SK_ID_BUREAU) r USING (SK_ID_BUREAU)""",
    ),
    "buro_rows": (("fx_bureau", "bb_loan"), "SELECT * FROM fx_bureau LEFT JOIN bb_loan USING (SK_ID_BUREAU)"),
    "buro_client": (
        ("buro_rows",),
        f"""
SELECT t.*, a.* EXCLUDE (SK_ID_CURR), {ratio('buro_active_count', 'buro_loan_count')} AS buro_active_ratio,
  {flag('buro_overdue_sum > 0')} AS buro_overdue_ratio,
  {ratio('buro_debt_sum', 'buro_credit_sum_mean')} AS buro_debt_ratio,
  buro_recent_worst - buro_worst_status AS buro_recent_vs_overall
FROM (SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS buro_loan_count,
    sum({flag("CREDIT_ACTIVE = 'Active'")}) AS buro_active_count,
    sum({flag("CREDIT_ACTIVE = 'Closed'")}) AS buro_closed_count,
    coalesce(sum(CNT_CREDIT_PROLONG), 0) AS buro_prolonged_sum,
    avg(AMT_CREDIT_SUM) AS buro_credit_sum_mean, max(AMT_CREDIT_SUM) AS buro_credit_sum_max,
    coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS buro_debt_sum,
    coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS buro_overdue_sum, max(AMT_CREDIT_SUM_OVERDUE) AS buro_overdue_max,
    max(CREDIT_DAY_OVERDUE) AS buro_dpd_max, max({flag('CREDIT_DAY_OVERDUE > 0')}) AS buro_ever_overdue,
    max(DAYS_CREDIT) AS buro_days_credit_max, avg(DAYS_CREDIT) AS buro_days_credit_mean,
    max(bb_status_num_max) AS buro_worst_status, coalesce(sum(bb_dpd_count), 0) AS buro_dpd_total,
    avg(bb_dpd_rate) AS buro_dpd_rate_mean, coalesce(sum(bb_months_count), 0) AS buro_months_total,
    coalesce(sum(bb_recent_dpd_count), 0) AS buro_recent_dpd_sum, max(bb_recent_worst) AS buro_recent_worst
  FROM buro_rows WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR) t
LEFT JOIN (SELECT SK_ID_CURR, avg(AMT_CREDIT_SUM) AS buro_active_credit_mean,
    coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS buro_active_debt_sum, max(AMT_CREDIT_SUM_OVERDUE) AS buro_active_overdue_max
  FROM buro_rows WHERE CREDIT_ACTIVE = 'Active' GROUP BY SK_ID_CURR) a USING (SK_ID_CURR)""",
    ),
    "prev_rows": (("fx_previous",), "SELECT * FROM fx_previous WHERE SK_ID_CURR IS NOT NULL"),
    "prev_first_last": (
        ("prev_rows",),
        f"""
SELECT SK_ID_CURR,
  last(NAME_CONTRACT_STATUS ORDER BY DAYS_DECISION, SK_ID_PREV) FILTER (WHERE NAME_CONTRACT_STATUS IS NOT NULL) AS st,
  first(AMT_APPLICATION ORDER BY DAYS_DECISION, SK_ID_PREV) FILTER (WHERE AMT_APPLICATION IS NOT NULL) AS first_ask,
  last(AMT_APPLICATION ORDER BY DAYS_DECISION, SK_ID_PREV) FILTER (WHERE AMT_APPLICATION IS NOT NULL) AS last_ask
FROM prev_rows GROUP BY SK_ID_CURR""",
    ),
    "prev_client": (
        ("prev_rows", "prev_first_last"),
        f"""
SELECT t.*, a.* EXCLUDE (SK_ID_CURR), {ratio('prev_refused_count', 'prev_app_count')} AS prev_refusal_rate,
  -prev_days_decision_max AS prev_days_since_last_app, {flag("fl.st = 'Refused'")} AS prev_last_was_refused,
  {ratio('fl.last_ask', 'fl.first_ask')} AS prev_credit_ask_growth
FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS prev_app_count,
    sum({flag("NAME_CONTRACT_STATUS = 'Approved'")}) AS prev_approved_count,
    sum({flag("NAME_CONTRACT_STATUS = 'Refused'")}) AS prev_refused_count,
    sum({flag("NAME_CONTRACT_STATUS = 'Canceled'")}) AS prev_canceled_count,
    sum({flag("NAME_CONTRACT_STATUS = 'Unused offer'")}) AS prev_unused_count,
    max({flag("CODE_REJECT_REASON = 'HC'")}) AS prev_ever_refused_HC,
    max({flag("CODE_REJECT_REASON = 'SCOFR'")}) AS prev_ever_refused_SCOFR,
    max(DAYS_DECISION) AS prev_days_decision_max, avg(DAYS_DECISION) AS prev_days_decision_mean
  FROM prev_rows GROUP BY SK_ID_CURR) t
LEFT JOIN (SELECT SK_ID_CURR, avg(AMT_CREDIT) AS prev_credit_mean, max(AMT_CREDIT) AS prev_credit_max,
    avg(AMT_ANNUITY) AS prev_annuity_mean, avg(AMT_APPLICATION) AS prev_application_mean,
    avg(CNT_PAYMENT) AS prev_term_mean, avg(NFLAG_INSURED_ON_APPROVAL) AS prev_insured_rate,
    avg({ratio('AMT_CREDIT', 'AMT_APPLICATION')}) AS prev_approval_ratio
  FROM prev_rows WHERE NAME_CONTRACT_STATUS = 'Approved' GROUP BY SK_ID_CURR) a USING (SK_ID_CURR)
LEFT JOIN prev_first_last fl USING (SK_ID_CURR)""",
    ),
    "pos_loan": (
        ("fx_pos",),
        f"""
SELECT a.*, d.* EXCLUDE (SK_ID_PREV), r.* EXCLUDE (SK_ID_PREV),
  1 - {ratio('pos_instalment_future', 'pos_instalment_total')} AS pos_completion_ratio,
  {ratio('pos_late_count', 'pos_months_count')} AS pos_late_rate
FROM (SELECT SK_ID_PREV, count(MONTHS_BALANCE) AS pos_months_count, max(CNT_INSTALMENT) AS pos_instalment_total,
    min(CNT_INSTALMENT_FUTURE) AS pos_instalment_future,
    max({flag("NAME_CONTRACT_STATUS = 'Demand'")}) AS pos_ever_demand,
    max({flag("NAME_CONTRACT_STATUS = 'Completed'")}) AS pos_completed FROM fx_pos GROUP BY SK_ID_PREV) a
LEFT JOIN (SELECT SK_ID_PREV, max(SK_DPD) AS pos_dpd_max, avg(SK_DPD) AS pos_dpd_mean,
    sum({flag('SK_DPD > 0')}) AS pos_late_count, max(SK_DPD_DEF) AS pos_dpd_def_max
  FROM fx_pos WHERE NAME_CONTRACT_STATUS IN {_VALID} GROUP BY SK_ID_PREV) d USING (SK_ID_PREV)
LEFT JOIN (SELECT SK_ID_PREV, max(SK_DPD) AS pos_recent_dpd_max, sum({flag('SK_DPD > 0')}) AS pos_recent_late_count,
    max({flag("NAME_CONTRACT_STATUS = 'Demand'")}) AS pos_recent_demand
  FROM fx_pos WHERE NAME_CONTRACT_STATUS IN {_VALID} AND MONTHS_BALANCE >= -12 GROUP BY SK_ID_PREV) r
  USING (SK_ID_PREV)""",
    ),
    "pos_client": (
        ("prev_rows", "pos_loan"),
        """
SELECT SK_ID_CURR, count(p.SK_ID_PREV) AS pos_loan_count, max(l.pos_dpd_max) AS pos_dpd_max,
  avg(l.pos_dpd_mean) AS pos_dpd_mean, avg(pos_late_rate) AS pos_late_rate_mean,
  max(l.pos_ever_demand) AS pos_ever_demand, coalesce(sum(pos_completed), 0) AS pos_completed_count,
  avg(pos_completion_ratio) AS pos_completion_mean, max(l.pos_recent_dpd_max) AS pos_recent_dpd_max,
  max(l.pos_recent_demand) AS pos_recent_demand
FROM prev_rows p LEFT JOIN pos_loan l ON p.SK_ID_PREV = l.SK_ID_PREV GROUP BY SK_ID_CURR""",
    ),
    "inst_rows": (
        ("fx_installments",),
        f"""
SELECT *, {clip('days_late', '0')} AS days_late_pos, {clip('(-days_late)', '0')} AS days_early_pos,
  {flag('days_late > 0')} AS is_late, {flag('days_late > 30')} AS is_very_late,
  {flag('payment_deficit > 0')} AS is_underpaid, {flag('days_late < 0')} AS is_early,
  {flag('DAYS_ENTRY_PAYMENT IS NULL')} AS is_missing
FROM (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS days_late, {ratio('AMT_PAYMENT', 'AMT_INSTALMENT')} AS payment_ratio,
  AMT_INSTALMENT - AMT_PAYMENT AS payment_deficit FROM fx_installments)""",
    ),
    "inst_latest": (
        ("inst_rows",),
        "SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, "
        + ", ".join(
            _newest(c)
            for c in (
                "DAYS_INSTALMENT days_late days_late_pos days_early_pos payment_ratio payment_deficit is_late "
                "is_very_late is_underpaid is_early is_missing"
            ).split()
        )
        + " FROM inst_rows GROUP BY SK_ID_PREV, NUM_INSTALMENT_NUMBER",
    ),
    "inst_loan": (
        ("inst_latest",),
        f"""
SELECT a.*, r.* EXCLUDE (SK_ID_PREV), {ratio('inst_late_count', 'inst_count')} AS inst_late_rate,
  {ratio('inst_very_late_count', 'inst_count')} AS inst_very_late_rate,
  {ratio('inst_early_count', 'inst_count')} AS inst_early_rate
FROM (SELECT SK_ID_PREV, count(NUM_INSTALMENT_NUMBER) AS inst_count, max(days_late) AS inst_days_late_max,
    avg(days_late) AS inst_days_late_mean, coalesce(sum(days_late_pos), 0) AS inst_days_late_sum,
    sum(is_late) AS inst_late_count, sum(is_very_late) AS inst_very_late_count, sum(is_early) AS inst_early_count,
    avg(days_early_pos) AS inst_days_early_mean, avg(payment_ratio) AS inst_payment_ratio_mean,
    min(payment_ratio) AS inst_payment_ratio_min, coalesce(sum(payment_deficit), 0) AS inst_payment_deficit_sum,
    max(payment_deficit) AS inst_payment_deficit_max, sum(is_underpaid) AS inst_underpaid_count,
    sum(is_missing) AS inst_missing_count FROM inst_latest GROUP BY SK_ID_PREV) a
LEFT JOIN (SELECT SK_ID_PREV, max(days_late) AS inst_recent_days_late_max, sum(is_late) AS inst_recent_late_count,
    avg(payment_ratio) AS inst_recent_payment_ratio, coalesce(sum(payment_deficit), 0) AS inst_recent_deficit_sum
  FROM inst_latest WHERE DAYS_INSTALMENT >= -365 GROUP BY SK_ID_PREV) r USING (SK_ID_PREV)""",
    ),
    "inst_client": (
        ("prev_rows", "inst_loan"),
        """
SELECT SK_ID_CURR, count(p.SK_ID_PREV) AS inst_loan_count, max(l.inst_days_late_max) AS inst_days_late_max,
  avg(l.inst_days_late_mean) AS inst_days_late_mean, avg(inst_late_rate) AS inst_late_rate_mean,
  avg(inst_very_late_rate) AS inst_very_late_rate_mean, avg(l.inst_payment_ratio_mean) AS inst_payment_ratio_mean,
  min(l.inst_payment_ratio_min) AS inst_payment_ratio_min, coalesce(sum(inst_payment_deficit_sum), 0) AS inst_deficit_sum,
  avg(inst_early_rate) AS inst_early_rate_mean, avg(l.inst_days_early_mean) AS inst_days_early_mean,
  coalesce(sum(inst_missing_count), 0) AS inst_missing_sum,
  max(l.inst_recent_days_late_max) AS inst_recent_days_late_max,
  avg(l.inst_recent_payment_ratio) AS inst_recent_payment_ratio,
  coalesce(sum(l.inst_recent_deficit_sum), 0) AS inst_recent_deficit_sum
FROM prev_rows p LEFT JOIN inst_loan l ON p.SK_ID_PREV = l.SK_ID_PREV GROUP BY SK_ID_CURR""",
    ),
    "card_rows": (
        ("fx_credit_card",),
        f"""
SELECT *, {flag('utilization > 0.9E0')} AS is_maxed, {flag('utilization > 1.0E0')} AS is_overlimit
FROM (SELECT *, CASE WHEN u > 1.5E0 THEN 1.5E0 ELSE u END AS utilization FROM
 (SELECT *, {ratio('AMT_BALANCE', 'AMT_CREDIT_LIMIT_ACTUAL')} AS u,
    {flag('AMT_PAYMENT_TOTAL_CURRENT >= AMT_INST_MIN_REGULARITY')} AS paid_min,
    {flag('AMT_PAYMENT_TOTAL_CURRENT >= AMT_BALANCE')} AS paid_full,
    coalesce({ratio('AMT_DRAWINGS_ATM_CURRENT', 'AMT_DRAWINGS_CURRENT')}, 0) AS atm_ratio,
    AMT_BALANCE - lag(AMT_BALANCE) OVER (PARTITION BY SK_ID_PREV ORDER BY MONTHS_BALANCE, TIE_1, TIE_2, TIE_3)
      AS balance_change FROM fx_credit_card))""",
    ),
    "card_loan": (
        ("card_rows",),
        f"""
SELECT a.*, r.* EXCLUDE (SK_ID_PREV), {ratio('cc_maxed_count', 'cc_months_count')} AS cc_maxed_rate,
  {ratio('cc_late_count', 'cc_months_count')} AS cc_late_rate,
  cc_recent_utilization - cc_utilization_mean AS cc_util_trend
FROM (SELECT SK_ID_PREV, count(MONTHS_BALANCE) AS cc_months_count, avg(utilization) AS cc_utilization_mean,
    max(utilization) AS cc_utilization_max, sum(is_maxed) AS cc_maxed_count, sum(is_overlimit) AS cc_overlimit_count,
    avg(paid_min) AS cc_paid_min_rate, avg(paid_full) AS cc_paid_full_rate, avg(atm_ratio) AS cc_atm_ratio_mean,
    sum({flag('AMT_DRAWINGS_ATM_CURRENT > 0')}) AS cc_atm_months, avg(AMT_DRAWINGS_CURRENT) AS cc_drawings_mean,
    avg(AMT_BALANCE) AS cc_balance_mean, max(SK_DPD) AS cc_dpd_max, avg(SK_DPD) AS cc_dpd_mean,
    sum({flag('SK_DPD > 0')}) AS cc_late_count, max({flag("NAME_CONTRACT_STATUS = 'Demand'")}) AS cc_ever_demand,
    avg(balance_change) AS cc_balance_change_mean FROM card_rows GROUP BY SK_ID_PREV) a
LEFT JOIN (SELECT SK_ID_PREV, avg(utilization) AS cc_recent_utilization, max(SK_DPD) AS cc_recent_dpd_max,
    avg(paid_full) AS cc_recent_paid_full, avg(atm_ratio) AS cc_recent_atm_ratio
  FROM card_rows WHERE MONTHS_BALANCE >= -12 GROUP BY SK_ID_PREV) r USING (SK_ID_PREV)""",
    ),
    "card_client": (
        ("prev_rows", "card_loan"),
        f"""
SELECT SK_ID_CURR, count(p.SK_ID_PREV) AS cc_card_count, avg(l.cc_utilization_mean) AS cc_utilization_mean,
  max(l.cc_utilization_max) AS cc_utilization_max, avg(cc_maxed_rate) AS cc_maxed_rate_mean,
  max({flag('l.cc_overlimit_count > 0')}) AS cc_overlimit_ever, avg(cc_paid_full_rate) AS cc_paid_full_rate_mean,
  avg(cc_paid_min_rate) AS cc_paid_min_rate_mean, avg(l.cc_atm_ratio_mean) AS cc_atm_ratio_mean,
  max(l.cc_dpd_max) AS cc_dpd_max, max(l.cc_ever_demand) AS cc_ever_demand, avg(cc_util_trend) AS cc_util_trend_mean,
  avg(l.cc_balance_change_mean) AS cc_balance_change_mean, avg(l.cc_recent_utilization) AS cc_recent_utilization,
  max(l.cc_recent_dpd_max) AS cc_recent_dpd_max
FROM prev_rows p LEFT JOIN card_loan l ON p.SK_ID_PREV = l.SK_ID_PREV GROUP BY SK_ID_CURR""",
    ),
    "spine": (
        ("app_clean", "buro_client", "prev_client", "pos_client", "inst_client", "card_client"),
        """
SELECT * FROM app_clean LEFT JOIN buro_client USING (SK_ID_CURR) LEFT JOIN prev_client USING (SK_ID_CURR)
 LEFT JOIN pos_client USING (SK_ID_CURR) LEFT JOIN inst_client USING (SK_ID_CURR)
 LEFT JOIN card_client USING (SK_ID_CURR)""",
    ),
    "crossed": (
        ("spine",),
        """
SELECT *, EXT_SOURCE_2 * inst_payment_ratio_mean AS ext2_x_inst_ratio,
  CREDIT_INCOME_RATIO * cc_utilization_mean AS credit_income_x_cc_util,
  prev_refusal_rate * buro_active_count AS prev_refusal_x_active,
  pos_completion_mean * cc_paid_full_rate_mean AS pos_cc_behavior,
  inst_recent_payment_ratio - inst_payment_ratio_mean AS inst_payment_deterioration,
  AGE_YEARS * (1 - coalesce(buro_ever_overdue, 0)) AS age_x_buro_clean FROM spine""",
    ),
    "folded": (
        ("fx_scored",),
        """
SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) - 1) % 5 AS INT)
  AS fold FROM fx_scored""",
    ),
    "outside": (
        ("folded",),
        "SELECT k.fold, avg(f.label) AS m FROM (SELECT DISTINCT fold FROM folded) k JOIN folded f ON f.fold <> k.fold GROUP BY k.fold",
    ),
    "factors": (
        (),
        """
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY abs(c) DESC, i) AS rank,
  'f' || CAST(i - 1 AS VARCHAR) AS feature, CAST(c AS DOUBLE) AS c, i
FROM (SELECT vec_id, unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
    ),
}


def _collect(name: str, seen: list[str]) -> None:
    for dependency in CTES[name][0]:
        _collect(dependency, seen)
    if name not in seen:
        seen.append(name)


def sql(main: str, *ctes: str) -> str:
    """A statement with the named common tables, and those they read, in front."""
    order: list[str] = []
    for name in ctes:
        _collect(name, order)
    head = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {head}\n{main}" if head else main


# Values are compared after rounding; the shift, no short decimal itself, keeps exact halves off the rounding edge.
def shift(digits: int) -> str:
    return f"1.7320508E-{digits + 2}"


def rounded(main: str, keep: list[str], *ctes: str, digits: int = 4) -> str:
    """All columns but the kept ones as rounded doubles."""
    kept = ", ".join(keep)
    return sql(
        f"SELECT {kept + ', ' if keep else ''}round(CAST(COLUMNS(*{f' EXCLUDE ({kept})' if keep else ''}) AS DOUBLE) "
        f"+ {shift(digits)}, {digits}) + 0.0E0 FROM ({main})",
        *ctes,
    )
