"""Domain tables derived from the given tables, as SQL that both engines run.

All rows of the source tables are kept. Some earlier loans get no client id, so that some clients
have no history and missing keys occur.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("customer", "nation", "orders", "lineitem", "events", "documents", "labels", "embeddings", "part")

_SPARK_DAYS = "datediff(CAST({0} AS DATE), DATE'2001-12-31')"
_DUCK_DAYS = "date_diff('day', DATE '2001-12-31', CAST({0} AS DATE))"

_VIEWS = {
    "fx_application": """
SELECT c_custkey AS SK_ID_CURR,
  CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
  CASE WHEN c_acctbal < 500 THEN 1 ELSE 0 END AS TARGET,
  CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
  CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  CASE WHEN c_custkey % 5 = 0 AND c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS NAME_INCOME_TYPE,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS ORGANIZATION_TYPE,
  c_name AS NAME_FREE_TEXT,
  c_acctbal + 1000 AS AMT_INCOME_TOTAL,
  (c_custkey % 97 + 1) * 5000.0E0 AS AMT_CREDIT,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey % 89 + 1) * 250.0E0 END AS AMT_ANNUITY,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE (c_custkey % 83) * 4500.0E0 END AS AMT_GOODS_PRICE,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 6 END AS CNT_FAM_MEMBERS,
  -(7000 + c_custkey * 37 % 18000) AS DAYS_BIRTH,
  CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey * 41 % 9000) END AS DAYS_EMPLOYED,
  -(c_custkey * 29 % 4000) * (CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END) AS DAYS_LAST_PHONE_CHANGE,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE (c_custkey * 31 % 1000) / 1000.0E0 END AS EXT_SOURCE_1,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE (c_custkey * 53 % 1000) / 1000.0E0 END AS EXT_SOURCE_2,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey * 71 % 1000) / 1000.0E0 END AS EXT_SOURCE_3,
  CASE WHEN c_custkey % 10 <> 0 THEN NULL ELSE 1.0E0 END AS MOSTLY_MISSING,
  c_custkey % 5 AS OBS_30_CNT_SOCIAL_CIRCLE, c_custkey % 2 AS DEF_30_CNT_SOCIAL_CIRCLE,
  c_custkey % 4 AS OBS_60_CNT_SOCIAL_CIRCLE, c_custkey % 2 AS DEF_60_CNT_SOCIAL_CIRCLE,
  c_custkey % 2 AS FLAG_DOCUMENT_2, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS FLAG_DOCUMENT_3
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_previous": """
SELECT o_orderkey AS SK_ID_PREV, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS SK_ID_CURR,
  CASE WHEN o_orderkey % 10 = 0 THEN 'Unused offer' WHEN o_orderstatus = 'F' THEN 'Approved'
       WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'HC' WHEN o_orderpriority = '2-HIGH' THEN 'SCOFR' ELSE 'XAP' END
    AS CODE_REJECT_REASON,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE DAYDIFF(o_orderdate) END AS DAYS_DECISION,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 0.0E0 ELSE o_totalprice END AS AMT_APPLICATION,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_totalprice * 0.9E0 END AS AMT_CREDIT,
  o_totalprice / 12.0E0 AS AMT_ANNUITY, o_orderkey % 48 AS CNT_PAYMENT,
  CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS NFLAG_INSURED_ON_APPROVAL,
  CASE WHEN o_orderkey % 4 = 0 THEN 365243 ELSE DAYDIFF(o_orderdate) + 30 END AS DAYS_FIRST_DUE
FROM orders""",
    "fx_bureau": """
SELECT CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey END AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
  DAYDIFF(o_orderdate) AS DAYS_CREDIT,
  CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey % 90 ELSE 0 END AS CREDIT_DAY_OVERDUE,
  o_orderkey % 2 AS CNT_CREDIT_PROLONG, o_totalprice AS AMT_CREDIT_SUM,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice * 0.4E0 END AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderkey % 25 = 0 THEN o_totalprice * 0.01E0 ELSE 0.0E0 END AS AMT_CREDIT_SUM_OVERDUE
FROM orders""",
    "fx_bureau_balance": """
SELECT l_orderkey AS SK_ID_BUREAU, CAST(floor(DAYDIFF(l_shipdate) / 30.0E0) AS INT) AS MONTHS_BALANCE,
  substr('012345CX', CAST(l_partkey % 8 AS INT) + 1, 1) AS STATUS FROM lineitem""",
    "fx_installments": """
SELECT l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER,
  CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey % 4 END AS NUM_INSTALMENT_VERSION,
  DAYDIFF(l_shipdate) AS DAYS_INSTALMENT,
  CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE DAYDIFF(l_shipdate) + l_partkey % 61 - 30 END AS DAYS_ENTRY_PAYMENT,
  l_extendedprice AS AMT_INSTALMENT,
  CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_extendedprice * (1 - l_discount) END AS AMT_PAYMENT,
  l_partkey AS TIE_1, l_extendedprice AS TIE_2, l_shipdate AS TIE_3 FROM lineitem""",
    "fx_pos": """
SELECT l_orderkey AS SK_ID_PREV, CAST(floor(DAYDIFF(l_shipdate) / 30.0E0) AS INT) AS MONTHS_BALANCE,
  l_quantity AS CNT_INSTALMENT, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE floor(l_quantity / 2) END
    AS CNT_INSTALMENT_FUTURE,
  CASE WHEN l_returnflag = 'A' THEN 'Active' WHEN l_returnflag = 'N' THEN 'Completed'
       WHEN l_partkey % 2 = 0 THEN 'Demand' ELSE 'Signed' END AS NAME_CONTRACT_STATUS,
  CASE WHEN l_quantity > 40 THEN l_quantity - 40 ELSE 0 END AS SK_DPD,
  CASE WHEN l_quantity > 45 THEN l_quantity - 45 ELSE 0 END AS SK_DPD_DEF FROM lineitem""",
    "fx_credit_card": """
SELECT l_orderkey AS SK_ID_PREV, CAST(floor(DAYDIFF(l_shipdate) / 30.0E0) AS INT) AS MONTHS_BALANCE,
  CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE l_extendedprice END AS AMT_BALANCE,
  CASE WHEN l_partkey % 47 = 0 THEN 0.0E0 ELSE l_quantity * 1500.0E0 END AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice * l_tax END AS AMT_DRAWINGS_ATM_CURRENT,
  l_extendedprice * l_discount AS AMT_DRAWINGS_CURRENT,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_extendedprice * 0.05E0 END AS AMT_INST_MIN_REGULARITY,
  l_extendedprice * l_discount AS AMT_PAYMENT_TOTAL_CURRENT,
  CASE WHEN l_quantity > 40 THEN l_quantity - 40 ELSE 0 END AS SK_DPD,
  CASE WHEN l_returnflag = 'R' THEN 'Demand' ELSE 'Active' END AS NAME_CONTRACT_STATUS,
  l_partkey AS TIE_1, l_shipdate AS TIE_2, l_extendedprice AS TIE_3 FROM lineitem""",
    "fx_scored": """
SELECT l.doc_id AS id, l.quality AS label, d.lang, d.source,
  CAST(d.n_chars % 97 AS DOUBLE) / 97 AS score_a, CAST(d.n_chars % 53 AS DOUBLE) / 53 AS score_b
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "fx_events": """
SELECT event_id, event_type, user_id, value, CAST(user_id AS DOUBLE) AS user_number,
  CASE WHEN event_type = 'error' THEN NULL ELSE value * 2 END AS clean_value,
  CASE WHEN value < 20 THEN 'low' ELSE 'high' END AS level,
  CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN value END AS gone_number,
  CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN NULL ELSE event_type END AS new_text,
  CAST(NULL AS DOUBLE) AS never_number, CAST(NULL AS VARCHAR(9)) AS never_text,
  CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'reference' ELSE 'current' END AS period
FROM events""",
}

_VIEWS["fx_requests"] = f"""
SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 40 = 0 THEN NULL ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN SK_ID_CURR % 30 = 0 THEN -1000.0E0 ELSE AMT_CREDIT END AS AMT_CREDIT, AMT_INCOME_TOTAL - 500 AS AMT_INCOME_TOTAL,
  AMT_ANNUITY, AMT_GOODS_PRICE, CODE_GENDER, FLAG_OWN_CAR, 'Y' AS FLAG_OWN_REALTY,
  CASE WHEN SK_ID_CURR % 4 = 0 THEN NULL WHEN SK_ID_CURR % 33 = 0 THEN -1 ELSE SK_ID_CURR % 3 END AS CNT_CHILDREN,
  CASE WHEN SK_ID_CURR % 37 = 0 THEN 'many' ELSE CAST(CNT_FAM_MEMBERS AS VARCHAR(9)) END AS CNT_FAM_MEMBERS,
  CASE WHEN SK_ID_CURR % 41 = 0 THEN 5 ELSE DAYS_BIRTH END AS DAYS_BIRTH, DAYS_EMPLOYED, NAME_INCOME_TYPE,
  'Higher education' AS NAME_EDUCATION_TYPE, 'Married' AS NAME_FAMILY_STATUS, 'House / apartment' AS NAME_HOUSING_TYPE,
  EXT_SOURCE_1 * 1.05E0 AS EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3,
  CASE WHEN SK_ID_CURR % 7 = 0 THEN NULL WHEN SK_ID_CURR % 43 = 0 THEN 1.5E0 ELSE SK_ID_CURR % 4 + 1 END AS REGION_RATING_CLIENT,
  FLAG_DOCUMENT_2, ORGANIZATION_TYPE, NAME_FREE_TEXT AS NOT_A_FIELD
FROM ({_VIEWS["fx_application"]})"""

INSTALLMENT_TIES = ["TIE_1", "TIE_2", "TIE_3"]
CARD_TIES = ["TIE_1", "TIE_2", "TIE_3"]


def _render(name: str, days: str) -> str:
    text = _VIEWS[name]
    while "DAYDIFF(" in text:
        start = text.index("DAYDIFF(")
        end = text.index(")", start)
        text = text[:start] + days.format(text[start + 8 : end]) + text[end + 1 :]
    return text.strip()


def duck_sql(name: str) -> str:
    return _render(name, _DUCK_DAYS)


@cache
def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table; the views it reads are registered for this session."""
    text = _render(name, _SPARK_DAYS)
    for table in SOURCES:
        if f" {table} " in text.replace("\n", " ") + " ":
            source(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(text)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight inputs of the feature build."""
    application = fixture(spark, sf_dir, "fx_application")
    return {
        "application_train": application.where("split = 'train'").drop("split"),
        "application_test": application.where("split = 'test'").drop("split", "TARGET"),
        "bureau": fixture(spark, sf_dir, "fx_bureau"),
        "bureau_balance": fixture(spark, sf_dir, "fx_bureau_balance"),
        "previous_app": fixture(spark, sf_dir, "fx_previous"),
        "pos_cash": fixture(spark, sf_dir, "fx_pos"),
        "installments": fixture(spark, sf_dir, "fx_installments"),
        "credit_card": fixture(spark, sf_dir, "fx_credit_card"),
    }
