"""Column types and file names of the input tables."""

from __future__ import annotations

from pyspark.sql import types as T

BYTE, SHORT, INT, DOUBLE, STRING = T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Known columns with their types, in file order as far as they are used by name. Integer widths follow
# the data; amounts are double so that sums keep their cents. Columns that are not listed are read as text.
BUILDING_PARTS = [
    "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "COMMONAREA", "ELEVATORS", "ENTRANCES",
    "FLOORSMAX", "FLOORSMIN", "LANDAREA", "LIVINGAPARTMENTS", "LIVINGAREA", "NONLIVINGAPARTMENTS", "NONLIVINGAREA",
]
_APPLICATION: dict[str, T.DataType] = {
    "SK_ID_CURR": INT,
    "TARGET": BYTE,
    "NAME_CONTRACT_TYPE": STRING,
    "CODE_GENDER": STRING,
    "FLAG_OWN_CAR": STRING,
    "FLAG_OWN_REALTY": STRING,
    "CNT_CHILDREN": SHORT,
    "AMT_INCOME_TOTAL": DOUBLE,
    "AMT_CREDIT": DOUBLE,
    "AMT_ANNUITY": DOUBLE,
    "AMT_GOODS_PRICE": DOUBLE,
    "NAME_TYPE_SUITE": STRING,
    "NAME_INCOME_TYPE": STRING,
    "NAME_EDUCATION_TYPE": STRING,
    "NAME_FAMILY_STATUS": STRING,
    "NAME_HOUSING_TYPE": STRING,
    "REGION_POPULATION_RELATIVE": DOUBLE,
    "DAYS_BIRTH": INT,
    "DAYS_EMPLOYED": INT,
    "DAYS_REGISTRATION": DOUBLE,
    "DAYS_ID_PUBLISH": INT,
    "FLAG_MOBIL": BYTE,
    "FLAG_EMP_PHONE": BYTE,
    "FLAG_WORK_PHONE": BYTE,
    "FLAG_CONT_MOBILE": BYTE,
    "FLAG_PHONE": BYTE,
    "FLAG_EMAIL": BYTE,
    "REGION_RATING_CLIENT": BYTE,
    "REGION_RATING_CLIENT_W_CITY": BYTE,
    "EXT_SOURCE_1": DOUBLE,
    "EXT_SOURCE_2": DOUBLE,
    "EXT_SOURCE_3": DOUBLE,
    "OBS_30_CNT_SOCIAL_CIRCLE": DOUBLE,
    "DEF_30_CNT_SOCIAL_CIRCLE": DOUBLE,
    "OBS_60_CNT_SOCIAL_CIRCLE": DOUBLE,
    "DEF_60_CNT_SOCIAL_CIRCLE": DOUBLE,
    "DAYS_LAST_PHONE_CHANGE": DOUBLE,
    "OWN_CAR_AGE": DOUBLE,
    "OCCUPATION_TYPE": STRING,
    "CNT_FAM_MEMBERS": DOUBLE,
    "WEEKDAY_APPR_PROCESS_START": STRING,
    "HOUR_APPR_PROCESS_START": BYTE,
    "REG_REGION_NOT_LIVE_REGION": BYTE,
    "REG_REGION_NOT_WORK_REGION": BYTE,
    "LIVE_REGION_NOT_WORK_REGION": BYTE,
    "REG_CITY_NOT_LIVE_CITY": BYTE,
    "REG_CITY_NOT_WORK_CITY": BYTE,
    "LIVE_CITY_NOT_WORK_CITY": BYTE,
    "ORGANIZATION_TYPE": STRING,
    "FONDKAPREMONT_MODE": STRING,
    "HOUSETYPE_MODE": STRING,
    "TOTALAREA_MODE": DOUBLE,
    "WALLSMATERIAL_MODE": STRING,
    "EMERGENCYSTATE_MODE": STRING,
    "AMT_REQ_CREDIT_BUREAU_HOUR": DOUBLE,
    "AMT_REQ_CREDIT_BUREAU_DAY": DOUBLE,
    "AMT_REQ_CREDIT_BUREAU_WEEK": DOUBLE,
    "AMT_REQ_CREDIT_BUREAU_MON": DOUBLE,
    "AMT_REQ_CREDIT_BUREAU_QRT": DOUBLE,
    "AMT_REQ_CREDIT_BUREAU_YEAR": DOUBLE,
    **{f"{part}_{kind}": DOUBLE for kind in ("AVG", "MODE", "MEDI") for part in BUILDING_PARTS},
    **{f"FLAG_DOCUMENT_{i}": BYTE for i in range(2, 22)},
}

TABLES: dict[str, dict[str, T.DataType]] = {
    "application_train": _APPLICATION,
    "application_test": {c: t for c, t in _APPLICATION.items() if c != "TARGET"},
    "bureau": {
        "SK_ID_CURR": INT,
        "SK_ID_BUREAU": INT,
        "CREDIT_ACTIVE": STRING,
        "CREDIT_CURRENCY": STRING,
        "DAYS_CREDIT": INT,
        "CREDIT_DAY_OVERDUE": INT,
        "DAYS_CREDIT_ENDDATE": DOUBLE,
        "AMT_CREDIT_MAX_OVERDUE": DOUBLE,
        "CNT_CREDIT_PROLONG": INT,
        "AMT_CREDIT_SUM": DOUBLE,
        "AMT_CREDIT_SUM_DEBT": DOUBLE,
        "AMT_CREDIT_SUM_LIMIT": DOUBLE,
        "AMT_CREDIT_SUM_OVERDUE": DOUBLE,
        "CREDIT_TYPE": STRING,
        "DAYS_CREDIT_UPDATE": INT,
        "AMT_ANNUITY": DOUBLE,
    },
    "bureau_balance": {
        "SK_ID_BUREAU": INT,
        "MONTHS_BALANCE": SHORT,
        "STATUS": STRING,
    },
    "previous_app": {
        "SK_ID_PREV": INT,
        "SK_ID_CURR": INT,
        "NAME_CONTRACT_TYPE": STRING,
        "AMT_ANNUITY": DOUBLE,
        "AMT_APPLICATION": DOUBLE,
        "AMT_CREDIT": DOUBLE,
        "AMT_DOWN_PAYMENT": DOUBLE,
        "AMT_GOODS_PRICE": DOUBLE,
        "NAME_CONTRACT_STATUS": STRING,
        "DAYS_DECISION": INT,
        "NAME_PAYMENT_TYPE": STRING,
        "CODE_REJECT_REASON": STRING,
        "NAME_CLIENT_TYPE": STRING,
        "NAME_GOODS_CATEGORY": STRING,
        "NAME_PORTFOLIO": STRING,
        "NAME_PRODUCT_TYPE": STRING,
        "CHANNEL_TYPE": STRING,
        "NAME_SELLER_INDUSTRY": STRING,
        "CNT_PAYMENT": DOUBLE,
        "NAME_YIELD_GROUP": STRING,
        "NFLAG_INSURED_ON_APPROVAL": DOUBLE,
        "DAYS_FIRST_DRAWING": DOUBLE,
        "DAYS_FIRST_DUE": DOUBLE,
        "DAYS_LAST_DUE_1ST_VERSION": DOUBLE,
        "DAYS_LAST_DUE": DOUBLE,
        "DAYS_TERMINATION": DOUBLE,
        "WEEKDAY_APPR_PROCESS_START": STRING,
        "HOUR_APPR_PROCESS_START": BYTE,
        "FLAG_LAST_APPL_PER_CONTRACT": STRING,
        "NFLAG_LAST_APPL_IN_DAY": BYTE,
        "RATE_DOWN_PAYMENT": DOUBLE,
        "RATE_INTEREST_PRIMARY": DOUBLE,
        "RATE_INTEREST_PRIVILEGED": DOUBLE,
        "NAME_CASH_LOAN_PURPOSE": STRING,
        "NAME_TYPE_SUITE": STRING,
        "SELLERPLACE_AREA": INT,
        "PRODUCT_COMBINATION": STRING,
    },
    "pos_cash": {
        "SK_ID_PREV": INT,
        "SK_ID_CURR": INT,
        "MONTHS_BALANCE": SHORT,
        "CNT_INSTALMENT": DOUBLE,
        "CNT_INSTALMENT_FUTURE": DOUBLE,
        "NAME_CONTRACT_STATUS": STRING,
        "SK_DPD": INT,
        "SK_DPD_DEF": INT,
    },
    "installments": {
        "SK_ID_PREV": INT,
        "SK_ID_CURR": INT,
        "NUM_INSTALMENT_VERSION": DOUBLE,
        "NUM_INSTALMENT_NUMBER": INT,
        "DAYS_INSTALMENT": DOUBLE,
        "DAYS_ENTRY_PAYMENT": DOUBLE,
        "AMT_INSTALMENT": DOUBLE,
        "AMT_PAYMENT": DOUBLE,
    },
    "credit_card": {
        "SK_ID_PREV": INT,
        "SK_ID_CURR": INT,
        "MONTHS_BALANCE": SHORT,
        "AMT_BALANCE": DOUBLE,
        "AMT_CREDIT_LIMIT_ACTUAL": DOUBLE,
        "AMT_DRAWINGS_ATM_CURRENT": DOUBLE,
        "AMT_DRAWINGS_CURRENT": DOUBLE,
        "AMT_DRAWINGS_OTHER_CURRENT": DOUBLE,
        "AMT_DRAWINGS_POS_CURRENT": DOUBLE,
        "AMT_INST_MIN_REGULARITY": DOUBLE,
        "AMT_PAYMENT_CURRENT": DOUBLE,
        "AMT_PAYMENT_TOTAL_CURRENT": DOUBLE,
        "AMT_RECEIVABLE_PRINCIPAL": DOUBLE,
        "AMT_RECIVABLE": DOUBLE,
        "AMT_TOTAL_RECEIVABLE": DOUBLE,
        "SK_DPD": INT,
        "SK_DPD_DEF": INT,
        "CNT_DRAWINGS_ATM_CURRENT": DOUBLE,
        "CNT_DRAWINGS_CURRENT": INT,
        "CNT_DRAWINGS_OTHER_CURRENT": DOUBLE,
        "CNT_DRAWINGS_POS_CURRENT": DOUBLE,
        "CNT_INSTALMENT_MATURE_CUM": DOUBLE,
        "NAME_CONTRACT_STATUS": STRING,
    },
}

# Default file names of the eight inputs.
FILES: dict[str, str] = {
    "application_train": "application_train.csv",
    "application_test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
    "previous_app": "previous_application.csv",
    "pos_cash": "POS_CASH_balance.csv",
    "installments": "installments_payments.csv",
    "credit_card": "credit_card_balance.csv",
}
