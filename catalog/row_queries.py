"""Sources, reports, projections and column cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from catalog.registry import (
    APP_CLEAN,
    APP_RAW,
    INST_COLUMNS,
    app,
    engineered,
    groups,
    missing_sql,
    query,
    rounded,
    test_of,
    train_of,
)
from lendstrata.functions import nulls as n
from lendstrata.operators import application, bureau, columns, encode, history, rows
from lendstrata.plans import features
from lendstrata.sources import readers


# ---- sources and reports --------------------------------------------------

@query("scan_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(s, d):
    return readers.scan_parquet(s, f"{d}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"])


PROFILED = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
).split()


@query(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
        f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INT) AS column_count"
        for t in PROFILED
    ),
)
def _(s, d):
    return columns.table_profile({t: fx.source(s, d, t) for t in PROFILED})


@query(
    "class_balance",
    o.rounded(
        "SELECT TARGET AS label, count(*) AS row_count, count(*) * 1.0E0 / sum(count(*)) OVER () AS share, "
        "(SELECT count(*) FROM fx_application WHERE TARGET = 0) * 1.0E0 / "
        "(SELECT count(*) FROM fx_application WHERE TARGET = 1) AS imbalance FROM fx_application GROUP BY TARGET",
        ["label", "row_count"],
        "fx_application",
        digits=6,
    ),
)
def _(s, d):
    return rounded(columns.class_balance(app(s, d)), ["label", "row_count"], 6)


_APP_FEATURES = [c for c in APP_CLEAN if c not in rows.NOT_FEATURES]


@query(
    "feature_report",
    o.sql(
        f"SELECT t.train_rows, s.test_rows, CAST({len(_APP_FEATURES)} - m.n AS INT) AS feature_count, "
        f"m.dropped AS dropped_high_missing, round(t.target_mean + {o.shift(6)}, 6) AS target_mean FROM "
        "(SELECT count(*) AS train_rows, avg(TARGET) AS target_mean FROM app_clean WHERE split = 'train') t, "
        "(SELECT count(*) AS test_rows FROM app_clean WHERE split = 'test') s, "
        "(SELECT count(*) AS n, coalesce(string_agg(column_name, ',' ORDER BY column_name), '') AS dropped FROM ("
        + missing_sql(_APP_FEATURES, "app_clean", "split = 'train'")
        + ") WHERE missing_share > 0.8) m",
        "app_clean",
    ),
)
def _(s, d):
    raw = app(s, d)
    fitted = encode.fit_encoding(application.app_features(application.fix_anomalies(train_of(raw))))
    train = features.application_clean(train_of(raw), fitted)
    test = features.application_clean(test_of(raw), fitted)
    train, test, dropped = columns.drop_high_missing(train, test)
    report = columns.feature_report(train, test, dropped)
    return report.withColumn("target_mean", F.round(F.col("target_mean") + float(o.shift(6)), 6))


@query(
    "observed_report",
    o.sql(
        f"SELECT t.train_rows, s.test_rows, CAST({len(_APP_FEATURES)} - m.n AS INT) AS feature_count, "
        f"m.dropped AS dropped_high_missing, round(t.target_mean + {o.shift(6)}, 6) AS target_mean, t.zeros, t.ones FROM "
        "(SELECT count(*) AS train_rows, avg(TARGET) AS target_mean, count(*) FILTER (WHERE TARGET = 0) AS zeros, "
        "count(*) FILTER (WHERE TARGET = 1) AS ones FROM app_clean WHERE split = 'train') t, "
        "(SELECT count(*) AS test_rows FROM app_clean WHERE split = 'test') s, "
        "(SELECT count(*) AS n, coalesce(string_agg(column_name, ',' ORDER BY column_name), '') AS dropped FROM ("
        + missing_sql(_APP_FEATURES, "app_clean", "split = 'train'")
        + ") WHERE missing_share > 0.8) m",
        "app_clean",
    ),
)
def _(s, d):
    """The report and the class balance from what was counted while the table was stored."""
    raw = app(s, d)
    fitted = encode.fit_encoding(application.app_features(application.fix_anomalies(train_of(raw))))
    clean = fitted.transform(application.app_features(application.fix_anomalies(raw.drop("split")))).join(raw.select("SK_ID_CURR", "split"), "SK_ID_CURR")
    stored, seen = columns.store_observed(clean, "observed", "split", [c for c in clean.columns if c not in (*rows.NOT_FEATURES, "split")])
    dropped = seen.high_missing()
    report = seen.report(s, len(seen.present) - len(dropped), dropped)
    balance = {r["label"]: r["row_count"] for r in seen.class_balance(s).collect()}
    return report.select(
        "train_rows", "test_rows", "feature_count", "dropped_high_missing",
        F.round(F.col("target_mean") + float(o.shift(6)), 6).alias("target_mean"),
        F.lit(balance[0]).cast("long").alias("zeros"), F.lit(balance[1]).cast("long").alias("ones"),
    )


# ---- projections, cleaning, predicates ------------------------------------

@query(
    "sentinel_to_null",
    o.sql(
        "SELECT 'application' AS source, SK_ID_CURR AS id, nullif(DAYS_EMPLOYED, 365243) AS days, "
        "nullif(CODE_GENDER, 'XNA') AS code FROM fx_application UNION ALL "
        "SELECT 'previous', SK_ID_PREV, nullif(DAYS_FIRST_DUE, 365243), NULL FROM fx_previous",
        "fx_application",
        "fx_previous",
    ),
)
def _(s, d):
    spine = app(s, d).select(
        F.lit("application").alias("source"),
        F.col("SK_ID_CURR").alias("id"),
        n.sentinel_to_null("DAYS_EMPLOYED", 365243).alias("days"),
        n.sentinel_to_null("CODE_GENDER", "XNA").alias("code"),
    )
    loans = history.previous_clean(fx.fixture(s, d, "fx_previous")).select(
        F.lit("previous").alias("source"),
        F.col("SK_ID_PREV").alias("id"),
        F.col("DAYS_FIRST_DUE").cast("bigint").alias("days"),
        F.lit(None).cast("string").alias("code"),
    )
    return spine.unionByName(loans)


@query(
    "sentinel_flag",
    o.sql("SELECT SK_ID_CURR, CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS flag FROM fx_application", "fx_application"),
)
def _(s, d):
    return app(s, d).select("SK_ID_CURR", n.sentinel_flag("DAYS_EMPLOYED", 365243).alias("flag"))


@query("map_codes", o.sql("SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS, num AS status_number FROM bb", "bb"))
def _(s, d):
    return fx.fixture(s, d, "fx_bureau_balance").select(
        "SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS", bureau.status_number().alias("status_number")
    )


@query(
    "safe_ratio",
    o.rounded(
        f"SELECT SK_ID_CURR, {o.ratio('AMT_CREDIT', 'AMT_GOODS_PRICE')} AS credit_goods, "
        f"{o.ratio('AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')} AS per_person FROM fx_application",
        ["SK_ID_CURR"],
        "fx_application",
    ),
)
def _(s, d):
    return rounded(
        app(s, d).select(
            "SK_ID_CURR",
            n.ratio("AMT_CREDIT", "AMT_GOODS_PRICE").alias("credit_goods"),
            n.ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS").alias("per_person"),
        ),
        ["SK_ID_CURR"],
    )


@query(
    "clip_upper",
    o.rounded("SELECT SK_ID_PREV, MONTHS_BALANCE, TIE_1, utilization FROM card_rows", ["SK_ID_PREV", "MONTHS_BALANCE", "TIE_1"], "card_rows"),
)
def _(s, d):
    ids = ["SK_ID_PREV", "MONTHS_BALANCE", "TIE_1"]
    utilization = n.clip_high(n.ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), history.UTILIZATION_CAP)
    return rounded(fx.fixture(s, d, "fx_credit_card").select(*ids, utilization.alias("utilization")), ids)


@query("days_to_years", o.rounded("SELECT SK_ID_CURR, AGE_YEARS, EMPLOYED_YEARS FROM app_engineered", ["SK_ID_CURR"], "app_engineered"))
def _(s, d):
    clean = application.fix_anomalies(app(s, d))
    return rounded(
        clean.select(
            "SK_ID_CURR",
            n.days_to_years("DAYS_BIRTH").alias("AGE_YEARS"),
            n.days_to_years("DAYS_EMPLOYED").alias("EMPLOYED_YEARS"),
        ),
        ["SK_ID_CURR"],
    )


@query(
    "row_stats",
    o.rounded(
        "SELECT SK_ID_CURR, EXT_SOURCE_MEAN, EXT_SOURCE_MIN, EXT_SOURCE_PROD FROM app_engineered", ["SK_ID_CURR"], "app_engineered", digits=6
    ),
)
def _(s, d):
    names = application.EXTERNAL_SCORES
    return rounded(
        app(s, d).select(
            "SK_ID_CURR",
            n.row_mean(*names).alias("EXT_SOURCE_MEAN"),
            n.row_min(*names).alias("EXT_SOURCE_MIN"),
            n.row_product(*names).alias("EXT_SOURCE_PROD"),
        ),
        ["SK_ID_CURR"],
        6,
    )


@query("flag_count", o.sql("SELECT SK_ID_CURR, FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 AS documents FROM fx_application", "fx_application"))
def _(s, d):
    df = app(s, d)
    return df.select("SK_ID_CURR", n.row_sum(*[c for c in df.columns if "FLAG_DOCUMENT" in c]).alias("documents"))


_ENGINEERED = (
    "AGE_YEARS EMPLOYED_YEARS CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO CREDIT_GOODS_RATIO ANNUITY_CREDIT_RATIO "
    "INCOME_PER_PERSON EXT_SOURCE_MEAN EXT_SOURCE_MIN EXT_SOURCE_2_3 EXT_SOURCE_PROD DOCS_PROVIDED DEF_30_RATE DEF_60_RATE"
).split()


@query("app_features", o.rounded(f"SELECT SK_ID_CURR, {', '.join(_ENGINEERED)} FROM app_engineered", ["SK_ID_CURR"], "app_engineered"))
def _(s, d):
    return rounded(engineered(s, d).select("SK_ID_CURR", *_ENGINEERED), ["SK_ID_CURR"])


_INST_IDS = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "TIE_1"]
@query("install_row_features", o.rounded(f"SELECT {', '.join(_INST_IDS + INST_COLUMNS)} FROM inst_rows", _INST_IDS, "inst_rows"))
def _(s, d):
    out = history.install_row_features(fx.fixture(s, d, "fx_installments"))
    return rounded(out.select(*_INST_IDS, *INST_COLUMNS), _INST_IDS)


_CARD_IDS = ["SK_ID_PREV", "MONTHS_BALANCE", "TIE_1"]
_CARD_COLUMNS = "utilization paid_min paid_full atm_ratio balance_change is_maxed is_overlimit".split()


@query("card_row_features", o.rounded(f"SELECT {', '.join(_CARD_IDS + _CARD_COLUMNS)} FROM card_rows", _CARD_IDS, "card_rows"))
def _(s, d):
    out = history.card_row_features(fx.fixture(s, d, "fx_credit_card"), fx.CARD_TIES)
    return rounded(out.select(*_CARD_IDS, *_CARD_COLUMNS), _CARD_IDS)


_POS = "SK_ID_PREV, MONTHS_BALANCE, NAME_CONTRACT_STATUS, SK_DPD"


def _pos_rows(df: DataFrame) -> DataFrame:
    return df.select(*_POS.split(", "))


@query("filter_eq", o.sql(f"SELECT {_POS} FROM fx_pos WHERE NAME_CONTRACT_STATUS = 'Demand'", "fx_pos"))
def _(s, d):
    return _pos_rows(rows.filter_eq(fx.fixture(s, d, "fx_pos"), "NAME_CONTRACT_STATUS", "Demand"))


@query("filter_in", o.sql(f"SELECT {_POS} FROM fx_pos WHERE NAME_CONTRACT_STATUS IN ('Active', 'Completed', 'Demand')", "fx_pos"))
def _(s, d):
    return _pos_rows(rows.filter_in(fx.fixture(s, d, "fx_pos"), "NAME_CONTRACT_STATUS", history.DUE_STATUSES))


@query("filter_recent", o.sql(f"SELECT {_POS} FROM fx_pos WHERE MONTHS_BALANCE >= -12", "fx_pos"))
def _(s, d):
    return _pos_rows(rows.filter_recent(fx.fixture(s, d, "fx_pos"), "MONTHS_BALANCE", history.RECENT_MONTHS))


@query(
    "drop_high_missing",
    o.sql(
        f"SELECT p.column_name, round(p.missing_share + {o.shift(6)}, 6) AS missing_share, "
        "CASE WHEN p.missing_share > 0.8 THEN 1 ELSE 0 END AS dropped FROM ("
        + missing_sql(APP_RAW, "app_fixed", "split = 'train'")
        + ") p",
        "app_fixed",
    ),
)
def _(s, d):
    raw = application.fix_anomalies(app(s, d))
    kept, _, dropped = columns.drop_high_missing(train_of(raw), test_of(raw))
    assert not set(dropped) & set(kept.columns)
    profile = columns.missing_profile(train_of(raw), APP_RAW)
    return profile.select(
        "column_name",
        F.round(F.col("missing_share") + float(o.shift(6)), 6).alias("missing_share"),
        F.col("column_name").isin(dropped).cast("int").alias("dropped"),
    )


_ALIGNED = [c for c in APP_CLEAN if c != "TARGET"]


@query(
    "align_schema",
    o.rounded(
        f"SELECT {', '.join(_ALIGNED)} FROM app_clean WHERE split = 'test'",
        ["SK_ID_CURR", "ORGANIZATION_TYPE"],
        "app_clean",
    ),
)
def _(s, d):
    raw = app(s, d)
    train = features.application_clean(train_of(raw))
    # encoded apart, the test table lacks the segment that only train has
    test = features.application_clean(test_of(raw))
    return rounded(columns.align_schema(train, test).select(*_ALIGNED), ["SK_ID_CURR", "ORGANIZATION_TYPE"])


_CROSSED = (
    "ext2_x_inst_ratio credit_income_x_cc_util prev_refusal_x_active pos_cc_behavior inst_payment_deterioration age_x_buro_clean"
).split()


@query("cross_features", o.rounded(f"SELECT SK_ID_CURR, {', '.join(_CROSSED)} FROM crossed", ["SK_ID_CURR"], "crossed"))
def _(s, d):
    out = application.cross_features(features.join_spine(engineered(s, d), *groups(s, d)))
    return rounded(out.select("SK_ID_CURR", *_CROSSED), ["SK_ID_CURR"])


_IMPUTED = ["AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "CNT_FAM_MEMBERS"]


@query(
    "impute",
    o.rounded(
        "SELECT SK_ID_CURR, "
        + ", ".join(f"coalesce({c}, quantile_cont({c}, 0.5) OVER ()) AS {c}" for c in _IMPUTED)
        + " FROM fx_application",
        ["SK_ID_CURR"],
        "fx_application",
    ),
)
def _(s, d):
    df = app(s, d)
    filled = columns.impute(df, columns.impute_values(df, _IMPUTED, "median"))
    return rounded(filled.select("SK_ID_CURR", *_IMPUTED), ["SK_ID_CURR"])


@query(
    "fill_category",
    o.sql("SELECT SK_ID_CURR, coalesce(ORGANIZATION_TYPE, 'Unknown') AS ORGANIZATION_TYPE, coalesce(NAME_INCOME_TYPE, 'Unknown') AS NAME_INCOME_TYPE FROM fx_application", "fx_application"),
)
def _(s, d):
    names = ["ORGANIZATION_TYPE", "NAME_INCOME_TYPE"]
    return columns.fill_category(app(s, d), names).select("SK_ID_CURR", *names)


_CAPPED = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY"]


@query(
    "winsorize",
    o.rounded(
        "SELECT SK_ID_CURR, "
        + ", ".join(
            f"CASE WHEN {c} > quantile_cont({c}, 0.99) OVER () THEN quantile_cont({c}, 0.99) OVER () ELSE {c} END AS {c}"
            for c in _CAPPED
        )
        + " FROM fx_application",
        ["SK_ID_CURR"],
        "fx_application",
    ),
)
def _(s, d):
    df = app(s, d)
    capped = columns.winsorize(df, columns.winsor_limits(df, _CAPPED))
    return rounded(capped.select("SK_ID_CURR", *_CAPPED), ["SK_ID_CURR"])
