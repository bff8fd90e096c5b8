"""Missing-value rules on tiny tables, each by hand."""

import pytest
from pyspark.sql import functions as F

from lendstrata.functions import nulls as n
from lendstrata.functions.text import add_prefix, clean_column_names, decimal_text
from lendstrata.operators import application, bureau, columns, history, rows
from lendstrata.operators.encode import EncodingPlan, drop_high_card, fit_encoding


def values(df, c):
    return [r[c] for r in df.orderBy("i").collect()]


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(1, 4.0, 0.0), (2, 6.0, 3.0), (3, None, 2.0), (4, 5.0, None)]
    return spark.createDataFrame(rows, "i int, a double, b double")


def test_clip_and_ratio_keep_missing(numbers):
    out = numbers.select("i", n.clip_low("b", 1).alias("c"), n.clip_high("a", 5).alias("h"), n.ratio("a", "b").alias("r"))
    assert values(out, "c") == [1.0, 3.0, 2.0, None]
    assert values(out, "h") == [4.0, 5.0, None, 5.0]
    assert values(out, "r") == [4.0, 2.0, None, None]


def test_flags_count_missing_as_no(numbers):
    assert values(numbers.select("i", n.flag(F.col("b") > 1).alias("f")), "f") == [0, 1, 1, 0]


def test_row_statistics_skip_missing(spark):
    df = spark.createDataFrame([(1, 1.0, None, 3.0), (2, None, None, None)], "i int, x double, y double, z double")
    cols = ["x", "y", "z"]
    out = df.select(
        "i", n.row_mean(*cols).alias("m"), n.row_min(*cols).alias("l"), n.row_sum(*cols).alias("s"), n.row_product(*cols).alias("p")
    )
    assert [tuple(r) for r in out.orderBy("i").collect()] == [(1, 2.0, 1.0, 4.0, None), (2, None, None, 0.0, None)]


def test_sum_of_nothing_is_zero_but_not_of_an_empty_subset(spark):
    df = spark.createDataFrame(
        [("a", "x", None), ("a", "y", 2.0), ("b", "y", 3.0), ("c", "x", 1.0)], "k string, s string, v double"
    )
    sub = F.col("s") == "x"
    out = df.groupBy("k").agg(n.sum0(n.only(sub, "v")).alias("plain"), n.subset_sum(sub, "v").alias("sub"))
    assert {r["k"]: (r["plain"], r["sub"]) for r in out.collect()} == {"a": (0.0, 0.0), "b": (0.0, None), "c": (1.0, 1.0)}


def test_first_and_last_skip_missing_values(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 7.0), (1, 3, 8.0), (1, 4, None)], "k int, o int, v double")
    out = df.groupBy("k").agg(n.first_present("v", F.col("o")).alias("f"), n.last_present("v", F.col("o")).alias("l"))
    assert tuple(out.first()) == (1, 7.0, 8.0)


def test_sentinels(spark):
    df = spark.createDataFrame(
        [(1, -1000, -100.0, "M"), (2, 365243, 0.0, "XNA"), (3, None, -5.0, "F")],
        "i int, DAYS_EMPLOYED int, DAYS_LAST_PHONE_CHANGE double, CODE_GENDER string",
    )
    out = application.fix_anomalies(df)
    assert values(out, "DAYS_EMPLOYED") == [-1000, None, None]
    assert values(out, "DAYS_EMPLOYED_ANOMALY") == [0, 1, 1]
    assert values(out, "DAYS_LAST_PHONE_CHANGE") == [-100.0, None, -5.0]
    assert values(out, "CODE_GENDER") == ["M", None, "F"]
    again = application.fix_anomalies(out)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_status_numbers(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["0", "5", "C", "X", None, "?"])], "i int, STATUS string")
    assert values(df.select("i", bureau.status_number().alias("n")), "n") == [0, 5, -1, None, None, None]


def test_application_ratios(spark):
    row = dict(
        DAYS_BIRTH=-12000, DAYS_EMPLOYED=-2000, AMT_CREDIT=200000.0, AMT_INCOME_TOTAL=100000.0, AMT_ANNUITY=10000.0,
        AMT_GOODS_PRICE=200000.0, CNT_FAM_MEMBERS=2.0, EXT_SOURCE_1=0.5, EXT_SOURCE_2=0.6, EXT_SOURCE_3=0.4,
        OBS_30_CNT_SOCIAL_CIRCLE=5.0, DEF_30_CNT_SOCIAL_CIRCLE=1.0, OBS_60_CNT_SOCIAL_CIRCLE=5.0,
        DEF_60_CNT_SOCIAL_CIRCLE=1.0, FLAG_DOCUMENT_2=1, FLAG_DOCUMENT_3=1,
    )
    out = application.app_features(spark.createDataFrame([row])).first()
    assert out["CREDIT_INCOME_RATIO"] == 2.0
    assert out["EXT_SOURCE_MEAN"] == pytest.approx(0.5)
    assert out["DOCS_PROVIDED"] == 2
    assert out["AGE_YEARS"] == pytest.approx(12000 / 365)
    assert out["ANNUITY_INCOME_RATIO"] == pytest.approx(1.2)


def test_one_row_per_client(spark):
    credits = spark.createDataFrame(
        [
            (100, 1, "Active", -100, 0, 1000.0, 500.0, 0.0, 0),
            (100, 2, "Closed", -200, 0, 2000.0, 0.0, 0.0, 0),
            (200, 3, "Active", -300, 0, 3000.0, 1500.0, 0.0, 0),
            (None, 4, "Active", -300, 0, 3000.0, 1500.0, 0.0, 0),
        ],
        "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, DAYS_CREDIT int, CREDIT_DAY_OVERDUE int, "
        "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, CNT_CREDIT_PROLONG int",
    )
    months = spark.createDataFrame(
        [(1, -1, "0"), (2, -1, "C"), (3, -20, "2")], "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string"
    )
    out = {r["SK_ID_CURR"]: r for r in bureau.bureau_client(credits, months).collect()}
    assert out.keys() == {100, 200}
    assert len(out[100]) == 27
    assert (out[100]["buro_loan_count"], out[100]["buro_active_count"], out[100]["buro_active_debt_sum"]) == (2, 1, 500.0)
    assert out[200]["buro_recent_worst"] is None and out[200]["buro_recent_vs_overall"] is None
    assert out[200]["buro_recent_dpd_sum"] == 0 and out[200]["buro_dpd_total"] == 1


def test_cross_features_without_sources(spark):
    out = application.cross_features(spark.createDataFrame([(1, 30.0)], "SK_ID_CURR int, AGE_YEARS double")).first()
    assert out["age_x_buro_clean"] == 30.0 and out["ext2_x_inst_ratio"] is None


def test_newest_version_is_a_hybrid_row(spark):
    rows = [
        # version, entry day, paid: the newest version has no payment
        (1, 1, 1.0, -50.0, -40.0, 100.0, 90.0),
        (1, 1, 2.0, -50.0, None, 100.0, None),
        (1, 2, 3.0, -20.0, -25.0, 100.0, 100.0),
        (1, 2, None, -20.0, -10.0, 100.0, 100.0),
    ]
    df = spark.createDataFrame(
        rows,
        "SK_ID_PREV int, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT double, "
        "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    )
    out = {r["NUM_INSTALMENT_NUMBER"]: r for r in history.latest_version(history.install_row_features(df)).collect()}
    assert (out[1]["days_late"], out[1]["is_late"], out[1]["is_missing"], out[1]["payment_deficit"]) == (10.0, 0, 1, 10.0)
    # a missing version counts as the newest
    assert (out[2]["days_late"], out[2]["is_late"]) == (10.0, 1)


def test_decision_order_breaks_ties_by_loan_and_puts_missing_days_last(spark):
    schema = (
        "SK_ID_CURR int, SK_ID_PREV bigint, NAME_CONTRACT_STATUS string, DAYS_DECISION int, AMT_APPLICATION double, "
        "CODE_REJECT_REASON string, AMT_CREDIT double, AMT_ANNUITY double, CNT_PAYMENT double, NFLAG_INSURED_ON_APPROVAL int"
    )
    tail = ("XAP", 1.0, 1.0, 1.0, 0)
    rows = [
        (1, 5, "Refused", -10, 30.0, *tail),
        (1, 9223372036854775807, "Approved", -10, 60.0, *tail),
        (1, 7, "Approved", -30, 10.0, *tail),
        (2, 1, "Approved", -1, 5.0, *tail),
        (2, 2, "Refused", None, None, *tail),
    ]
    out = {r["SK_ID_CURR"]: r for r in history.previous_client(spark.createDataFrame(rows, schema)).collect()}
    assert (out[1]["prev_last_was_refused"], out[1]["prev_credit_ask_growth"]) == (0, 6.0)
    assert (out[2]["prev_last_was_refused"], out[2]["prev_credit_ask_growth"]) == (1, 1.0)


def test_card_balance_change_around_missing(spark):
    df = spark.createDataFrame(
        [(1, -4, 10.0), (1, -3, None), (1, -2, 30.0), (1, -1, 45.0)], "SK_ID_PREV int, MONTHS_BALANCE int, AMT_BALANCE double"
    ).withColumns(
        {
            c: F.lit(v)
            for c, v in {
                "AMT_CREDIT_LIMIT_ACTUAL": 0.0, "AMT_DRAWINGS_ATM_CURRENT": 1.0, "AMT_DRAWINGS_CURRENT": 0.0,
                "AMT_INST_MIN_REGULARITY": 1.0, "AMT_PAYMENT_TOTAL_CURRENT": 40.0,
            }.items()
        }
    )
    out = history.card_row_features(df).orderBy("MONTHS_BALANCE").collect()
    assert [r["balance_change"] for r in out] == [None, None, None, 15.0]
    assert [r["utilization"] for r in out] == [1.5, None, 1.5, 1.5]
    assert [r["paid_full"] for r in out] == [1, 0, 1, 0]
    assert [r["is_overlimit"] for r in out] == [1, 0, 1, 1]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a/b", "c (d)"])
    assert clean_column_names(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        clean_column_names(spark.createDataFrame([(1, 2)], ["a/b", "a b"]))
    df = spark.createDataFrame([(1, 2, 3)], ["id", "pos_x", "y"])
    assert add_prefix(df, "pos_", ["id"]).columns == ["id", "pos_x", "pos_y"]


def test_number_texts(spark):
    df = spark.createDataFrame([(1, 0.3), (2, 12.0), (3, 0.0001), (4, -0.125), (5, 100.0), (6, 0.0)], "i int, x double")
    assert values(df.select("i", decimal_text(F.col("x"), 4).alias("t")), "t") == ["0.3", "12.0", "0.0001", "-0.125", "100.0", "0.0"]


def test_encoding_policy_and_missing_class(spark):
    train = spark.createDataFrame(
        [("F", "a", "Bank", "t1"), ("M", "b", None, "t2"), (None, "c", "Army", "t3"), ("F", None, "Trade", "t4")],
        "CODE_GENDER string, KIND string, ORGANIZATION_TYPE string, NOTE string",
    )
    plan = fit_encoding(train, one_hot_up_to=3)
    assert plan.actions == {"CODE_GENDER": "label", "KIND": "one_hot", "ORGANIZATION_TYPE": "keep", "NOTE": "drop"}
    out = plan.transform(spark.createDataFrame([("M", "z", None), (None, "b", "Navy")], "CODE_GENDER string, KIND string, ORGANIZATION_TYPE string"))
    rows = sorted(map(tuple, out.select("CODE_GENDER", "ORGANIZATION_TYPE", "KIND_a", "KIND_b", "KIND_c").collect()))
    assert rows == [(1, "Unknown", 0, 0, 0), (2, "Navy", 0, 1, 0)]


def test_align_fills_absent_columns_only(spark):
    train = spark.createDataFrame([(1, 0, 5.0, 1)], "SK_ID_CURR int, TARGET int, x double, d int")
    test = spark.createDataFrame([(2, None, 9)], "SK_ID_CURR int, x double, extra int")
    out = columns.align_schema(train, test)
    assert out.columns == ["SK_ID_CURR", "x", "d"] and tuple(out.first()) == (2, None, 0)


def test_drop_threshold_is_strict(spark):
    df = spark.range(10).select(
        F.col("id").alias("SK_ID_CURR"), F.lit(0).alias("TARGET"),
        F.when(F.col("id") < 2, 1.0).alias("at"), F.when(F.col("id") < 1, 1.0).alias("above"),
    )
    train, test, dropped = columns.drop_high_missing(df, df.drop("TARGET"))
    assert dropped == ["above"] and "at" in train.columns and "above" not in test.columns


def test_imputation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    assert columns.impute_values(df, ["x"], "median") == {"x": 2.0}
    assert columns.impute_values(df, ["x"], "mean")["x"] == pytest.approx(13 / 3)
    assert columns.impute_values(df, ["x"], "zero") == {"x": 0.0}
    assert sorted(r[0] for r in columns.impute(df, {"x": 2.0}).collect()) == [1.0, 2.0, 2.0, 10.0]


def test_day_columns(spark):
    df = spark.createDataFrame([(-730, -365.0, None)], "DAYS_BIRTH int, DAYS_REGISTRATION double, DAYS_EMPLOYED int")
    out = application.day_columns_to_years(df).first()
    assert (out["BIRTH_YEARS"], out["REGISTRATION_YEARS"], out["EMPLOYED_YEARS"]) == (2.0, 1.0, None)


def test_late_threshold(spark):
    df = spark.createDataFrame(
        [(1, -50.0, -45.0, 1.0, 1.0), (2, -50.0, -10.0, 1.0, 0.5)],
        "i int, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    )
    assert values(history.install_row_features(df), "is_late") == [1, 1]
    assert values(history.install_row_features(df, late_above=10), "is_late") == [0, 1]
    assert values(history.install_row_features(df), "is_very_late") == [0, 1]


def test_bureau_without_monthly_balances(spark):
    credits = spark.createDataFrame(
        [(1, 1, "Closed", -100, 3, 1000.0, None, None, 1)],
        "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, DAYS_CREDIT int, CREDIT_DAY_OVERDUE int, "
        "AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, CNT_CREDIT_PROLONG int",
    )
    out = bureau.bureau_client(credits, None).first()
    assert "buro_worst_status" not in out.asDict()
    assert (out["buro_debt_sum"], out["buro_active_debt_sum"], out["buro_ever_overdue"]) == (0.0, None, 1)


def test_feature_selection_and_dropping(spark):
    df = spark.createDataFrame([(1, 0, 2.0, "x")], "SK_ID_CURR int, TARGET int, a double, NOTE string")
    assert rows.select_features(df).columns == ["a", "NOTE"]
    plan = EncodingPlan({"NOTE": "drop"}, {"NOTE": 99})
    assert drop_high_card(df, plan).columns == ["SK_ID_CURR", "TARGET", "a"]


def test_rows_keep_their_number(spark):
    """Shares lie in [0, 1] and flags are 0 or 1 in the whole feature matrix."""
    from catalog.queries import build_features

    out = build_features(spark, "/root/testdata/sf0.001")
    shares = [c for c in out.columns if c.endswith(("_rate", "_rate_mean", "_ratio_mean")) and c.startswith(("prev", "pos", "cc")) and "atm" not in c]
    flags = [c for c in out.columns if "_ever_" in c or c.startswith("NAME_INCOME_TYPE_")]
    assert shares and flags
    bad = " OR ".join([f"{c} < 0 OR {c} > 1.5" for c in shares] + [f"{c} NOT IN (0, 1)" for c in flags])
    assert out.where(bad).count() == 0
