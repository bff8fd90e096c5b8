"""Files in, files out, and the request stream."""

import csv
import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import fixtures as fx
from catalog.queries import INTERCEPT, MEANS, WEIGHTS
from lendstrata.operators import evaluate, quality
from lendstrata.operators.application import app_features, fix_anomalies
from lendstrata.operators.encode import EncodingPlan, fit_encoding, label_encode
from lendstrata.plans import features, monitoring, scoring, training
from lendstrata.sources import readers, sinks
from lendstrata.sources.schemas import FILES, TABLES
from lendstrata.streaming import score

SF = "/root/testdata/sf0.001"


def write_csv(path, names, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([names, *rows])


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "bureau_balance.csv"
    write_csv(path, ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"], [[5, -1, "C"], [6, -2, ""]])
    df = readers.scan_csv_typed(spark, str(path), "bureau_balance")
    assert [f.dataType for f in df.schema] == [T.IntegerType(), T.ShortType(), T.StringType()]
    assert sorted(map(tuple, df.collect())) == [(5, -1, "C"), (6, -2, None)]


def test_unlisted_columns_are_text_or_inferred_and_nan_is_missing(spark, tmp_path):
    path = tmp_path / "p.csv"
    write_csv(path, ["SK_ID_PREV", "AMT_CREDIT", "SOME_DAYS", "NOTE"], [[1, "NaN", 365243, "x"], [2, 3.5, "", "y"]])
    df = readers.scan_csv_typed(spark, str(path), "previous_app", infer=True)
    assert dict(df.dtypes) == {"SK_ID_PREV": "int", "AMT_CREDIT": "double", "SOME_DAYS": "int", "NOTE": "string"}
    assert sorted(map(tuple, df.collect())) == [(1, None, 365243, "x"), (2, 3.5, None, "y")]
    text = readers.scan_csv_typed(spark, str(path), "previous_app")
    assert sorted(map(tuple, text.collect())) == [(1, None, "365243", "x"), (2, 3.5, None, "y")]


def test_load_tables(spark, tmp_path):
    for name, file in FILES.items():
        write_csv(tmp_path / file, list(TABLES[name]), [["1" if not isinstance(t, T.StringType) else "XNA" for t in TABLES[name].values()]])
    tables = readers.load_tables(spark, str(tmp_path))
    assert tables.keys() == FILES.keys()
    assert "TARGET" not in tables["application_test"].columns
    row = tables["application_train"].first()
    assert row["CODE_GENDER"] is None and row["DAYS_EMPLOYED_ANOMALY"] == 0
    files = readers.convert_tables(spark, str(tmp_path), f"{tmp_path}/typed")
    again = readers.load_tables(spark, f"{tmp_path}/typed", files)
    assert {n: t.dtypes for n, t in again.items()} == {n: t.dtypes for n, t in tables.items()}
    assert again["application_train"].first() == row


def test_feature_set_round_trip(spark, tmp_path):
    config = features.FeatureConfig(installment_ties=fx.INSTALLMENT_TIES, card_ties=fx.CARD_TIES)
    built = features.build_features(fx.tables(spark, SF), config)
    built.write(str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/features")
    assert back.count() == 150 and set(back.columns) == set(built.matrix.columns)
    assert built.dropped == ["MOSTLY_MISSING"]
    report = spark.read.json(f"{tmp_path}/feature_report").first()
    assert report["train_rows"] + report["test_rows"] == 150
    assert report["feature_count"] == len(built.train.columns) - 2
    assert "TARGET" not in built.test.columns


def test_group_switches(spark):
    config = features.FeatureConfig(groups=("bureau", "pos_cash"), card_ties=fx.CARD_TIES)
    matrix, _ = features.build_matrix(fx.tables(spark, SF), config)
    counts = {"buro_loan_count", "prev_app_count", "pos_loan_count", "inst_loan_count", "cc_card_count"}
    assert counts & set(matrix.columns) == {"buro_loan_count", "pos_loan_count"}


def test_one_chain_equals_separate_groups(spark):
    from lendstrata.operators import history

    t = fx.tables(spark, SF)
    loans = {
        "pos_cash": history.pos_loan(t["pos_cash"]),
        "installments": history.install_loan(t["installments"], fx.INSTALLMENT_TIES),
        "credit_card": history.card_loan(t["credit_card"], fx.CARD_TIES),
    }
    fused = history.history_client(t["previous_app"], loans)
    apart = history.card_client(t["credit_card"], t["previous_app"], fx.CARD_TIES)
    assert sorted(map(str, fused.select(apart.columns).collect())) == sorted(map(str, apart.collect()))


def test_csv_sink(spark, tmp_path):
    sinks.sink_csv(spark.createDataFrame([(1, 0.25)], "SK_ID_CURR int, TARGET double"), f"{tmp_path}/out")
    back = spark.read.csv(f"{tmp_path}/out", header=True)
    assert tuple(back.first()) == ("1", "0.25")


def test_materialize_cuts_the_plan(spark):
    out = sinks.materialize(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString() and out.count() == 2


VALID = {
    "NAME_CONTRACT_TYPE": "Cash loans", "AMT_CREDIT": 450000.0, "AMT_INCOME_TOTAL": 180000.0, "CODE_GENDER": "M",
    "FLAG_OWN_CAR": "N", "FLAG_OWN_REALTY": "Y", "DAYS_BIRTH": -12000, "NAME_INCOME_TYPE": "Working",
    "NAME_EDUCATION_TYPE": "Secondary / secondary special", "NAME_FAMILY_STATUS": "Single / not married",
    "NAME_HOUSING_TYPE": "House / apartment", "EXT_SOURCE_2": 0.6,
}


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"AMT_CREDIT": -1000}, ["AMT_CREDIT > 0"]),
        ({"DAYS_BIRTH": 1}, ["DAYS_BIRTH < 0"]),
        ({"EXT_SOURCE_2": 1.5}, ["EXT_SOURCE_2 <= 1"]),
        ({"REGION_RATING_CLIENT": 4, "CNT_CHILDREN": -1}, ["CNT_CHILDREN >= 0", "REGION_RATING_CLIENT <= 3"]),
        ({"CODE_GENDER": None}, ["CODE_GENDER missing"]),
        ({"AMT_ANNUITY": "much"}, ["AMT_ANNUITY type"]),
        ({"DAYS_BIRTH": -12000.5, "AMT_CREDIT": "450000"}, ["DAYS_BIRTH type"]),
        ({"CNT_CHILDREN": [1], "EXT_SOURCE_2": True}, ["CNT_CHILDREN type", "EXT_SOURCE_2 type"]),
    ],
)
def test_request_rules(spark, change, broken):
    fields = quality.request_fields()
    line = spark.createDataFrame([(json.dumps({"SK_ID_CURR": 1, **VALID, **change, "OTHER": 1}),)], "value string")
    row = score.parse_requests(line, fields).first()
    assert row["violations"] == broken and row["valid"] == (not broken)
    assert "OTHER" not in row.asDict()
    if not change:
        assert row["CNT_CHILDREN"] == 0 and row["REGION_RATING_CLIENT"] == 2 and row["FLAG_DOCUMENT_21"] is None


def test_bulk_and_stream_find_the_same_type_errors(spark):
    fields = quality.request_fields()
    rows = [{"SK_ID_CURR": 1, **VALID}, {"SK_ID_CURR": 2, **VALID, "AMT_ANNUITY": "x"}, {"SK_ID_CURR": 3, **VALID, "DAYS_BIRTH": "-5.5"}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    stream = {r["SK_ID_CURR"]: r["violations"] for r in score.parse_requests(lines, fields).collect()}
    schema = ", ".join(f"{c} {'int' if c == 'SK_ID_CURR' else 'string'}" for c in rows[1])
    bulk = spark.createDataFrame([tuple(None if r.get(c) is None else r[c] if c == "SK_ID_CURR" else str(r[c]) for c in rows[1]) for r in rows], schema)
    checked = quality.validate_rules(quality.apply_defaults(bulk, fields, ["SK_ID_CURR"]), fields)
    assert {r["SK_ID_CURR"]: r["violations"] for r in checked.collect()} == stream == {1: [], 2: ["AMT_ANNUITY type"], 3: ["DAYS_BIRTH type"]}


def test_two_streams_keep_apart_and_survive_a_restart(spark, tmp_path):
    fields = quality.request_fields()

    def scorer(valid):
        return valid.withColumns({"default_probability": F.lit(0.1), "risk_tier": F.lit("MEDIUM")})

    def run(name):
        lines = score.read_requests(spark, f"{tmp_path}/{name}-in")
        score.score_stream(lines, fields, scorer, f"{tmp_path}/{name}").awaitTermination(120)
        return sorted((r["SK_ID_CURR"] or 0, r["request"]) for r in spark.read.parquet(f"{tmp_path}/{name}").collect())

    for name, ids in (("a", [1, 2]), ("b", [3])):
        (tmp_path / f"{name}-in").mkdir()
        (tmp_path / f"{name}-in" / "1.json").write_text("\n".join([*(json.dumps({"SK_ID_CURR": i, **VALID}) for i in ids), "no json"]))
    assert run("a") == [(0, "no json"), (1, None), (2, None)]
    assert run("b") == [(0, "no json"), (3, None)]
    (tmp_path / "a-in" / "2.json").write_text(json.dumps({"SK_ID_CURR": 9, **VALID}))
    assert run("a") == [(0, "no json"), (1, None), (2, None), (9, None)]


def test_csv_scan_reads_the_header_only(spark, tmp_path):
    """No job but the header's runs before the table is used; columns that are not listed are text."""
    (tmp_path / "pos.csv").write_text("SK_ID_PREV,MONTHS_BALANCE,OTHER\n1,-3,5\n2,NaN-free,6\n")
    df = readers.scan_csv_typed(spark, f"{tmp_path}/pos.csv", "pos_cash")  # the bad month would end a scan of the rows
    assert dict(df.dtypes) == {"SK_ID_PREV": "int", "MONTHS_BALANCE": "smallint", "OTHER": "string"}


def test_stream_scores_each_request_once(spark, tmp_path):
    fields = quality.request_fields()

    def scorer(df):
        return evaluate.score_probability(app_features(fix_anomalies(df)), evaluate.logistic_score(WEIGHTS, INTERCEPT, MEANS))

    def arrive(name, requests):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(r) for r in requests))

    def run():
        lines = score.read_requests(spark, f"{tmp_path}/in")
        score.score_stream(lines, fields, scorer, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp").awaitTermination(120)

    arrive("a.json", [{"SK_ID_CURR": 1, **VALID}, {"SK_ID_CURR": 2, **VALID, "AMT_CREDIT": 0}])
    run()
    arrive("b.json", [{"SK_ID_CURR": 3, **VALID, "EXT_SOURCE_2": 0.1}])
    run()
    out = {r["SK_ID_CURR"]: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert out.keys() == {1, 2, 3}
    raw = INTERCEPT + WEIGHTS["EXT_SOURCE_MEAN"] * 0.1 + WEIGHTS["CREDIT_INCOME_RATIO"] * (2.5 - 40) + WEIGHTS["AGE_YEARS"] * (
        12000 / 365 - 43
    )
    assert out[1]["default_probability"] == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-6)
    assert out[2]["default_probability"] is None and out[2]["violations"] == ["AMT_CREDIT > 0"]
    assert out[3]["default_probability"] > out[1]["default_probability"]


def test_models(spark, tmp_path):
    """Training finds a planted signal, in-fold scores cover every row, and a saved model scores alike."""
    df = spark.range(600).select(
        F.col("id").alias("SK_ID_CURR"),
        (F.col("id") % 10 < 3).cast("int").alias("TARGET"),
        F.when(F.col("id") % 11 != 0, F.when(F.col("id") % 10 < 3, 1.0).otherwise(0.0) + (F.col("id") % 7) / 10.0).alias("x"),
        F.concat(F.lit("g"), (F.col("id") % 4).cast("string")).alias("ORGANIZATION_TYPE"),
    )
    params = training.TreeParams(trees=3, depth=2, learning_rate=0.3, min_rows=5, feature_share=1.0, row_share=1.0)
    test = df.drop("TARGET")
    cv = training.cv_train(df, test, params, k=2)
    assert cv.oof.count() == 600 and cv.oof.select("SK_ID_CURR").distinct().count() == 600
    assert cv.overall.first()["auc"] > 0.9
    assert cv.folds.count() == 2
    assert {r["feature"] for r in cv.importance.collect()} == {"x", "ORGANIZATION_TYPE"}
    assert cv.test.count() == 600 and cv.test.where("prediction BETWEEN 0 AND 1").count() == 600

    cv.write(f"{tmp_path}/cv")
    metrics = spark.read.json(f"{tmp_path}/cv/cv_metrics").first()
    assert len(metrics["cv_fold_aucs"]) == 2 and metrics["n_features"] == 2
    assert metrics["cv_overall_auc"] == pytest.approx(cv.overall.first()["auc"])
    assert spark.read.csv(f"{tmp_path}/cv/submission", header=True).columns == ["SK_ID_CURR", "TARGET"]

    model = training.fit_final(df, params)
    scored = model.score(test, "SK_ID_CURR")
    model.save(spark, f"{tmp_path}/m")
    again = training.FinalModel.load(spark, f"{tmp_path}/m").score(test, "SK_ID_CURR")
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.collect()))

    found = training.param_search(df, [params, training.TreeParams(trees=1, depth=1, min_rows=5, learning_rate=0.1)], k=2)
    aucs = [r["auc"] for r in found.collect()]
    assert aucs == sorted(aucs, reverse=True) and len(aucs) == 2


def test_requests_are_scored_as_in_training(spark, tmp_path):
    """A trained model with its saved encoders gives applications the score they get as requests."""
    raw = fx.fixture(spark, SF, "fx_requests").withColumn("AMT_CREDIT", F.abs("AMT_CREDIT"))
    fields = quality.request_fields()
    requests = quality.apply_defaults(raw, fields, ["SK_ID_CURR"]).drop(quality.TYPE_ERRORS)
    labelled = requests.withColumn("TARGET", (F.col("SK_ID_CURR") % 4 == 0).cast("int"))
    plan = fit_encoding(app_features(fix_anomalies(labelled)))
    train = plan.transform(app_features(fix_anomalies(labelled)))
    model = training.fit_final(train, training.TreeParams(trees=2, depth=2, min_rows=2))
    plan.save(spark, f"{tmp_path}/plan")
    again = EncodingPlan.load(spark, f"{tmp_path}/plan")
    assert again.actions == plan.actions and again.categories == plan.categories

    out = scoring.score_requests(raw, fields, again, model)
    assert out.count() == raw.count()
    assert out.where("valid AND default_probability IS NULL OR NOT valid AND default_probability IS NOT NULL").count() == 0
    want = {r[0]: r[1] for r in model.score(train, "SK_ID_CURR").collect()}
    got = {r[0]: r[1] for r in out.where("valid").collect()}
    assert got and all(want[k] == v for k, v in got.items())


def test_monitoring(spark, tmp_path):
    df = fx.fixture(spark, SF, "fx_events").select("value", "user_number", "event_type", "level")
    moved = df.withColumn("value", F.col("value") * 3).withColumn("level", F.lit("high"))
    report = monitoring.monitor(df, moved)
    report.write(str(tmp_path))
    found = {r["feature"]: r["drifted"] for r in spark.read.json(f"{tmp_path}/drift_features").collect()}
    assert found == {"value": 1, "user_number": 0, "event_type": 0, "level": 1}
    summary = spark.read.json(f"{tmp_path}/drift_metrics").first()
    assert summary["n_drifted_features"] == 2 and summary["dataset_drift_detected"] == 0


def test_text_features_and_class_weights(spark):
    rows = [(i, int(i % 4 == 0), float(i % 4 == 0) + 0.1 * (i % 3), "x") for i in range(200)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, TARGET int, a double, words string")
    with pytest.raises(ValueError, match="words"):
        training.fit_final(df, training.TreeParams(trees=1), high_cardinality=[])
    params = training.TreeParams(trees=2, depth=2, balanced=True)
    assert params.weighted(df).where("TARGET = 1").first()["weight"] == 3.0
    found = training.fit_final(df.drop("words"), params, high_cardinality=[]).importance(spark).collect()
    assert [r["feature"] for r in found] == ["a"]


def test_missing_label_may_stay_missing(spark):
    df = spark.createDataFrame([("F",), ("M",), (None,)], "c string")
    assert [r[0] for r in df.select(label_encode("c", ["F", "M"])).collect()] == [0, 1, 2]
    assert [r[0] for r in df.select(label_encode("c", ["F", "M"], "null")).collect()] == [0, 1, None]
