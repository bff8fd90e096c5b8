"""Bounded label sets, figures that are counted during a write, rejected lines, and histories that are stored by key."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog.registry import CONFIG
from lendstrata.operators import columns, encode, ordered
from lendstrata.plans import features
from lendstrata.sources import buckets, readers, sinks

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- labels ---------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 12, 30, 700, 5_000])
def test_label_sets_end_at_their_bound(spark, n):
    df = spark.range(20_000).repartition(6).select(F.when(F.lit(n) > 0, F.concat(F.lit("v"), F.col("id") % max(1, n))).alias("a b"), F.lit(None).cast("string").alias("c"))
    got = columns.label_sets(df, ["a b", "c"], 10)
    assert got["a b"] == (sorted(f"v{i}" for i in range(n)) if n <= 10 else None)
    assert got["c"] == [] and columns.label_sets(df, [], 10) == {}


def test_rare_labels_beside_frequent_ones(spark):
    """A column whose many rare labels follow a few frequent ones has too many."""
    df = spark.range(30_000).select(F.when(F.col("id") % 5 < 4, F.concat(F.lit("f"), F.col("id") % 5)).otherwise(F.concat(F.lit("r"), F.col("id"))).alias("a"))
    assert columns.label_sets(df, ["a"], 10)["a"] is None
    few = df.withColumn("a", F.when(F.col("id") == 7, "once") if "id" in df.columns else F.when(F.col("a").startswith("r"), "r").otherwise(F.col("a")))
    assert columns.label_sets(few, ["a"], 10)["a"] == ["f0", "f1", "f2", "f3", "r"]


def test_policy_needs_one_pass_without_a_shuffle_of_labels(spark):
    df = fx.fixture(spark, SF, "fx_application")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    fitted = encode.fit_encoding(df)
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert fitted.actions["NAME_FREE_TEXT"] == "drop" and fitted.n_unique["NAME_FREE_TEXT"] == 11
    assert fitted.actions["NAME_INCOME_TYPE"] == "one_hot" and len(fitted.categories["NAME_INCOME_TYPE"]) == fitted.n_unique["NAME_INCOME_TYPE"]
    assert len(jobs) <= 3  # the join under the table, and the one aggregation


# ---- observed figures -----------------------------------------------------


def test_figures_are_counted_during_the_write(spark):
    rows = [(i, "train" if i % 4 else "test", i % 3 == 0 and 1 or 0, None if i % 5 else 1.0, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, split string, TARGET int, a double, b double").repartition(3)
    stored, seen = columns.store_observed(df, "seen", "split", ["a", "b"])
    train = stored.where("split = 'train'").drop("split")
    test = stored.where("split = 'test'").drop("split", "TARGET")
    assert tuple(seen.report(spark, 2, ["x"]).first()) == tuple(columns.feature_report(train, test, ["x"]).first())
    assert sorted(seen.class_balance(spark).collect()) == sorted(columns.class_balance(train).collect())
    assert seen.present == {"a": train.where("a IS NOT NULL").count(), "b": 75}
    assert seen.high_missing(0.7) == columns.high_missing(train, 0.7) == ["a"] and seen.high_missing(0.9) == []


def test_report_of_a_build_reads_nothing_again(spark):
    built = features.build_features(fx.tables(spark, SF), CONFIG)
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    report, balance = built.report(), built.class_balance()
    assert "Scan parquet" not in plan(report) + plan(balance)
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert tuple(report.first()) == tuple(columns.feature_report(built.train, built.test, built.dropped).first())
    assert sorted(balance.collect()) == sorted(columns.class_balance(built.train).collect())


# ---- rejects --------------------------------------------------------------


@pytest.fixture()
def bad_file(tmp_path):
    path = tmp_path / "pos.csv"
    path.write_text(
        "SK_ID_PREV,MONTHS_BALANCE,CNT_INSTALMENT,NAME_CONTRACT_STATUS\n"
        "1,-1,12,Active\n"
        "two,-1,12,Active\n"
        "3,-1\n"
        "4,-1,12,Active,more\n"
        "5,,NaN,\n"
        '6,-2,3,"a, b"\n'
    )
    return str(path)


def test_rejected_lines_are_kept_apart(spark, bad_file):
    parsed = readers.scan_csv_lenient(spark, bad_file, "pos_cash")
    assert [tuple(r) for r in parsed.rows.orderBy("SK_ID_PREV").collect()] == [(1, -1, 12.0, "Active"), (5, None, None, None), (6, -2, 3.0, "a, b")]
    rejects = parsed.rejects.orderBy("line").collect()
    assert [r["line"] for r in rejects] == ["3,-1", "4,-1,12,Active,more", "two,-1,12,Active"]
    assert {(r["table_name"], r["file"].endswith("pos.csv")) for r in rejects} == {("pos_cash", True)} and parsed.rejected == 3
    assert readers.scan_csv_lenient(spark, bad_file, "pos_cash", allowed=3).rejected == 3
    with pytest.raises(readers.TooManyRejects, match="3 lines of pos_cash .* 3,-1"):
        readers.scan_csv_lenient(spark, bad_file, "pos_cash", allowed=2)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.scan_csv_typed(spark, bad_file, "pos_cash").collect()


def test_tables_load_with_allowed_rejects(spark, tmp_path):
    for name, df in fx.tables(spark, SF).items():
        days = {c: F.col(c).cast("int") for c in ("SK_DPD", "SK_DPD_DEF") if c in df.columns}
        sinks.sink_csv(df.withColumns(days) if days else df, f"{tmp_path}/{readers.FILES[name]}")
    path = f"{tmp_path}/{readers.FILES['bureau_balance']}"
    spark.createDataFrame([("x,y,z",)], "a string").write.mode("append").option("quote", "\u0000").option("sep", "|").csv(path, header=True)
    tables = readers.load_tables(spark, str(tmp_path), allowed_rejects=1)
    assert [(r["table_name"], r["line"]) for r in tables["rejects"].collect()] == [("bureau_balance", "x,y,z")]
    assert tables["bureau_balance"].count() == fx.tables(spark, SF)["bureau_balance"].count()
    with pytest.raises(readers.TooManyRejects):
        readers.load_tables(spark, str(tmp_path), allowed_rejects=0)


# ---- stored histories -----------------------------------------------------


def test_stored_histories_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = uuid.uuid4().hex
    try:
        given = fx.tables(spark, SF)
        stored = buckets.store_histories(given, f"{sinks.work_folder(spark)}/h-{name}", f"h_{name}", 4)
        config = features.FeatureConfig(installment_ties=fx.INSTALLMENT_TIES, card_ties=fx.CARD_TIES, placed=True)
        text = "\n".join(plan(g) for g in features.client_groups(stored, config))
        keys = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
        assert keys and set(keys) == {"SK_ID_CURR"}
        plain = "\n".join(plan(g) for g in features.client_groups(given, CONFIG))
        assert {"SK_ID_PREV", "SK_ID_BUREAU"} <= set(re.findall(r"Exchange hashpartitioning\((\w+)#", plain))
        again = buckets.open_histories(spark, given, f"h_{name}")
        assert again.keys() == given.keys() and all(again[t].count() == given[t].count() for t in buckets.KEYS)
    finally:
        buckets.drop_histories(spark, f"h_{name}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert buckets.open_histories(spark, {}, f"h_{name}") == {}


def test_buckets_follow_the_longest_history(spark, monkeypatch):
    given = {"pos_cash": spark.range(95).withColumnRenamed("id", "SK_ID_PREV"), "bureau": spark.range(40).withColumnRenamed("id", "SK_ID_BUREAU")}
    assert buckets.bucket_count(given) == buckets.bucket_count({}) == 8
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 10)
    assert buckets.bucket_count(given) == 10
    name = uuid.uuid4().hex
    try:
        buckets.store_histories(given, f"{sinks.work_folder(spark)}/h-{name}", f"h_{name}")
        for table in given:
            stored = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED h_{name}_{table}").collect()}
            assert stored["Num Buckets"] == "10"
    finally:
        buckets.drop_histories(spark, f"h_{name}")


# ---- ordered ranges -------------------------------------------------------


def test_ranges_leave_no_bounds_in_the_plan(spark):
    counts = fx.source(spark, SF, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    small = ordered.running(counts, ["event_type"], "value", ["n"])
    large = ordered.running(counts, ["event_type"], "value", ["n"], buckets=64)
    text = plan(large)
    assert "percentile" not in text and "0." not in re.sub(r"#\d+|plan_id=\d+|file:\S+", "", text)
    assert sorted(map(tuple, large.select(small.columns).collect())) == sorted(map(tuple, small.collect()))


# ---- intermediate tables --------------------------------------------------


def test_tables_of_a_run_go_with_it(spark):
    with sinks.run_folder(spark) as folder:
        stored = sinks.materialize(spark.range(5), "x")
        assert stored.inputFiles()[0].startswith(f"file:{folder}") or folder in stored.inputFiles()[0]
        ranked = ordered.running(spark.range(30).select((F.col("id") * 1.0).alias("v"), F.lit(1).alias("n")), [], "v", ["n"], buckets=3)
        assert ranked.agg(F.max("n_before")).first()[0] == 29
    with pytest.raises(Exception, match="(?i)path|exist"):
        spark.read.parquet(folder)
    with sinks.run_folder(spark, keep=True) as folder:
        sinks.materialize(spark.range(5), "x")
    assert folder not in sinks.materialize(spark.range(2)).inputFiles()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
