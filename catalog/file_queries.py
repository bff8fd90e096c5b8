"""Files written and read back, names and columns, and prefix sums over buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from catalog.registry import app, query, rounded
from lendstrata.functions import text
from lendstrata.operators import application, columns, encode, ordered, rows
from lendstrata.sources import readers, sinks


def _folder(s: SparkSession) -> str:
    return f"{sinks.work_folder(s)}/files-{uuid.uuid4().hex}"


_POS = "SK_ID_PREV, MONTHS_BALANCE, CNT_INSTALMENT, CNT_INSTALMENT_FUTURE, NAME_CONTRACT_STATUS, CAST(SK_DPD AS INT) AS SK_DPD"


@query("scan_csv_typed", o.rounded(f"SELECT {_POS} FROM fx_pos", ["NAME_CONTRACT_STATUS"], "fx_pos"))
def _(s, d):
    folder = _folder(s)
    sinks.sink_csv(fx.fixture(s, d, "fx_pos").selectExpr(*_POS.split(", ")), folder)
    return rounded(readers.scan_csv_typed(s, folder, "pos_cash"), ["NAME_CONTRACT_STATUS"])


_GOOD = "MONTHS_BALANCE % 5 <> 0 AND SK_ID_PREV % 11 <> 0"


@query(
    "scan_csv_rejects",
    o.rounded(
        f"SELECT {_POS}, 0 AS rejected FROM fx_pos WHERE {_GOOD} UNION ALL "
        f"SELECT NULL, NULL, NULL, NULL, 'all', NULL, count(*) FROM fx_pos WHERE NOT ({_GOOD})",
        ["NAME_CONTRACT_STATUS"],
        "fx_pos",
    ),
)
def _(s, d):
    """A CSV in which some lines have a text in a number's place and some have too few cells: its good rows, and its rejects counted."""
    folder = _folder(s)
    cells = [F.coalesce(F.expr(c).cast("string"), F.lit("")) for c in _POS.split(", ")]
    cells[1] = F.when(F.expr("MONTHS_BALANCE % 5 = 0"), F.lit("last month")).otherwise(cells[1])
    line = F.when(F.expr("SK_ID_PREV % 11 = 0"), F.concat_ws(",", *cells[:3])).otherwise(F.concat_ws(",", *cells))
    names = [c.split(" AS ")[-1] for c in _POS.split(", ")]
    fx.fixture(s, d, "fx_pos").select(line.alias(",".join(names))).write.csv(folder, header=True, sep="\u0001")
    parsed = readers.scan_csv_lenient(s, folder, "pos_cash")
    count = parsed.rejects.agg(F.count("*").alias("rejected"))
    good = parsed.rows.withColumn("rejected", F.lit(0).cast("long"))
    absent = [F.lit("all" if c == "NAME_CONTRACT_STATUS" else None).cast(good.schema[c].dataType).alias(c) for c in names]
    return rounded(good.unionByName(count.select(*absent, "rejected")), ["NAME_CONTRACT_STATUS"])


_LOADED = {
    "application_train": "fx_application WHERE split = 'train'", "application_test": "fx_application WHERE split = 'test'",
    "bureau": "fx_bureau", "bureau_balance": "fx_bureau_balance", "previous_app": "fx_previous", "pos_cash": "fx_pos",
    "installments": "fx_installments", "credit_card": "fx_credit_card",
}


@query(
    "load_tables",
    o.sql(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {source}" for t, source in _LOADED.items()),
        *sorted({source.split()[0] for source in _LOADED.values()}),
    ),
)
def _(s, d):
    folder = _folder(s)
    for name, df in fx.tables(s, d).items():
        days = {c: F.col(c).cast("int") for c in ("SK_DPD", "SK_DPD_DEF") if c in df.columns}
        sinks.sink_csv(df.withColumns(days) if days else df, f"{folder}/{readers.FILES[name]}")
    return columns.table_profile(readers.load_tables(s, folder)).select("table_name", "row_count")


@query("sink_parquet", o.sql("SELECT SK_ID_BUREAU, SK_ID_CURR, CREDIT_ACTIVE, AMT_CREDIT_SUM FROM fx_bureau", "fx_bureau"))
def _(s, d):
    folder = _folder(s)
    df = fx.fixture(s, d, "fx_bureau").select("SK_ID_BUREAU", "SK_ID_CURR", "CREDIT_ACTIVE", "AMT_CREDIT_SUM")
    sinks.sink_parquet(df, folder, ["CREDIT_ACTIVE"])
    return readers.scan_parquet(s, folder)


@query("sink_csv", o.sql("SELECT CAST(id AS VARCHAR) AS id, round(score_a, 6) AS score_a FROM fx_scored", "fx_scored"))
def _(s, d):
    folder = _folder(s)
    sinks.sink_csv(fx.fixture(s, d, "fx_scored").select("id", F.round("score_a", 6).alias("score_a")), folder)
    return s.read.csv(folder, header=True).select("id", F.col("score_a").cast("double").alias("score_a"))


@query("clean_column_names", "SELECT p_partkey AS part_key, p_size AS size_in_cm FROM part")
def _(s, d):
    odd = fx.source(s, d, "part").select(F.col("p_partkey").alias("part (key)"), F.col("p_size").alias(" size: in/cm!"))
    return text.clean_column_names(odd)


@query("add_prefix", "SELECT p_partkey, p_size AS part_p_size, p_brand AS part_p_brand FROM part")
def _(s, d):
    return text.add_prefix(fx.source(s, d, "part").select("p_partkey", "p_size", "p_brand"), "part_", ["p_partkey"])


@query("select_features", o.sql("SELECT CODE_GENDER, AMT_CREDIT, EXT_SOURCE_2 FROM fx_application", "fx_application"))
def _(s, d):
    return rows.select_features(app(s, d).select("SK_ID_CURR", "TARGET", "CODE_GENDER", "AMT_CREDIT", "EXT_SOURCE_2"))


_KEPT = "SK_ID_CURR, CODE_GENDER, FLAG_OWN_CAR, NAME_INCOME_TYPE, ORGANIZATION_TYPE"


@query("drop_high_card", o.sql(f"SELECT {_KEPT} FROM app_fixed", "app_fixed"))
def _(s, d):
    df = application.fix_anomalies(app(s, d)).select(*_KEPT.split(", "), "NAME_FREE_TEXT")
    return encode.drop_high_card(df, encode.fit_encoding(df))


_PREFIX = o.rounded(
    "SELECT event_type, value, n, coalesce(sum(n) OVER w, 0) AS n_before, lead(value) OVER (PARTITION BY event_type ORDER BY value) AS next_value "
    "FROM (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL) "
    "WINDOW w AS (PARTITION BY event_type ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    ["event_type"],
    digits=6,
)


@query("prefix_sums_ranged", _PREFIX)
def _(s, d):
    """Prefix sums over 64 ranges, whatever the number of values."""
    counts = fx.source(s, d, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    return rounded(ordered.running(counts, ["event_type"], "value", ["n"], buckets=64), ["event_type"], 6)


@query(
    "prefix_sums",
    o.rounded(
        "SELECT event_type, value, n, coalesce(sum(n) OVER w, 0) AS n_before, lead(value) OVER (PARTITION BY event_type ORDER BY value) AS next_value "
        "FROM (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL) "
        "WINDOW w AS (PARTITION BY event_type ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        ["event_type"],
        digits=6,
    ),
)
def _(s, d):
    """Prefix sums through ordered buckets of about 500 values."""
    counts = fx.source(s, d, "events").groupBy("event_type", "value").agg(F.count("*").alias("n"))
    return rounded(ordered.running(counts, ["event_type"], "value", ["n"], bucket_rows=500), ["event_type"], 6)
