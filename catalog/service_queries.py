"""Scoring requests and drift."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from catalog.registry import (
    APP_CLEAN,
    INTERCEPT,
    MEANS,
    TIER_SQL,
    WEIGHTS,
    app,
    encoding_sql,
    events,
    query,
    rounded,
    train_of,
)
from lendstrata.operators import application, drift, encode, evaluate, quality, sketches, target
from lendstrata.plans import features
from lendstrata.sources import sinks
from lendstrata.streaming import drift as stream_drift
from lendstrata.streaming import score


# ---- requests -------------------------------------------------------------

FIELDS = quality.request_fields(["buro_loan_count"])
_DEFAULTED = ["CNT_CHILDREN", "REGION_RATING_CLIENT", "AMT_ANNUITY", "NAME_CONTRACT_TYPE", "CNT_FAM_MEMBERS", "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_21", "buro_loan_count"]


@query(
    "apply_defaults",
    o.sql(
        "SELECT SK_ID_CURR, CAST(coalesce(CNT_CHILDREN, 0) AS INT) AS CNT_CHILDREN, "
        "CAST(CASE WHEN REGION_RATING_CLIENT = floor(REGION_RATING_CLIENT) THEN REGION_RATING_CLIENT ELSE 2 END AS INT) "
        "AS REGION_RATING_CLIENT, AMT_ANNUITY, NAME_CONTRACT_TYPE, TRY_CAST(CNT_FAM_MEMBERS AS DOUBLE) AS CNT_FAM_MEMBERS, "
        "CASE WHEN CNT_FAM_MEMBERS = 'many' THEN 'CNT_FAM_MEMBERS' ELSE '' END || CASE WHEN REGION_RATING_CLIENT = 1.5E0 THEN 'REGION_RATING_CLIENT' "
        "ELSE '' END AS type_errors, CAST(FLAG_DOCUMENT_2 AS INT) AS FLAG_DOCUMENT_2, CAST(NULL AS INT) AS FLAG_DOCUMENT_21, "
        "CAST(NULL AS DOUBLE) AS buro_loan_count FROM fx_requests",
        "fx_requests",
    ),
)
def _(s, d):
    out = quality.apply_defaults(fx.fixture(s, d, "fx_requests"), FIELDS, ["SK_ID_CURR"])
    return out.select("SK_ID_CURR", *_DEFAULTED, F.array_join("type_errors", "").alias("type_errors"))


_VIOLATIONS_SQL = (
    "SELECT SK_ID_CURR, concat_ws(';', "
    "CASE WHEN NAME_CONTRACT_TYPE IS NULL THEN 'NAME_CONTRACT_TYPE missing' END, "
    "CASE WHEN AMT_CREDIT <= 0 THEN 'AMT_CREDIT > 0' END, "
    "CASE WHEN AMT_INCOME_TOTAL <= 0 THEN 'AMT_INCOME_TOTAL > 0' END, "
    "CASE WHEN AMT_GOODS_PRICE <= 0 THEN 'AMT_GOODS_PRICE > 0' END, "
    "CASE WHEN CNT_CHILDREN < 0 THEN 'CNT_CHILDREN >= 0' END, "
    "CASE WHEN CNT_FAM_MEMBERS = 'many' THEN 'CNT_FAM_MEMBERS type' END, "
    "CASE WHEN TRY_CAST(CNT_FAM_MEMBERS AS DOUBLE) < 1 THEN 'CNT_FAM_MEMBERS >= 1' END, "
    "CASE WHEN DAYS_BIRTH >= 0 THEN 'DAYS_BIRTH < 0' END, "
    "CASE WHEN NAME_INCOME_TYPE IS NULL THEN 'NAME_INCOME_TYPE missing' END, "
    "CASE WHEN EXT_SOURCE_1 > 1 THEN 'EXT_SOURCE_1 <= 1' END, "
    "CASE WHEN REGION_RATING_CLIENT = 1.5E0 THEN 'REGION_RATING_CLIENT type' END, "
    "CASE WHEN REGION_RATING_CLIENT > 3 THEN 'REGION_RATING_CLIENT <= 3' END) AS violations FROM fx_requests"
)


@query(
    "validate_rules",
    o.sql(
        f"SELECT SK_ID_CURR, violations, CASE WHEN violations = '' THEN 1 ELSE 0 END AS valid FROM ({_VIOLATIONS_SQL})",
        "fx_requests",
    ),
)
def _(s, d):
    checked = quality.validate_rules(
        quality.apply_defaults(fx.fixture(s, d, "fx_requests"), FIELDS, ["SK_ID_CURR"]), FIELDS
    )
    return checked.select(
        "SK_ID_CURR", F.array_join("violations", ";").alias("violations"), F.col("valid").cast("int").alias("valid")
    )


_IN_TRAIN = "split = 'train'"
_REQUEST_RAW = (
    f"({INTERCEPT}E0 + coalesce({WEIGHTS['EXT_SOURCE_MEAN']}E0 * (list_avg([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) - {MEANS['EXT_SOURCE_MEAN']}E0), 0) "
    f"+ coalesce({WEIGHTS['CREDIT_INCOME_RATIO']}E0 * ({o.ratio('AMT_CREDIT', 'AMT_INCOME_TOTAL')} - {MEANS['CREDIT_INCOME_RATIO']}E0), 0) "
    f"+ coalesce({WEIGHTS['AGE_YEARS']}E0 * (-DAYS_BIRTH / 365.0E0 - {MEANS['AGE_YEARS']}E0), 0) "
    f"+ coalesce({WEIGHTS['EMPLOYED_YEARS']}E0 * (-nullif(DAYS_EMPLOYED, 365243) / 365.0E0 - {MEANS['EMPLOYED_YEARS']}E0), 0))"
)
_REQUEST_P = f"(1 / (1 + exp(-{_REQUEST_RAW})))"


@query(
    "score_stream",
    o.sql(
        f"SELECT SK_ID_CURR, violations, CASE WHEN violations = '' THEN round({_REQUEST_P}, 6) END AS default_probability, "
        f"CASE WHEN violations = '' THEN {TIER_SQL.format(_REQUEST_P)} END AS risk_tier, "
        "CASE WHEN violations <> '' THEN 1 ELSE 0 END AS has_request "
        f"FROM fx_requests JOIN ({_VIOLATIONS_SQL}) USING (SK_ID_CURR)",
        "fx_requests",
    ),
)
def _(s, d):
    """All requests as JSON lines through the stream, then its output table."""
    folder = f"{sinks.work_folder(s)}/requests-{uuid.uuid4().hex}"
    fx.fixture(s, d, "fx_requests").select(F.to_json(F.struct("*")).alias("value")).write.text(f"{folder}/in")

    def scorer(valid: DataFrame) -> DataFrame:
        raw = evaluate.logistic_score(WEIGHTS, INTERCEPT, MEANS)
        return evaluate.score_probability(application.app_features(application.fix_anomalies(valid)), raw)

    lines = score.read_requests(s, f"{folder}/in")
    score.score_stream(lines, FIELDS, scorer, f"{folder}/out").awaitTermination()
    return s.read.parquet(f"{folder}/out").select(
        "SK_ID_CURR", F.array_join("violations", ";").alias("violations"), "default_probability", "risk_tier",
        F.coalesce(F.col("request").contains(F.concat(F.lit('"SK_ID_CURR":'), "SK_ID_CURR")).cast("int"), F.lit(0)).alias("has_request"),
    )


_SERVED = [c for c in APP_CLEAN if c not in ("SK_ID_CURR", "TARGET")] + ["buro_loan_count"]


@query(
    "serving_encode",
    o.rounded(
        "SELECT a.SK_ID_CURR, a.* EXCLUDE (SK_ID_CURR, TARGET, split, ORGANIZATION_TYPE), coalesce(e.encoded, "
        "(SELECT avg(TARGET) FROM app_clean WHERE split = 'train')) AS ORGANIZATION_TYPE, NULL AS buro_loan_count "
        f"FROM app_clean a LEFT JOIN ({encoding_sql(_IN_TRAIN)}) e ON a.ORGANIZATION_TYPE = e.category",
        ["SK_ID_CURR"],
        "app_clean",
    ),
)
def _(s, d):
    raw = app(s, d)
    fitted = encode.fit_encoding(application.app_features(application.fix_anomalies(train_of(raw))))
    train = features.application_clean(train_of(raw), fitted)
    encoder = target.target_encode_full(train, ["ORGANIZATION_TYPE"], "TARGET")
    return rounded(quality.serving_encode(raw.drop("split", "TARGET"), fitted, _SERVED, encoder, ["SK_ID_CURR"]), ["SK_ID_CURR"])


# ---- drift ----------------------------------------------------------------

_WATCHED = ["value", "user_number", "clean_value"]
_WATCHED_TEXT = ["event_type", "level"]
_NUMBERS = [*_WATCHED, "gone_number", "never_number"]
_WORDS = [*_WATCHED_TEXT, "new_text", "never_text"]


def _named(names: list[str]) -> str:
    return "(VALUES " + ", ".join(f"('{n}')" for n in names) + ") AS names(feature)"


_SHIFTED = sorted(_WATCHED, key=lambda c: hashlib.md5(f"{c}:0".encode()).hexdigest())[0]


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Events before and since the middle of the month, the latter with one column shifted."""
    df = events(s, d)
    current = df.where("period = 'current'")
    return df.where("period = 'reference'"), drift.inject_drift(current, _WATCHED)


_SHIFTED_SQL = (
    f"SELECT * REPLACE (CASE WHEN period = 'current' THEN {_SHIFTED} + 1.5E0 * (SELECT stddev_samp({_SHIFTED}) FROM fx_events "
    f"WHERE period = 'current') ELSE {_SHIFTED} END AS {_SHIFTED}) FROM fx_events"
)


@query("inject_drift", o.rounded(f"SELECT event_id, {', '.join(_WATCHED)} FROM ({_SHIFTED_SQL})", ["event_id"], "fx_events"))
def _(s, d):
    reference, current = _sides(s, d)
    return rounded(reference.unionByName(current).select("event_id", *_WATCHED), ["event_id"])


_NUMERIC_SQL = f"""
SELECT feature, coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur, ks AS ks_statistic,
  CASE WHEN ks IS NULL THEN NULL WHEN lam < 0.2 THEN 1.0E0 ELSE least(1.0E0, greatest(0.0E0, 2 * list_sum(list_transform(range(1, 101),
    lambda j: (CASE WHEN j % 2 = 1 THEN 1.0E0 ELSE -1.0E0 END) * exp(-2.0E0 * lam * lam * j * j))))) END AS ks_p,
  distance / greatest(std, 0.001E0) AS wasserstein, mean_cur - mean_ref AS mean_shift,
  CASE WHEN (coalesce(n_ref, 0) = 0) <> (coalesce(n_cur, 0) = 0) OR distance / greatest(std, 0.001E0) >= 0.1 THEN 1 ELSE 0 END AS drifted
FROM {_named(_NUMBERS)} LEFT JOIN (SELECT *,
    (sqrt(n_ref * n_cur * 1.0E0 / (n_ref + n_cur)) + 0.12E0 + 0.11E0 / nullif(sqrt(n_ref * n_cur * 1.0E0 / (n_ref + n_cur)), 0)) * ks AS lam
  FROM (SELECT feature, max(abs(f - g)) AS ks, sum(abs(f - g) * width) AS distance FROM
    (SELECT feature, sum(r) OVER w * 1.0E0 / nullif(sum(r) OVER (PARTITION BY feature), 0) AS f,
       sum(c) OVER w * 1.0E0 / nullif(sum(c) OVER (PARTITION BY feature), 0) AS g,
       coalesce(lead(v) OVER (PARTITION BY feature ORDER BY v) - v, 0) AS width
     FROM (SELECT feature, v, count(*) FILTER (WHERE period = 'reference') AS r, count(*) FILTER (WHERE period = 'current') AS c
           FROM long GROUP BY feature, v)
     WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)) GROUP BY feature)
  JOIN (SELECT feature, count(*) FILTER (WHERE period = 'reference') AS n_ref, count(*) FILTER (WHERE period = 'current') AS n_cur,
      avg(v) FILTER (WHERE period = 'reference') AS mean_ref, avg(v) FILTER (WHERE period = 'current') AS mean_cur,
      stddev_pop(v) FILTER (WHERE period = 'reference') AS std FROM long GROUP BY feature) USING (feature)) USING (feature)"""
_LONG = f"(SELECT * FROM (SELECT period, {', '.join(_NUMBERS)} FROM ({_SHIFTED_SQL})) UNPIVOT (v FOR feature IN ({', '.join(_NUMBERS)})))"


@query("drift_numeric", o.rounded(_NUMERIC_SQL.replace("FROM long", f"FROM {_LONG}"), ["feature"], "fx_events", digits=6))
def _(s, d):
    return rounded(drift.drift_numeric(*_sides(s, d), _NUMBERS), ["feature"], 6)


_CATEGORY_SQL = f"""
SELECT feature, coalesce(n_ref, 0) AS n_ref, coalesce(n_cur, 0) AS n_cur, coalesce(n_categories, 0) AS n_categories, chi_square,
  jensen_shannon, coalesce(new_categories, 0) AS new_categories, coalesce(lost_categories, 0) AS lost_categories,
  coalesce(n_ref, 0) > 0 AND coalesce(n_cur, 0) > 0 AS both_sides, (coalesce(n_ref, 0) = 0) <> (coalesce(n_cur, 0) = 0) AS vanished, one_p, one_q
FROM {_named(_WORDS)} LEFT JOIN (SELECT feature, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, count(*) AS n_categories,
  max_by(p, v) AS one_p, max_by(q, v) AS one_q,
  sum(CASE WHEN r > 0 THEN power(c - r * n_cur * 1.0E0 / n_ref, 2) / nullif(r * n_cur * 1.0E0 / n_ref, 0) END) AS chi_square,
  CASE WHEN any_value(n_ref) > 0 AND any_value(n_cur) > 0 THEN
    sqrt(greatest(0, sum(coalesce(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) END, 0) + coalesce(CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) END, 0)) / 2)) END AS jensen_shannon,
  count(*) FILTER (WHERE r = 0 AND c > 0) AS new_categories, count(*) FILTER (WHERE r > 0 AND c = 0) AS lost_categories
FROM (SELECT *, r * 1.0E0 / nullif(n_ref, 0) AS p, c * 1.0E0 / nullif(n_cur, 0) AS q FROM
  (SELECT *, sum(r) OVER (PARTITION BY feature) AS n_ref, sum(c) OVER (PARTITION BY feature) AS n_cur FROM
    (SELECT feature, v, count(*) FILTER (WHERE period = 'reference') AS r, count(*) FILTER (WHERE period = 'current') AS c
     FROM (SELECT * FROM (SELECT period, {', '.join(_WORDS)} FROM fx_events) UNPIVOT (v FOR feature IN ({', '.join(_WORDS)})))
     GROUP BY feature, v))) GROUP BY feature) USING (feature)"""
_CATEGORY_OUT = "feature, n_ref, n_cur, n_categories, chi_square, jensen_shannon, new_categories, lost_categories"
_CATEGORY_DRIFT = "CASE WHEN vanished OR jensen_shannon >= 0.1 THEN 1 ELSE 0 END AS drifted"


@query("drift_categorical", o.rounded(f"SELECT {_CATEGORY_OUT}, {_CATEGORY_DRIFT} FROM ({_CATEGORY_SQL})", ["feature"], "fx_events", digits=6))
def _(s, d):
    return rounded(drift.drift_categorical(*_sides(s, d), _WORDS, p_values=False), ["feature"], 6)


def _erfc(x: str) -> str:
    terms = f"list_sum(list_transform(range(0, 120), lambda n: exp(2 * n * ln(2) + (2 * n + 1) * ln({x}) + lgamma(n + 1) - lgamma(2 * n + 2))))"
    return f"(CASE WHEN {x} > 5 THEN 0 ELSE 1 - 2 / sqrt(pi()) * exp(-{x} * {x}) * {terms} END)"


def _chi_p(x: str, k: str) -> str:
    """Tail of the chi-square distribution for few degrees of freedom."""
    terms = f"list_sum(list_transform(range(0, {k} // 2), lambda j: exp(-{x} / 2 + (j + ({k} % 2) / 2.0E0) * ln({x} / 2) - lgamma(j + ({k} % 2) / 2.0E0 + 1))))"
    odd = f"CASE WHEN {k} % 2 = 1 THEN {_erfc(f'sqrt({x} / 2)')} ELSE 0 END"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {k} < 1 OR {x} <= 0 THEN 1 WHEN isinf({x}) THEN 0 ELSE least(1, {odd} + coalesce({terms}, 0)) END)"


_TESTS_SQL = f"""
SELECT {_CATEGORY_OUT}, {_chi_p('x', 'k')} AS chi_square_p, CASE WHEN n_categories = 2 THEN {_chi_p('z', '1')} END AS z_p,
  CASE WHEN vanished OR {_chi_p('x', 'k')} < 0.05 THEN 1 ELSE 0 END AS drifted
FROM (SELECT *, CASE WHEN both_sides AND new_categories > 0 THEN 'inf'::DOUBLE ELSE chi_square END AS x, n_categories - 1 AS k,
  power(one_p - one_q, 2) / nullif(pooled * (1 - pooled) * (1.0E0 / nullif(n_ref, 0) + 1.0E0 / nullif(n_cur, 0)), 0) AS z
  FROM (SELECT *, (one_p * n_ref + one_q * n_cur) / nullif(n_ref + n_cur, 0) AS pooled FROM ({_CATEGORY_SQL})))"""


@query("drift_categorical_tests", o.rounded(_TESTS_SQL, ["feature"], "fx_events", digits=6))
def _(s, d):
    return rounded(drift.drift_categorical(*_sides(s, d), _WORDS, test="chisquare"), ["feature"], 6)


_MISSING_SQL = " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END)" for c in _NUMBERS + _WORDS)


@query(
    "drift_summary",
    o.sql(
        "SELECT round(n_drifted * 1.0E0 / n_features, 4) AS share_drifted_features, CAST(n_drifted AS BIGINT) AS n_drifted_features, "
        "n_features AS n_total_features, CASE WHEN n_drifted * 1.0E0 / n_features > 0.5 THEN 1 ELSE 0 END AS dataset_drift_detected, "
        + ", ".join(
            f"(SELECT round(({_MISSING_SQL}) / {len(_NUMBERS + _WORDS)}, 4) FROM fx_events WHERE period = '{p}') "
            f"AS share_missing_values_{p}"
            for p in ("current", "reference")
        )
        + " FROM (SELECT sum(drifted) AS n_drifted, count(*) AS n_features FROM (SELECT drifted FROM ("
        + _NUMERIC_SQL.replace("FROM long", f"FROM {_LONG}")
        + f") UNION ALL SELECT {_CATEGORY_DRIFT} FROM ({_CATEGORY_SQL})))",
        "fx_events",
    ),
)
def _(s, d):
    reference, current = _sides(s, d)
    found = drift.drift_numeric(reference, current, _NUMBERS).select("feature", "drifted").unionByName(
        drift.drift_categorical(reference, current, _WORDS, p_values=False).select("feature", "drifted")
    )
    return drift.drift_summary(found, reference, current, _NUMBERS + _WORDS)


# ---- drift of stored sketches, and of a stream ----------------------------

_SKETCHED = ["value", "user_number"]
_PLAIN_LONG = f"(SELECT * FROM (SELECT period, {', '.join(_SKETCHED)} FROM fx_events) UNPIVOT (v FOR feature IN ({', '.join(_SKETCHED)})))"


def _dated(s: SparkSession, d: str) -> DataFrame:
    """Events with their day, and the half of the month it is in."""
    return fx.source(s, d, "events").select(
        "ts", F.to_date("ts").alias("day"), "event_type", "value", F.col("user_id").cast("double").alias("user_number"),
        F.when(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"), "reference").otherwise("current").alias("period"),
    )


@query(
    "drift_sketched",
    o.rounded(
        f"SELECT feature, n_ref, n_cur, ks_statistic, wasserstein, mean_shift, 1 AS ks_within, 1 AS distance_within, 1 AS shift_fits FROM ("
        + _NUMERIC_SQL.replace("FROM long", f"FROM {_PLAIN_LONG}")
        + f") WHERE feature IN ({', '.join(repr(c) for c in _SKETCHED)})",
        ["feature", "ks_within", "distance_within", "shift_fits"],
        "fx_events",
        digits=6,
    ),
)
def _(s, d):
    """Sketches of each day, stored and merged per half of the month, against the exact statistics."""
    df = _dated(s, d)
    days = sinks.materialize(sketches.numeric_sketches(df, _SKETCHED, F.struct("period", "day")), "sketches")
    side = {p: sketches.merge_sketches(days.where(F.col("batch.period") == p)) for p in ("reference", "current")}
    about = sketches.drift_sketched(side["reference"], side["current"])
    exact = drift.drift_numeric(df.where("period = 'reference'"), df.where("period = 'current'"), _SKETCHED)
    both = exact.alias("e").join(about.alias("a"), "feature")
    within = F.abs(F.col("e.ks_statistic") - F.col("a.ks_statistic")) <= sketches.statistic_error()
    near = F.abs(F.col("e.wasserstein") - F.col("a.wasserstein")) <= F.col("a.wasserstein_error")
    fits = (F.abs(F.col("e.mean_shift") - F.col("a.mean_shift")) < 1e-6) & (F.col("e.n_ref") == F.col("a.n_ref")) & (F.col("e.n_cur") == F.col("a.n_cur"))
    checks = {"ks_within": within, "distance_within": near, "shift_fits": fits}
    return rounded(
        both.select("feature", *[F.col(f"e.{c}") for c in ("n_ref", "n_cur", "ks_statistic", "wasserstein", "mean_shift")], *[c.cast("int").alias(n) for n, c in checks.items()]),
        ["feature", *checks],
        6,
    )


# Any fixed edges and texts will do for the check.
_EDGES = {"value": [5.0, 15.0, 40.0, 100.0], "user_number": [200.0, 500.0, 900.0]}
_TEXTS = {"event_type": ["click", "error", "view"]}
_BINS_SQL = " UNION ALL ".join(
    [
        f"SELECT ts, '{c}' AS feature, CASE WHEN {x} IS NULL THEN 'missing' ELSE CAST({' + '.join(f'({x} > {e!r})::INT' for e in edges)} AS VARCHAR) END AS bin FROM events"
        for (c, edges), x in zip(_EDGES.items(), ("value", "CAST(user_id AS DOUBLE)"))
    ]
    + [
        f"SELECT ts, '{c}', CASE WHEN {c} IS NULL THEN 'missing' WHEN {c} IN ({', '.join(map(repr, known))}) THEN '=' || {c} ELSE 'other' END FROM events"
        for c, known in _TEXTS.items()
    ]
)
_WINDOWS_SQL = (
    f"SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS day, feature, bin, count(*) AS n FROM ({_BINS_SQL}) "
    "WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL"
)


_FIRST_DAY = 19723  # 2024-01-01 in days since 1970


def _streamed(s: SparkSession, d: str) -> DataFrame:
    """Counts per day from a stream of the events; the last day is still open."""
    folder = f"{sinks.work_folder(s)}/windows-{uuid.uuid4().hex}"
    # A pattern, since a stream's plain path has to be a folder.
    lines = s.readStream.schema(fx.source(s, d, "events").schema).parquet(f"{d}/events.parque[t]")
    rows = lines.select("ts", "event_type", "value", F.col("user_id").cast("double").alias("user_number"))
    stream_drift.count_stream(stream_drift.window_counts(rows, "ts", _EDGES, _TEXTS), folder).awaitTermination()
    return s.read.parquet(folder)


_DAY_EXPR = f"CAST(unix_seconds(window_start) div 86400 - {_FIRST_DAY} AS INT) AS day"


@query("stream_counts", _WINDOWS_SQL)
def _(s, d):
    return _streamed(s, d).select(F.expr(_DAY_EXPR), "feature", "bin", "n")


@query(
    "stream_drift",
    o.rounded(
        f"""
WITH windows AS ({_WINDOWS_SQL}),
base AS (SELECT feature, bin, count(*) AS n FROM ({_BINS_SQL}) WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL),
cells AS (SELECT day, feature, bin, coalesce(b.n, 0) AS r, coalesce(w.n, 0) AS c FROM
  (SELECT DISTINCT day, feature FROM windows) JOIN (SELECT feature, bin FROM windows UNION SELECT feature, bin FROM base) USING (feature)
  LEFT JOIN windows w USING (day, feature, bin) LEFT JOIN base b USING (feature, bin) WHERE w.n IS NOT NULL OR b.n IS NOT NULL),
sized AS (SELECT *, sum(r) OVER f AS n_ref, sum(c) OVER f AS n_cur, r * 1.0E0 / sum(r) OVER f AS p, c * 1.0E0 / sum(c) OVER f AS q
  FROM cells WINDOW f AS (PARTITION BY day, feature))
SELECT day, feature, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, CAST(bool_or(r = 0) AS INT) AS unseen,
  CASE WHEN NOT bool_or(r = 0) THEN sum(power(c - r * n_cur * 1.0E0 / n_ref, 2) / nullif(r * n_cur * 1.0E0 / n_ref, 0)) END AS chi_square,
  sqrt(greatest(0, sum(coalesce(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) END, 0) + coalesce(CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) END, 0)) / 2)) AS jensen_shannon
FROM sized GROUP BY day, feature""",
        ["day", "feature"],
        digits=6,
    ),
)
def _(s, d):
    """Each closed day of the stream against the first half of the month."""
    base = stream_drift.reference_counts(_dated(s, d).where("period = 'reference'"), _EDGES, _TEXTS)
    found = stream_drift.window_drift(_streamed(s, d), base)
    unseen = (F.col("chi_square") == float("inf")).cast("int").alias("unseen")
    finite = F.when(F.col("chi_square") < float("inf"), F.col("chi_square")).alias("chi_square")
    return rounded(found.select(F.expr(_DAY_EXPR), "feature", "n_ref", "n_cur", finite, "jensen_shannon", unseen), ["day", "feature"], 6)
