"""Encoding, evaluation, models and explanations."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import oracle as o
from catalog.registry import (
    APP_CLEAN,
    DIMENSIONS,
    INTERCEPT,
    MEANS,
    QUERIES,
    TEXTS,
    TIER_SQL,
    WEIGHTS,
    app,
    encoding_sql,
    engineered,
    matrix,
    query,
    rounded,
)
from lendstrata.operators import application, columns, encode, evaluate, explain, folds, target, trees
from lendstrata.plans import scoring, training


# ---- encoding -------------------------------------------------------------

@query(
    "encoding_policy",
    o.sql(
        "SELECT column_name, n_unique, CASE WHEN n_unique = 2 THEN 'label' WHEN column_name IN ('ORGANIZATION_TYPE', "
        "'OCCUPATION_TYPE') THEN 'keep' WHEN n_unique <= 10 THEN 'one_hot' ELSE 'drop' END AS action FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM app_fixed" for c in TEXTS
        )
        + ")",
        "app_fixed",
    ),
)
def _(s, d):
    """The policy needs to know of "more than ten" only; the exact counts are a profile of their own."""
    train = application.fix_anomalies(app(s, d).drop("split"))
    actions = encode.fit_encoding(train).table(s).drop("n_unique")
    return actions.join(columns.nunique_profile(train), "column_name").select("column_name", "n_unique", "action")


@query(
    "label_sets",
    o.sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS label FROM app_fixed WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM app_fixed) <= 10 GROUP BY {c}"
            for c in TEXTS
        ),
        "app_fixed",
    ),
)
def _(s, d):
    """The labels of text columns with at most ten, from one pass of bounded sketches."""
    found = columns.label_sets(application.fix_anomalies(app(s, d)), TEXTS, 10)
    return s.createDataFrame([(c, label) for c, labels in found.items() for label in labels or ()], "column_name string, label string")


@query("label_encode", o.sql("SELECT SK_ID_CURR, CODE_GENDER, FLAG_OWN_CAR FROM app_clean", "app_clean"))
def _(s, d):
    clean = application.fix_anomalies(app(s, d)).select("SK_ID_CURR", "CODE_GENDER", "FLAG_OWN_CAR")
    return encode.fit_encoding(clean).transform(clean)


_SEGMENT_COLUMNS = [f"NAME_INCOME_TYPE_{s}" for s in o.SEGMENTS]


@query("one_hot", o.sql(f"SELECT SK_ID_CURR, {', '.join(_SEGMENT_COLUMNS)} FROM app_clean", "app_clean"))
def _(s, d):
    df = app(s, d).select("SK_ID_CURR", "NAME_INCOME_TYPE")
    return encode.fit_encoding(df).transform(df).select("SK_ID_CURR", *_SEGMENT_COLUMNS)


@query(
    "target_encode_full",
    o.rounded(
        "SELECT category, encoded, m AS global_mean FROM (" + encoding_sql("TRUE") + ")", ["category"], "app_clean", digits=6
    ),
)
def _(s, d):
    df = columns.fill_category(app(s, d), ["ORGANIZATION_TYPE"])
    fitted = target.target_encode_full(df, ["ORGANIZATION_TYPE"], "TARGET")
    return rounded(
        fitted.table.table.select("category", "encoded", F.lit(fitted.global_mean).alias("global_mean")), ["category"], 6
    )


def _fold_encoded(c: str) -> str:
    """Encoding per category and held-out fold, from the rows outside that fold."""
    return (
        f"(SELECT x.category, k.fold, (sum(x.s) + any_value(k.m) * 10) / (sum(x.n) + 10) AS encoded FROM "
        f"(SELECT {c} AS category, fold, sum(label) AS s, count(*) AS n FROM folded GROUP BY 1, 2) x "
        f"JOIN outside k ON x.fold <> k.fold GROUP BY x.category, k.fold)"
    )


@query(
    "target_encode_folds",
    o.rounded(
        "SELECT f.id, f.fold, coalesce(a.encoded, k.m) AS lang, coalesce(b.encoded, k.m) AS source FROM folded f "
        "JOIN outside k ON f.fold = k.fold "
        f"LEFT JOIN {_fold_encoded('lang')} a ON f.lang = a.category AND f.fold = a.fold "
        f"LEFT JOIN {_fold_encoded('source')} b ON f.source = b.category AND f.fold = b.fold",
        ["id", "fold"],
        "folded",
        "outside",
        digits=6,
    ),
)
def _(s, d):
    folded = folds.stratified_folds(fx.fixture(s, d, "fx_scored"), "id", "label")
    encoded = target.target_encode_folds(folded, ["lang", "source"], "label").out_of_fold(folded)
    return rounded(encoded.select("id", "fold", "lang", "source"), ["id", "fold"], 6)


# ---- evaluation -----------------------------------------------------------

def _auc_sql(score: str, table: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT {by + ', ' if by else ''}(sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0E0)
  / (sum(label) * sum(1 - label)) AS auc
FROM (SELECT *, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER ({'PARTITION BY ' + (by + ', ' if by else '') + score}) - 1) / 2.0E0 AS r
  FROM {table}) {f'GROUP BY {by}' if by else ''}"""


@query("auc", o.rounded(_auc_sql("score_a", "fx_scored"), [], "fx_scored", digits=8))
def _(s, d):
    return rounded(evaluate.auc(fx.fixture(s, d, "fx_scored"), "score_a", "label"), [], 8)


@query(
    "auc_by_fold",
    o.rounded(
        "SELECT fold, auc, avg(auc) OVER () AS mean_auc, stddev_pop(auc) OVER () AS std_auc FROM (" + _auc_sql("score_a", "folded", "fold") + ")",
        ["fold"],
        "folded",
        digits=8,
    ),
)
def _(s, d):
    folded = folds.stratified_folds(fx.fixture(s, d, "fx_scored"), "id", "label")
    return rounded(evaluate.auc_by_fold(folded, "score_a", "label", "fold"), ["fold"], 8)


@query(
    "compare_models",
    o.rounded(
        "SELECT a.auc AS champion_auc, b.auc AS challenger_auc, CASE WHEN b.auc - a.auc > 0.001 THEN 1 ELSE 0 END AS promote "
        f"FROM ({_auc_sql('score_a', 'fx_scored')}) a, ({_auc_sql('score_b', 'fx_scored')}) b",
        [],
        "fx_scored",
        digits=8,
    ),
)
def _(s, d):
    return rounded(evaluate.compare_models(fx.fixture(s, d, "fx_scored"), "score_b", "score_a", "label"), [], 8)


@query("risk_tier", o.sql(f"SELECT id, {TIER_SQL.format('score_a')} AS tier FROM fx_scored", "fx_scored"))
def _(s, d):
    return fx.fixture(s, d, "fx_scored").select("id", evaluate.risk_tier("score_a").alias("tier"))


@query(
    "baseline_probability",
    o.sql("SELECT round(1 / (1 + exp(-avg(score_a * 4 - 3))), 6) AS baseline_probability FROM fx_scored", "fx_scored"),
)
def _(s, d):
    return evaluate.baseline_probability(fx.fixture(s, d, "fx_scored"), F.col("score_a") * 4 - 3)


@query(
    "prediction_mean_check",
    o.rounded(
        "SELECT p AS predicted_mean, t AS train_mean, abs(p - t) AS difference, CASE WHEN abs(p - t) > 0.02 THEN 1 ELSE 0 END AS warning "
        "FROM (SELECT avg(score_a) AS p, avg(label) AS t FROM fx_scored)",
        [],
        "fx_scored",
        digits=6,
    ),
)
def _(s, d):
    scored = fx.fixture(s, d, "fx_scored")
    return rounded(evaluate.prediction_mean_check(scored, "score_a", scored, "label"), [], 6)


_RAW_SQL = f"{INTERCEPT}E0" + "".join(
    f" + coalesce({w}E0 * ({c} - {MEANS.get(c, 0.0)}E0), 0)" for c, w in WEIGHTS.items()
)
_RAW_SQL = f"({_RAW_SQL})"
_P_SQL = f"(1 / (1 + exp(-{_RAW_SQL})))"


@query(
    "logistic_score",
    o.sql(
        f"SELECT SK_ID_CURR, round({_P_SQL}, 6) AS default_probability, {TIER_SQL.format(_P_SQL)} AS risk_tier FROM app_engineered",
        "app_engineered",
    ),
)
def _(s, d):
    raw = evaluate.logistic_score(WEIGHTS, INTERCEPT, MEANS)
    return evaluate.score_probability(engineered(s, d), raw).select("SK_ID_CURR", "default_probability", "risk_tier")


# Scores of trained trees have no SQL. Their queries return full rows; what is certain about them (rows, folds, features, ranges) is
# checked by queries of its own, and scoring by an ensemble that is written out here.
@query("cv_train")
def _(s, d):
    """Out-of-fold score of every training row."""
    built = matrix(s, d)
    return training.cv_train(built.train, built.test).oof


@query(
    "cv_train_facts",
    o.sql(
        "SELECT SK_ID_CURR, TARGET, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY md5(concat_ws(':', CAST(SK_ID_CURR AS VARCHAR), '42')), SK_ID_CURR) - 1) % 5 "
        "AS INT) AS fold, 1 AS in_range FROM fx_application WHERE split = 'train'",
        "fx_application",
    ),
)
def _(s, d):
    oof = QUERIES["cv_train"](s, d)
    return oof.select("SK_ID_CURR", "TARGET", "fold", F.col("oof_pred").between(0, 1).cast("int").alias("in_range"))


@query("fit_final")
def _(s, d):
    """Importance of every feature of the model on all rows."""
    return training.fit_final(matrix(s, d).train).importance(s)


@query(
    "fit_final_facts",
    o.sql(
        f"SELECT unnest([{', '.join(repr(c) for c in APP_CLEAN if c not in ('SK_ID_CURR', 'TARGET', 'MOSTLY_MISSING'))}]) AS feature, "
        "1 AS sums_to_one, 0 AS negative"
    ),
)
def _(s, d):
    """Importances of the application's features; those of all features add up to 1."""
    found = QUERIES["fit_final"](s, d)
    total = found.agg((F.abs(F.sum("importance") - 1) < 1e-6).cast("int")).scalar()
    negative = found.agg(F.count_if(F.col("importance") < 0)).scalar()
    return found.where(F.col("feature").isin(APP_CLEAN)).select(
        "feature", total.alias("sums_to_one"), negative.alias("negative")
    )


SEARCH_TRIALS, SEARCH_KEEP = 50, 3


@query("param_search")
def _(s, d):
    """All trials and rungs of a search over 50 settings, the best trial first."""
    return training.param_search(matrix(s, d).train, training.proposals(SEARCH_TRIALS), keep=SEARCH_KEEP)


_RUNGS = training.rungs(SEARCH_TRIALS, training.TreeParams().trees, SEARCH_KEEP)


@query(
    "param_search_facts",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({r}, {n}, {trees}, {_RUNGS[r + 1][0] if r + 1 < len(_RUNGS) else 0}, 1)" for r, (n, trees) in enumerate(_RUNGS))
    + ") AS t(rung, trials, trees, go_on, in_range)",
)
def _(s, d):
    """Trials of each rung, their trees, and how many of them go on."""
    return (
        QUERIES["param_search"](s, d)
        .groupBy("rung", "trees")
        .agg(
            F.count("*").alias("trials"),
            F.count_if("goes_on").alias("go_on"),
            F.min(F.coalesce(F.col("auc").between(0, 1), F.lit(False)).cast("int")).alias("in_range"),
        )
    )


@query("batch_score_fitted")
def _(s, d):
    """Every application scored by the model that is fitted on the training ones."""
    built = matrix(s, d)
    return training.fit_final(built.train).score(built.matrix, "SK_ID_CURR", "split")


@query(
    "batch_score_facts",
    o.sql("SELECT SK_ID_CURR, split, 1 AS in_range, 1 AS tier_fits FROM fx_application", "fx_application"),
)
def _(s, d):
    scored = QUERIES["batch_score_fitted"](s, d)
    p = F.col("default_probability")
    near = F.lit(False)
    for limit in (0.05, 0.15, 0.30):  # the tier is that of the unrounded probability
        near = near | (F.abs(p - limit) <= 1e-6)
    fits = (evaluate.risk_tier("default_probability") == F.col("risk_tier")) | near
    return scored.select("SK_ID_CURR", "split", p.between(0, 1).cast("int").alias("in_range"), fits.cast("int").alias("tier_fits"))


# Any fixed ensemble will do for the check: splits as (feature, threshold, left, right), leaves as (value, rows).
ENSEMBLE = [
    ("EXT_SOURCE_MEAN", 0.45,
     ("CREDIT_INCOME_RATIO", 30.0, (0.30, 120.0), ("AGE_YEARS", 38.5, (0.85, 60.0), (0.55, 90.0))),
     ("AGE_YEARS", 50.0, (-0.90, 300.0), ("EXT_SOURCE_MEAN", 0.75, (-1.30, 200.0), (-1.75, 80.0)))),
    ("EMPLOYED_YEARS", 4.0,
     ("DEF_30_RATE", 0.15, (0.12, 210.0), (0.47, 40.0)),
     ("CREDIT_INCOME_RATIO", 55.0, ("EMPLOYED_YEARS", 12.0, (-0.21, 260.0), (-0.38, 190.0)), (0.05, 150.0))),
    ("AGE_YEARS", 29.0, (0.33, 95.0), ("DEF_30_RATE", 0.4, (-0.08, 640.0), ("EXT_SOURCE_MEAN", 0.3, (0.61, 35.0), (0.24, 80.0)))),
    (-0.75, 850.0),
]
ENSEMBLE_COLUMNS = ["EXT_SOURCE_MEAN", "CREDIT_INCOME_RATIO", "AGE_YEARS", "EMPLOYED_YEARS", "DEF_30_RATE"]


def _rows_of(tree) -> float:
    return tree[1] if len(tree) == 2 else _rows_of(tree[2]) + _rows_of(tree[3])


def _mean_of(tree) -> float:
    if len(tree) == 2:
        return tree[0]
    a, b = _rows_of(tree[2]), _rows_of(tree[3])
    return (a * _mean_of(tree[2]) + b * _mean_of(tree[3])) / (a + b)


def _nodes_of(tree) -> list[tuple]:
    """The tree as a list of nodes, the root first."""
    if len(tree) == 2:
        return [(trees.LEAF, 0.0, 0, 0, tree[0], tree[1])]
    left, right = _nodes_of(tree[2]), _nodes_of(tree[3])
    moved = [[(f, t, a + n, b + n, v, c) for f, t, a, b, v, c in side] for side, n in ((left, 1), (right, 1 + len(left)))]
    return [(ENSEMBLE_COLUMNS.index(tree[0]), tree[1], 1, 1 + len(left), _mean_of(tree), _rows_of(tree)), *moved[0], *moved[1]]


def ensemble() -> training.FinalModel:
    return training.FinalModel(trees.Trees.of([_nodes_of(t) for t in ENSEMBLE]), None, ENSEMBLE_COLUMNS, [])


def _walk_sql(tree, known: frozenset[str]) -> str:
    """A tree's value if only some features are known: both ways otherwise, weighted by rows."""
    if len(tree) == 2:
        return f"{tree[0]!r}E0"
    left, right = (_walk_sql(t, known) for t in tree[2:])
    if tree[0] in known:
        return f"CASE WHEN {tree[0]} IS NULL OR {tree[0]} <= {tree[1]!r}E0 THEN {left} ELSE {right} END"
    a, b = _rows_of(tree[2]), _rows_of(tree[3])
    return f"({left} * {a / (a + b)!r}E0 + {right} * {b / (a + b)!r}E0)"


def _features_of(tree) -> set[str]:
    return set() if len(tree) == 2 else {tree[0]} | _features_of(tree[2]) | _features_of(tree[3])


def _contribution_sql(feature: str) -> str:
    """Mean change of a feature becoming known, over all orders in which the features of a tree become known."""
    parts = ["0.0E0"]
    for tree in ENSEMBLE:
        own = _features_of(tree)
        if feature not in own:
            continue
        others = sorted(own - {feature})
        for n in range(len(others) + 1):
            weight = factorial(n) * factorial(len(own) - n - 1) / factorial(len(own))
            for some in combinations(others, n):
                known = frozenset(some)
                parts.append(f"{weight!r}E0 * ({_walk_sql(tree, known | {feature})} - {_walk_sql(tree, known)})")
    return " + ".join(parts)


_TREES_SQL = "(" + " + ".join(f"({_walk_sql(t, frozenset(ENSEMBLE_COLUMNS))})" for t in ENSEMBLE) + ")"
_TREES_P_SQL = f"(1 / (1 + exp(-{_TREES_SQL})))"


@query(
    "batch_score",
    o.sql(
        f"SELECT SK_ID_CURR, split, round({_TREES_P_SQL}, 6) AS default_probability, {TIER_SQL.format(_TREES_P_SQL)} AS risk_tier FROM app_engineered",
        "app_engineered",
    ),
)
def _(s, d):
    return ensemble().score(engineered(s, d), "SK_ID_CURR", "split")


@query(
    "tree_contributions",
    o.rounded(
        f"SELECT SK_ID_CURR, raw_score, {sum(_mean_of(t) for t in ENSEMBLE)!r}E0 AS expected_score, unnest([{', '.join(repr(c) for c in ENSEMBLE_COLUMNS)}]) AS feature, "
        f"unnest([{', '.join(_contribution_sql(c) for c in ENSEMBLE_COLUMNS)}]) AS contribution FROM (SELECT *, {_TREES_SQL} AS raw_score FROM app_engineered)",
        ["SK_ID_CURR", "feature"],
        "app_engineered",
        digits=6,
    ),
)
def _(s, d):
    """What each feature adds to the raw score of each row; with the expected score they add up to it."""
    model = ensemble()
    found = model.contributions(engineered(s, d), "SK_ID_CURR")
    each = found.select("SK_ID_CURR", "raw_score", F.posexplode("contributions").alias("at", "contribution"))
    names = F.array(*[F.lit(c) for c in model.columns])
    return rounded(
        each.select("SK_ID_CURR", F.get(names, F.col("at")).alias("feature"), "raw_score", F.lit(model.trees.expected).alias("expected_score"), "contribution"),
        ["SK_ID_CURR", "feature"],
        6,
    )


# ---- explanations ---------------------------------------------------------

def _embedded(s: SparkSession, d: str) -> DataFrame:
    return fx.source(s, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))


def _names():
    return F.array(*[F.lit(x) for x in DIMENSIONS])


def _values():
    return F.transform("embedding", lambda c, i: F.when(i % 7 != 0, c * 10))


@query(
    "explain_top_n",
    o.sql(
        "SELECT vec_id, CAST(rank AS INT) AS rank, feature, round(c, 6) AS contribution, "
        "CASE WHEN c > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction, "
        "CASE WHEN (i - 1) % 7 <> 0 THEN round(c * 10, 4) END AS feature_value FROM factors WHERE rank <= 10",
        "factors",
    ),
)
def _(s, d):
    explained = explain.explain_top_n(_embedded(s, d), F.col("embedding"), _names(), _values(), 10)
    return explained.select("vec_id", F.posexplode("top_features").alias("at", "f")).select(
        "vec_id", (F.col("at") + 1).alias("rank"), "f.feature", "f.contribution", "f.direction", "f.feature_value"
    )


_CONTRIBUTIONS = ", ".join(f"{w}E0 * ({c} - {MEANS.get(c, 0.0)}E0)" for c, w in WEIGHTS.items())
_FEATURES_SQL = ", ".join(f"'{c}'" for c in WEIGHTS)


@query(
    "explain_all_factors",
    o.sql(
        "SELECT vec_id, CAST(rank AS INT) AS rank, feature, round(c, 6) AS contribution FROM factors", "factors"
    ),
)
def _(s, d):
    explained = explain.explain_top_n(_embedded(s, d), F.col("embedding"), _names(), _values(), len(DIMENSIONS))
    return explained.select("vec_id", F.posexplode("top_features").alias("at", "f")).select(
        "vec_id", (F.col("at") + 1).alias("rank"), "f.feature", "f.contribution"
    )


@query(
    "explain_scores",
    o.sql(
        f"SELECT SK_ID_CURR, round({_P_SQL}, 6) AS default_probability, {TIER_SQL.format(_P_SQL)} AS risk_tier, CAST(r AS INT) AS rank, "
        "f[i] AS feature, round(c[i], 6) AS contribution, round(b, 6) AS baseline FROM (SELECT *, unnest(CASE WHEN len(ranks) > 0 THEN ranks END) AS i, "
        "generate_subscripts(ranks, 1) AS r FROM (SELECT *, list_transform(list_slice(list_sort(list_transform(list_filter(range(1, "
        f"{len(WEIGHTS) + 1}), lambda j: c[j] IS NOT NULL), lambda j: {{'k': -abs(c[j]), 'j': j}})), 1, 3), lambda x: x.j) AS ranks "
        f"FROM (SELECT *, [{_CONTRIBUTIONS}] AS c, [{_FEATURES_SQL}] AS f, (SELECT 1 / (1 + exp(-avg({_RAW_SQL}))) FROM app_engineered) AS b "
        "FROM app_engineered)))",
        "app_engineered",
    ),
)
def _(s, d):
    """Score, baseline and top factors of a row in one plan; features that are missing are no factors."""
    rows = engineered(s, d)
    explained = scoring.explain_linear(rows, WEIGHTS, INTERCEPT, MEANS, 3)
    return explained.select(
        "SK_ID_CURR", "default_probability", "risk_tier", "baseline", F.posexplode("top_features").alias("at", "x")
    ).select(
        "SK_ID_CURR", "default_probability", "risk_tier", (F.col("at") + 1).alias("rank"), "x.feature", "x.contribution",
        F.round("baseline", 6).alias("baseline"),
    )


@query(
    "mixed_signal_rows",
    "SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INT) AS n_positive, "
    "CAST(len(list_filter(embedding, lambda x: x < 0)) AS INT) AS n_negative FROM embeddings "
    "WHERE list_max(embedding) > 0.1 AND list_min(embedding) < -0.1",
)
def _(s, d):
    return explain.mixed_signal_rows(_embedded(s, d), F.col("embedding")).select("vec_id", "n_positive", "n_negative")


def _text_sql(x: str, digits: int) -> str:
    t = f"rtrim(CAST(CAST(round({x}, {digits}) AS DECIMAL(30, {digits})) AS VARCHAR), '0')"
    return f"(CASE WHEN {t} LIKE '%.' THEN {t} || '0' ELSE {t} END)"


@query(
    "render_explanation",
    o.sql(
        f"""
SELECT vec_id, 'Assessment summary:' || chr(10) || '- Default probability: ' || {_text_sql('p * 100', 2)} ||
  '% (population baseline: 8.07%)' || chr(10) || '- Risk tier: ' || tier || chr(10) || chr(10) ||
  'Top factors driving this assessment:' || chr(10) || lines AS explanation,
  'This application has a ' || {_text_sql('p * 100', 2)} || '% estimated default probability and is classified as ' ||
  tier || ' risk. Narrative explanation unavailable.' AS fallback
FROM (SELECT vec_id, p, {TIER_SQL.format('p')} AS tier FROM
   (SELECT vec_id, 1 / (1 + exp(-CAST(embedding[1] AS DOUBLE))) AS p FROM embeddings))
JOIN (SELECT vec_id, string_agg('  - ' || feature || ': ' || CASE WHEN c > 0 THEN 'increases' ELSE 'decreases' END ||
   ' default risk (value: ' || coalesce(CASE WHEN (i - 1) % 7 <> 0 THEN {_text_sql('c * 10', 4)} END, 'unknown') ||
   '), SHAP impact: ' || {_text_sql('round(c, 6)', 3)}, chr(10) ORDER BY rank) AS lines
  FROM factors WHERE rank <= 5 GROUP BY vec_id) USING (vec_id)""",
        "factors",
    ),
)
def _(s, d):
    p = evaluate.sigmoid(F.get("embedding", F.lit(0)))
    factors = explain.top_factors(F.col("embedding"), _names(), _values(), 5)
    out = explain.render_explanation(_embedded(s, d), p, F.lit(0.0807), evaluate.risk_tier(p), factors)
    return out.select("vec_id", "explanation", "fallback")
