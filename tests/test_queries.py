"""Every registered query against its SQL, on the two smaller scales."""

import os

import pytest

import __spark_entry__ as entry
from catalog import queries as catalog
from compare import connect, difference

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
#: Full rows of trained trees, which SQL can't give; ``..._facts`` check what is certain about them, test_trees.py the rest.
TRAINED = {"cv_train", "fit_final", "param_search", "batch_score_fitted"}
DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module")
def connections():
    return {d: connect(d) for d in DIRS if os.path.isdir(d)}


def test_every_sql_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("sf_dir", DIRS)
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connections, name, sf_dir):
    if name == "param_search_facts" and sf_dir != DIRS[0]:
        pytest.skip("fifty trials, checked on the smaller tables")
    if sf_dir not in connections:
        pytest.skip("no test tables")
    assert difference(QUERIES[name](spark, sf_dir), ORACLES[name], connections[sf_dir]) is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_result_is_not_empty(connections, name):
    c = next(iter(connections.values()))
    assert c.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0] > 0


def test_every_query_has_sql_but_those_of_trained_trees():
    assert QUERIES.keys() - ORACLES.keys() == TRAINED


def test_trained_trees_give_full_rows(spark):
    found = QUERIES["cv_train"](spark, DIRS[0])
    assert found.columns == ["SK_ID_CURR", "TARGET", "fold", "oof_pred"]
    rows = found.collect()
    assert len({r["SK_ID_CURR"] for r in rows}) == len(rows) > 100 and len({round(r["oof_pred"], 9) for r in rows}) > 20
    scored = QUERIES["batch_score_fitted"](spark, DIRS[0])
    assert scored.columns == ["SK_ID_CURR", "split", "default_probability", "risk_tier"]
    assert scored.count() == 150 and scored.select("default_probability").distinct().count() > 20


def test_entry_is_one_row_per_application(spark):
    out = entry.entry(spark)
    assert out.count() == out.select("SK_ID_CURR").distinct().count() == 150
    assert "MOSTLY_MISSING" not in out.columns
