"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from catalog import fixtures as fx
from catalog.queries import QUERIES
from lendstrata.operators import bureau, history
from lendstrata.plans import features

SF = "/root/testdata/sf0.001"
#: Trained by a library that works on its own; contributions of trees are an Arrow pass.
MODELS = {"cv_train", "fit_final", "param_search", "batch_score_fitted", "tree_contributions"}
MODELS |= {"cv_train_facts", "fit_final_facts", "param_search_facts", "batch_score_facts"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"\bExchange hashpartitioning", text))


@pytest.fixture()
def shuffled(spark):
    """Plans as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - MODELS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(QUERIES["scan_parquet"](spark, SF))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>", text)
    months = plan(bureau.bureau_balance_loan(fx.fixture(spark, SF, "fx_bureau_balance")))
    assert "l_comment" not in months and "l_extendedprice" not in months


@pytest.mark.parametrize("name", ["sample_n", "top_n_importance"])
def test_top_rows_are_kept_while_scanning(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_recent_filter_reaches_the_scan(spark):
    df = fx.source(spark, SF, "orders").where("o_totalprice > 1000")
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan(df)


def test_month_rollup_is_one_shuffle_after_combining(shuffled):
    text = plan(bureau.bureau_balance_loan(fx.fixture(shuffled, SF, "fx_bureau_balance")))
    assert exchanges(text) == 1 and "partial_count" in text and "Join" not in text


def test_installments_are_shuffled_once(shuffled):
    text = plan(history.install_loan(fx.fixture(shuffled, SF, "fx_installments"), fx.INSTALLMENT_TIES))
    assert exchanges(text) == 1


def test_card_window_and_rollup_share_a_shuffle(shuffled):
    text = plan(history.card_loan(fx.fixture(shuffled, SF, "fx_credit_card"), fx.CARD_TIES))
    assert exchanges(text) == 1


def test_feature_build_shuffles(shuffled):
    config = features.FeatureConfig(installment_ties=fx.INSTALLMENT_TIES, card_ties=fx.CARD_TIES)
    t = fx.tables(shuffled, SF)
    text = plan(features.join_spine(t["application_train"], *features.client_groups(t, config)))
    client = plan(features.client_groups(t, config)[1])
    # loans once, each history once, clients once
    assert exchanges(client) == 5
    # months, bureau credits for their join and by client, spine; the last two join customers with nations
    assert exchanges(text) == exchanges(client) + 3 + 1 + 2
    # the client aggregation keeps to in-place buffers
    assert re.search(r"HashAggregate\(keys=\[SK_ID_CURR", client) and not re.search(r"SortAggregate\(key=\[SK_ID_CURR", client)
