"""Queries that SQL can express, against their SQL."""

import pytest
from compare import connect, difference

from lendstrata.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert difference(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) is None


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
