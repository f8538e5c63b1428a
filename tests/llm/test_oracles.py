"""Every query with oracle SQL gives its rows."""

import pytest

from helpers import SF001, oracle_rows, spark_rows
from textflow.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, name):
    names, rows = spark_rows(catalog.QUERIES[name](spark, SF001))
    wanted_names, wanted = oracle_rows(catalog.ORACLES[name])
    assert names == wanted_names
    assert rows == wanted


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
