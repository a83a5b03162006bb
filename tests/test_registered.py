"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from sluiceway.plans.registry import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, sf_dir, name):
    registered = QUERIES[name]
    assert registered.oracle, f"{name} has no SQL"
    count, diffs = compare(spark, con, registered.run, registered.oracle, sf_dir)
    assert diffs == []
    assert count > 0


def test_contract(spark):
    assert set(contract.queries()) - set(contract.LLM) == set(QUERIES)
    assert set(contract.oracle_sql()) - set(contract.LLM) == set(QUERIES)
    assert contract.entry(spark).columns[:4] == ["user_id", "event_type", "start", "end"]
