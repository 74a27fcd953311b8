"""Every registered query against its DuckDB statement on the smallest data."""

import pytest

import __spark_entry__
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_statement(spark, sf_dir, duck, name):
    assert compare(name, QUERIES[name](spark, sf_dir), duck) == []


def test_every_query_has_a_statement():
    """Word hashes differ between engines, so this one is checked against a plain loop elsewhere."""
    assert set(QUERIES) - set(ORACLES) == {"near_incidents"}


def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.count() == 15 and "is_anomaly" in frame.columns
