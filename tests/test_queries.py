"""Every registered query against its checking SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, duck
from workload import registry


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, connection, sf_dir, name):
    assert name in registry.ORACLES
    problem = compare(spark, connection, sf_dir, name, entry.queries()[name], registry.ORACLES[name])
    assert problem in (None, "both empty"), problem


def test_entry(spark):
    assert entry.entry(spark).count() == 9
