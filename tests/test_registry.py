"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as contract
from grantlens.plans.oracles import ORACLES
from grantlens.plans.registry import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return compare.duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, folder, duck, name):
    assert compare.differences(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["decade", "country", "patents_per_decade"]
    assert frame.count() > 0
