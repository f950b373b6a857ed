"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as registry
from check_oracle import compare, oracle
from tests.conftest import SF_DIR
from turnspool.plans import catalog, oracles


@pytest.fixture(scope="module")
def db():
    return oracle(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)
    assert set(catalog.QUERIES) <= set(registry.queries())


def test_entry_runs(spark):
    assert registry.entry(spark).count() == 2


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, name, SF_DIR) is None
