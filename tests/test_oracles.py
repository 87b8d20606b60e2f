"""Every query of the core against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests.compare import difference, duck
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_each_query_of_the_core_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_registers_all_of_them():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
