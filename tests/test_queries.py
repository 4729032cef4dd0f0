"""Every query of the library itself against its SQL twin on the smallest tables.

Queries on training data have their own tests; SQL can't express them.
"""

import pytest

import __spark_entry__ as entry
from folioflow.plans.queries import QUERIES
from tests.compare import compare, connect

TWINS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(TWINS) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_equals_its_twin(spark, con, sf_dir, name):
    problem, _ = compare(spark, con, name, sf_dir)
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
