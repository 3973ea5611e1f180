"""Every registered query against its SQL on the driver's smallest tables."""

import compare
import pytest
from conftest import SF

from fiscalweave.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, SQL[name]) == []
