"""Every registered query against its SQL counterpart, on the smallest test set."""

import pytest

from check import connect, difference
from oracle.statements import SQL
from scdstar.queries import QUERIES

from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    expected = connection.execute(SQL[name]).df()
    assert difference(QUERIES[name](spark, SMALL), expected) is None
