"""Every query that has SQL, against it."""

import pytest

from tallymark.plans import decl_queries, decl_sql, problem_queries, problem_sql
from tests.conftest import DATA
from tests.helpers import connect, same

QUERIES = problem_queries.QUERIES | decl_queries.QUERIES
SQL = problem_sql.SQL | decl_sql.SQL


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    same(QUERIES[name](spark, DATA), con, SQL[name])
