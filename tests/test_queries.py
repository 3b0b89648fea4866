"""Every registered query against its SQL counterpart on the given tables."""

import pytest

import __spark_entry__ as registry
import oracle
from tests.compare import spark_result, sql_engine, sql_result

FOLDER = registry.SMOKE_DIR
# The optional subpackage tests its own queries.
QUERIES, SQL = registry.queries(), oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return sql_engine(FOLDER)


def test_every_statement_has_a_query():
    assert set(registry.oracle_sql()) <= set(QUERIES) and set(SQL) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    assert spark_result(QUERIES[name](spark, FOLDER)) == sql_result(connection, SQL[name])


def test_regression_queries_agree(spark):
    odds = QUERIES["logistic_odds"](spark, FOLDER).collect()
    assert len(odds) == 16 and all(r["or_low"] <= r["odds_ratio"] <= r["or_high"] for r in odds)
