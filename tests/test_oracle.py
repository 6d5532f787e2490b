"""Every registered query next to its SQL on the smallest tables."""

import os
import sys

import pytest

from tests.conftest import SF_DIR

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

QUERIES, STATEMENTS = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, SF_DIR), tables, STATEMENTS[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - STATEMENTS.keys()))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_statement_has_a_query():
    assert STATEMENTS.keys() <= QUERIES.keys()


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["ts", "region", "follower_group", "topic", "count"]
    assert rows.count() > 0
