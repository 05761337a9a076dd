"""Every registered query with SQL against DuckDB on the smallest tables."""

import compare
import pytest

from beneflow.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", ORACLE)
def test_equals_sql(spark, folder, connection, name):
    assert compare.difference(QUERIES[name](spark, folder), connection, ORACLE[name]) is None
