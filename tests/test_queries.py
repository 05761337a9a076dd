"""Every registered query against its SQL counterpart on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_point
from beneflow.plans.oracle import ORACLE
from beneflow.plans.queries import registered

QUERIES = registered()


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


def test_only_the_sketch_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"percentile_approx_100"}
    assert set(ORACLE) <= set(QUERIES)


def test_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert "rank_vl_total" in df.columns
    assert df.count() == 3121


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, folder, connection, name):
    df = QUERIES[name](spark, folder)
    if name in ORACLE:
        assert compare.difference(df, connection, ORACLE[name]) is None
    else:
        assert df.count() > 0
