"""Every registered query against its SQL check, or for rows where it has none."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    assert len(set(df.columns)) == len(df.columns)
    if name in CHECKS:
        assert compare(df, con, CHECKS[name]) == []
    else:
        assert len(df.collect()) > 0


def test_checks_name_queries():
    assert set(CHECKS) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 8
    assert df.columns == ["rule_id", "n_rows", "passed", "failed", "unknown", "pass_rate"]
