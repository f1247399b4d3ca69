"""Every registered query against its SQL counterpart, and the driver contract."""

import pytest

import __spark_entry__ as entry_point
from check_queries import compare, connect

ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, con, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert len(df.collect()) > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["dataset", "f1", "recall", "n_fraud", "n_rows"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())
