"""Every query beside its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
import wordloom_oracle
from check_oracle import connect, differences

SF = "/root/testdata/sf0.001"
ORACLE = wordloom_oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry._QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 50


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert differences(spark, con, SF, entry.queries()[name], ORACLE[name]) == []
