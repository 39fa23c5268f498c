"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from readloom import plans

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = plans.queries(), plans.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    err = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    # on the smallest tables some selections are empty on both sides
    assert err in (None, "both empty"), err


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "condition", "n_samples", "mean_uniquely_mapped", "mean_assignment_rate", "passed", "failed"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
