"""Every registered query against its SQL counterpart."""

import pytest

import check_oracle
import __spark_entry__ as entry
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert check_oracle.compare(spark, con, SF, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
