import os

import pytest

import __spark_entry__ as contract
from cellframe.workload.queries import QUERIES
from oracle_check import compare, connect

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert name in contract.oracle_sql(), "every query has a check"
    assert compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF) == []


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["i", "j", "v"] and df.count() > 0


def test_scans_read_only_what_they_need(spark):
    plan = contract.queries()["spmv_coo_sparse"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(p_size,25)" in plan
