"""Every query against its SQL on the smallest tables, and its plan."""

import os

import pytest

import __spark_entry__ as contract
from panelkit import catalog
from tools.check import compare, connect
from tools.plans import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_its_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert catalog.queries().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", catalog.queries())
def test_result_and_plan(spark, con, name):
    """Same rows as the SQL, and a plan without cross joins or Python."""
    verdict, _ = compare(spark, con, SF_DIR, name)
    assert verdict == "ok"


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.queries()["below_declared_minimum"](spark, SF_DIR))
    assert "LessThan(s_acctbal,0.0)" in plan
    assert "ReadSchema: struct<s_name:string,s_acctbal:double>" in plan


def test_entry_has_rows(spark):
    assert contract.entry(spark).columns == ["region", "period", "sector_group", "value", "weight"]
