"""Every registered query beside its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from workload.check import compare, connect
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert ORACLE and QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert compare(name, df, duck) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
