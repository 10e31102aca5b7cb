"""Every query against its DuckDB SQL on the smallest test tables."""

import pytest
from oracle_check import DATA, compare, oracle_connection

from __spark_entry__ import entry
from wayword.plans.oracle import ORACLE
from wayword.plans.queries import REGISTRY

SF_DIR = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == ["freq", "word"]


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    assert compare(REGISTRY[name](spark, str(SF_DIR)), con, ORACLE[name]) is None
