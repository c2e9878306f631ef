"""Every registered query against its SQL, over the whole of the smallest tables."""

import oracle_check
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tessella.plans.oracle import ORACLE
from tessella.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return oracle_check.connect(SF)


def test_all_queries_have_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, database, name):
    assert oracle_check.compare(spark, database, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() == 2
