"""Every registered query against its SQL twin."""

import compare
import pytest
from fixtures import SF

import __spark_entry__ as registry
from tidelog.plans.oracle import ORACLE


def test_every_query_has_a_twin():
    assert set(ORACLE) <= set(registry.queries())
    assert all(registry.oracle_sql()[name] == sql for name, sql in ORACLE.items())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = registry.queries()[name](spark, SF)
    assert compare.difference(df, compare.connect(SF), registry.oracle_sql()[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0
