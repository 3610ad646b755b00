"""Every registered tracking query against its SQL."""

import pytest
from conftest import DATA, same_rows

from framewright.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, oracle, name):
    same_rows(registry.queries()[name](spark, DATA), oracle, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() >= 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
