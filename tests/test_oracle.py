"""Every query with an SQL form gives the same rows as DuckDB on the smallest tables."""

import pytest

from corpusloom import plans
from tests.compare import difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(spark, name):
    assert difference(spark, SF, plans.queries()[name], plans.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(plans.queries().keys() - plans.oracle_sql().keys()))
def test_runs_without_sql(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0
