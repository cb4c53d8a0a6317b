"""Every query of the library against its SQL."""

import pytest
from comparing import same_rows

from narrata.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, duck, name):
    df = catalog.QUERIES[name](spark, small)
    if name in catalog.ORACLES:
        same_rows(df, catalog.ORACLES[name], duck)
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_links_come_from_an_equi_join(spark, small):
    df = catalog.QUERIES["q_event_links"](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
