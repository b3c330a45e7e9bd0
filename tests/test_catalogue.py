import pytest

import __spark_entry__
from caseloom.plans import catalogue
from tests.oracle import duck, rows


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_oracle(spark, sf, name):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    if name in catalogue.ORACLES:
        want = duck(catalogue.ORACLES[name], sf)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_pushdown(spark, sf):
    plan = catalogue.QUERIES["resume_remaining"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[1][:60]
