"""Every catalogue query against its check SQL at the smallest scale."""

import pytest
from checking import compare, connect

from kinfold.examples import catalogue

SF = "/root/testdata/sf0.001"
CATALOGUE = catalogue()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", CATALOGUE)
def test_query(spark, duck, name):
    fn, sql = CATALOGUE[name]
    df = fn(spark, SF)
    if sql:
        compare(df, duck, sql)
    else:
        assert df.count() > 0
    # Equi joins only: nothing forms a product, not even a broadcast one.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    spark.catalog.clearCache()


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
