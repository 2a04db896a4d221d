import pytest

import __spark_entry__ as E
from compare import TESTDATA, connect, differences, type_differences

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql()[name]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert type_differences(df, con, sql) == ""
    assert differences(df.toPandas(), con.execute(sql).df()) == ""


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 3550
    assert "lag1_wd" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
