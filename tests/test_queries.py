"""Every query with SQL gives the same rows as the SQL; every other one runs."""

import oracle
import pytest
from chatmill.plans import core_queries, queries, report_queries

ALL = {**core_queries.QUERIES, **queries.QUERIES, **report_queries.QUERIES}
SQL = {**core_queries.SQL, **queries.SQL, **report_queries.SQL}


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, folder, con, name):
    oracle.compare(ALL[name](spark, folder), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL) - {"a_topics"}))
def test_runs(spark, folder, name):
    frame = ALL[name](spark, folder)
    assert frame.columns and frame.count() >= 0


def test_entry(spark, folder):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
