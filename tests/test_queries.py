"""Every registered query against its SQL, and the shape of every plan."""

import oracle
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Training is slow and covered by test_scoring.
SLOW = {"gbt_train_score"}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert oracle.compare(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
