"""Every registered query against its oracle SQL, whole tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from ledgerlake import queries as registry
from ledgerlake.operators.joins import plan_text

NOT_IN_A_PLAN = (
    "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
)

registry.load()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(key, spark, sf, con):
    df = QUERIES[key](spark, sf)
    text = plan_text(df, "simple")
    assert not [word for word in NOT_IN_A_PLAN if word in text]
    if key in ORACLES:
        assert compare(df, con, ORACLES[key]) is None
    else:
        assert df.count() > 0


def test_entry(spark, sf):
    assert not entry.entry(spark).isEmpty()


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
