"""Every case against the same result in SQL, and properties all plans must have."""

import os

import pytest

from cases import CASES
from tests.check_cases import compare, connect

FOLDER = os.environ.get("CASES_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


ROW_BY_ROW = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")
PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", CASES)
def test_same_as_sql(spark, db, name):
    frame = CASES[name].run(spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in (*ROW_BY_ROW, *PAIRS) if step in plan]
    # The only window is the one that keeps one row per key in each task, before any exchange.
    assert plan.count("+- Window [") <= plan.count("+- WindowGroupLimit [")
    # The smallest tables have no row for a few cases; both sides then agree on that.
    assert [p for p in compare(db, frame, CASES[name].sql) if not p.startswith("no rows")] == []


def test_driver_entry(spark):
    import __spark_entry__ as entry

    assert set(CASES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 9
