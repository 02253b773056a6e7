"""Registered queries of this package beside their SQL."""

import pytest

from fieldsync.llm.catalog import ORACLES, REGISTERED
from tools.check_oracles import connect, rows_of

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    made = REGISTERED[name](spark, DIRECTORY)
    result = connect(DIRECTORY).execute(ORACLES[name])
    rows = rows_of(made.columns, made.collect())
    assert rows and rows == rows_of([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("name", ["op3_line_frequency", "op4_pfair"])
def test_native(spark, name):
    plan = REGISTERED[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
