import importlib
import re
from pathlib import Path

import pytest

from fieldsync.catalog.oracles import ORACLES
from fieldsync.catalog.queries import REGISTERED
from tools.check_oracles import compare, compare_rows, connect

SF_DIR = "/root/testdata/sf0.001"

LARGER_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not here")


@pytest.fixture(scope="module")
def connections():
    return {d: connect(d) for d in (SF_DIR, LARGER_DIR)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REGISTERED)
def test_query(spark, connections, name):
    """Rows as SQL has them; no cross join, no window over everything, no Python but for the walk through shared serials."""
    df = REGISTERED[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan and "Python" not in plan
    assert "MapInArrow" not in plan or name == "stock_shared_serials"
    problem = compare_rows(df, connections[SF_DIR], name)
    if problem == "no rows on either side":
        problem = compare(spark, connections[LARGER_DIR], name, LARGER_DIR)
    assert problem is None


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTERED) == set(ORACLES)
    assert set(REGISTERED) <= set(entry.queries())
    assert "responselogid" in entry.entry(spark).columns


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(REGISTERED["repush_backlog"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_linestatus,O\)", plan)
    assert "l_comment" not in plan and "l_extendedprice" not in plan


def test_library_has_no_hints_or_local_cuts():
    files = [p for p in (Path(__file__).parent.parent / "fieldsync").rglob("*.py") if "llm" not in p.parts]
    source = "\n".join(p.read_text() for p in files)
    assert "llm" not in source
    for word in ("localCheckpoint", "crossJoin", "broadcast(", "toPandas", ".rdd.map", "toLocalIterator"):
        assert word not in source
    assert set(ORACLES) <= set(REGISTERED)


def shared_serials_by_fold(spark, sf_dir):
    """The stock rows after all events of the given tables, folded one by one."""
    from fieldsync.catalog import derive as d
    from tests.fold import Book

    state = {name: [r.asDict() for r in df.collect()] for name, df in d.stock_state(spark, sf_dir).items()}
    book = Book(state["stock"], state["stock_serials"], state["materials"], state["contractors"])
    received = [r.asDict() for r in d.receipt_events(spark, sf_dir, d.shared_serial).collect()]
    returned = [r.asDict() for r in d.return_events(spark, sf_dir, d.shared_serial).collect()]
    for event in sorted(received + returned, key=lambda e: e["seq"]):
        book.receipt(event) if "contractorcode" in event else book.give_back(event)
    return sorted((i, None if s["qty"] is None else int(s["qty"])) for i, s in book.stock.items())


def test_shared_serials_equal_plain_fold(spark):
    rows = REGISTERED["stock_shared_serials"](spark, SF_DIR).collect()
    got = sorted((r["stock_rid"], None if r["qty"] is None else int(r["qty"])) for r in rows)
    assert got == shared_serials_by_fold(spark, SF_DIR)
