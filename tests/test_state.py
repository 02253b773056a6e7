"""State as a base and changes: rows, size of what a run writes, reruns, runs that get in between."""

import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldsync.plans.stock import STATE_KEYS, change_stock
from fieldsync.sources import runlog, state
from tests.fold import Book
from tests.test_stock import CONTRACTORS, MATERIALS, random_events, stocks

KEYS = {"stock": ("stock_rid",)}


def rows_written(spark, root, number):
    return {t: {p: v["rows"] for p, v in parts.items()} for t, parts in runlog.entry(spark, f"{root}/_log", number)["tables"].items()}


def plus(amount, *ids):
    """A job that adds to the quantity of these stocks, or makes them."""

    def job(given):
        spark = given["stock"].sparkSession
        touched = spark.createDataFrame([(i,) for i in ids], "stock_rid long")
        old = touched.join(given["stock"].select("stock_rid", "qty"), "stock_rid", "left")
        new = old.select("stock_rid", (F.coalesce("qty", F.lit(0)) + amount).cast("decimal(38,4)").alias("qty"))
        empty = spark.createDataFrame([], given["stock"].schema)
        return {"stock": state.Change(touched, empty.unionByName(new, allowMissingColumns=True))}

    return job


def quantities(spark, root, at=None):
    rows = state.read_state(spark, root, KEYS, at)["stock"].collect()
    assert len(rows) == len({r["stock_rid"] for r in rows})
    return {r["stock_rid"]: int(r["qty"]) for r in rows}


@pytest.fixture
def root(spark, make, tmp_path):
    folder = str(tmp_path / "state")
    assert state.start_state(spark, folder, {"stock": make("stock", *[dict(stock_rid=i, qty=Decimal(i)) for i in range(1, 101)])}, KEYS) == 1
    return folder


def test_a_run_writes_what_it_changes(spark, root):
    assert state.change_state(spark, root, KEYS, "a", plus(10, 5, 200)) == 2
    assert rows_written(spark, root, 2) == {"stock": {"removed": 2, "added": 2}}
    want = {**{i: i for i in range(1, 101)}, 5: 15, 200: 10}
    assert quantities(spark, root) == want and quantities(spark, root, 1) == {i: i for i in range(1, 101)}
    assert state.change_state(spark, root, KEYS, "a", plus(10, 5, 200)) == 2
    assert quantities(spark, root) == want and runlog.head(spark, f"{root}/_log") == 2


def test_new_base_when_due(spark, root):
    for n in range(3):
        state.change_state(spark, root, KEYS, f"r{n}", plus(1, *range(1, 6)))
    kinds = [e["kind"] for e in runlog.entries(spark, f"{root}/_log")]
    assert kinds == ["base", "change", "change", "change", "base"]  # 30 rows of changes are over a quarter of 100
    want = {i: i + 3 if i < 6 else i for i in range(1, 101)}
    assert quantities(spark, root) == quantities(spark, root, 4) == want
    assert quantities(spark, root, 3) == {i: i + 2 if i < 6 else i for i in range(1, 101)}
    assert not state.compact(spark, root, KEYS)
    assert state.change_state(spark, root, KEYS, "r1", plus(1, 1)) == 3  # known, though a base came after it


def test_a_run_that_gets_in_between(spark, root, monkeypatch):
    """The job runs again on what the other run left."""
    claim, others = runlog.claim, []

    def late(session, folder, number, content):
        if not others:
            others.append(True)
            state.change_state(session, root, KEYS, "other", plus(100, 1), share=None)
        return claim(session, folder, number, content)

    monkeypatch.setattr(runlog, "claim", late)
    assert state.change_state(spark, root, KEYS, "one", plus(10, 1), share=None) == 3
    assert quantities(spark, root)[1] == 111
    with pytest.raises(state.Superseded):
        state.start_state(spark, root, {"stock": state.read_state(spark, root, KEYS)["stock"]}, KEYS)
    assert quantities(spark, root)[1] == 111


def test_runs_at_once(spark, root):
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda n: state.change_state(spark, root, KEYS, f"r{n}", plus(1, 7, 300 + n), share=None), range(3)))
    assert sorted(done) == [2, 3, 4]
    got = quantities(spark, root)
    assert got[7] == 10 and [got[300 + n] for n in range(3)] == [1, 1, 1]


def test_nothing_there(spark, make, tmp_path):
    folder = str(tmp_path / "none")
    assert state.read_state(spark, folder, STATE_KEYS)["stock"].isEmpty()
    assert state.start_state(spark, folder, {"stock": make("stock")}, KEYS) == 1
    assert quantities(spark, folder) == {}
    state.change_state(spark, folder, KEYS, "a", plus(1, 1))
    assert quantities(spark, folder) == {1: 1}


@pytest.mark.parametrize("share", [None, 0.0])
def test_batches_equal_plain_fold(spark, make, tmp_path, share):
    """Serials with copies, without a number and in several stocks; every batch is folded on what the last one left."""
    rng = random.Random(11)
    rows, serials = stocks(rng, False)
    ins, outs = random_events(rng, 90)
    book = Book(rows, serials, MATERIALS, CONTRACTORS)
    folder = str(tmp_path / "stock")
    state.start_state(spark, folder, {"stock": make("stock", *rows), "stock_serials": make("stock_serials", *serials)}, STATE_KEYS)
    dimensions = {"materials": make("materials", *MATERIALS), "contractors": make("contractors", *CONTRACTORS)}
    for first in (1, 46):
        part = range(first, first + 45)
        book.next_base = max(book.stock)
        for event in sorted((e for e in ins + outs if e["seq"] in part), key=lambda e: e["seq"]):
            book.receipt(event) if "contractorcode" in event else book.give_back(event)
        batch = make("receipt_events", *[e for e in ins if e["seq"] in part]), make("return_events", *[e for e in outs if e["seq"] in part])
        for _ in range(2 if first == 1 and share is None else 1):
            change_stock(spark, folder, f"from-{first}", dimensions, *batch, share=share)
        now = state.read_state(spark, folder, STATE_KEYS)
        got = [(r["stock_rid"], r["qty"]) for r in now["stock"].collect()]
        assert sorted(got, key=str) == sorted([(i, None if s["qty"] is None else Decimal(s["qty"])) for i, s in book.stock.items()], key=str)
        held = Counter((r["stock_rid"], r["serial_no"]) for r in now["stock_serials"].collect())
        assert held == Counter((s["stock_rid"], s["serial_no"]) for s in book.serials)
