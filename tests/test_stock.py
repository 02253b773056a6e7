import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldsync.plans.stock import stock_ledger
from fieldsync.sources.staging import stage
from tests.fold import Book

MATERIALS = [dict(mm_rid=i, name=f"m{i}", code=f"c{i}") for i in (1, 2, 3)] + [dict(mm_rid=9, name="m1", code="c1")]
CONTRACTORS = [dict(contact_rid=10 + i, vendor_code=str(i)) for i in (1, 2, 3)] + [dict(contact_rid=99, vendor_code="1")]


def stocks(rng, empty):
    if empty:
        return [], []
    rows = [
        dict(stock_rid=1, mat_rid=1, holder_rid=11, stock_condition_index=800, qty=Decimal(5)),
        dict(stock_rid=2, mat_rid=2, holder_rid=11, stock_condition_index=800, qty=None),
        dict(stock_rid=3, mat_rid=1, holder_rid=12, stock_condition_index=801, qty=Decimal(2)),
        dict(stock_rid=4, mat_rid=3, holder_rid=13, stock_condition_index=800, qty=Decimal(1)),
        dict(stock_rid=5, mat_rid=3, holder_rid=13, stock_condition_index=800, qty=Decimal(7)),
    ]
    serials = []
    for serial in ("A1", "A2", "A3", "b4", "a1", None):
        for sid in rng.sample([1, 2, 3, 4, 5], rng.choice([0, 1, 2])):
            serials.append(dict(stock_rid=sid, mat_rid=None, serial_no=serial, make_rid=0))
    return rows, serials


def random_events(rng, n):
    ins, outs = [], []
    for seq in range(1, n + 1):
        m = rng.choice([1, 1, 2, 3, 7])
        serial = rng.choice(["A1", "A2", "A3", "A4", "B4", "a1", "b4", None])
        kind = rng.choice(["serialized", "serialized", "non-serialized", "other"] if seq % 9 == 0 else ["serialized", "serialized", "non-serialized"])
        vendor = rng.choice(["1", "1", "2", "3", "8", None])
        qty = rng.choice([1, 2, 3, None]) if rng.random() < 0.3 else rng.randint(1, 5)
        base = dict(seq=seq, doc_number=rng.randint(1, 5), materialname=f"m{m}", materialcode=f"c{m}", quantity=qty, serialno=serial, type=kind)
        if rng.random() < 0.55:
            ins.append(dict(base, contractorcode=vendor))
        else:
            outs.append(dict(base, fromcontractorcode=vendor))
    return ins, outs


@pytest.mark.parametrize("seed,empty,block_rows", [(1, True, 10**6), (3, False, 5)])
def test_ledger_equals_plain_fold(make, seed, empty, block_rows):
    rng = random.Random(seed)
    rows, serials = stocks(rng, empty)
    ins, outs = random_events(rng, 120)
    book = Book(rows, serials, MATERIALS, CONTRACTORS)
    for event in sorted(ins + outs, key=lambda e: e["seq"]):
        book.receipt(event) if "contractorcode" in event else book.give_back(event)

    inputs = {
        "stock": make("stock", *rows),
        "stock_serials": make("stock_serials", *serials),
        "materials": make("materials", *MATERIALS),
        "contractors": make("contractors", *CONTRACTORS),
    }
    out = stock_ledger(inputs, make("receipt_events", *ins), make("return_events", *outs), block_rows=block_rows)

    got = {r["stock_rid"]: r["qty"] for r in out["stock"].collect()}
    assert got == {i: None if s["qty"] is None else Decimal(s["qty"]) for i, s in book.stock.items()}

    held = Counter((r["stock_rid"], r["serial_no"]) for r in out["stock_serials"].collect())
    assert held == Counter((s["stock_rid"], s["serial_no"]) for s in book.serials)

    shared = {r["seq"]: (r["stock_id"], r["qty_after"]) for r in out["movements"].collect()}
    for seq, (sid, qty) in shared.items():
        assert book.after[seq] == (sid, qty), seq
    alone = {i for i, s in book.stock.items() if s["mat_rid"] is None or s["holder_rid"] is None}
    assert set(book.after) - set(shared) == {q for q, (sid, _) in book.after.items() if sid in alone}

    balance = {r["stock_id"]: r["serials"] for r in out["balance"].collect()}
    distinct = Counter(sid for sid, serial in held if serial is not None)
    for sid, n in balance.items():
        assert distinct.get(sid, 0) == n


def test_bad_receipts_are_rejected(make):
    inputs = {
        "stock": make("stock"),
        "stock_serials": make("stock_serials"),
        "materials": make("materials", *MATERIALS),
        "contractors": make("contractors", *CONTRACTORS),
    }
    good = dict(materialname="m1", materialcode="c1", contractorcode="1", serialno="S", type="serialized", crvdate="2024-01-02")
    receipts = make(
        "receipt_events",
        dict(good, seq=1, factoryfile="{bad"),
        dict(good, seq=2, contractorcode="X"),
        dict(good, seq=3, crvdate="yesterday"),
        dict(good, seq=4, factoryfile=""),
        dict(good, seq=5, type="unknown", crvdate="yesterday"),
    )
    out = stock_ledger(inputs, receipts, make("return_events"))
    assert {r["seq"] for r in out["rejected"].collect()} == {1, 2, 3}
    assert [(r["seq"], r["qty_after"]) for r in out["movements"].collect()] == [(4, Decimal(1))]
    stock = out["stock"].select("mat_rid", "holder_rid", "uom_rid", "holder_type", "bu_rid", "group_rid", F.col("qty").cast("int").alias("qty"))
    assert [tuple(r) for r in stock.collect()] == [(1, 11, 1, 2, 20, 3, 1)]


def state(make, **given):
    tables = dict(stock=[], stock_serials=[], materials=MATERIALS, contractors=CONTRACTORS)
    return {t: make(t, *given.get(t, rows)) for t, rows in tables.items()}


RECEIPT = dict(materialname="m1", materialcode="c1", contractorcode="1", type="serialized")
BULK = dict(materialname="m2", materialcode="c2", contractorcode="1", type="non-serialized")


def test_large_quantities(make):
    receipts = [dict(RECEIPT, seq=i, serialno=f"S{i}") for i in range(1, 1501)]
    # The receipt that makes its stock may bring any quantity, a later one may not.
    receipts += [dict(BULK, seq=2001, quantity=2_000_000), dict(BULK, seq=2002, quantity=1_000_000), dict(BULK, seq=2003, quantity=999_999)]
    returns = [dict(seq=2004, materialname="m2", materialcode="c2", fromcontractorcode="1", quantity=1_000_000, type="non-serialized")]
    out = stock_ledger(state(make), make("receipt_events", *receipts), make("return_events", *returns))
    assert {r["mat_rid"]: int(r["qty"]) for r in out["stock"].collect()} == {1: 1_125_750, 2: 2_999_999}
    assert {(r["seq"], r["reject_reason"]) for r in out["rejected"].collect()} == {(2002, "quantity out of range"), (2004, "quantity out of range")}


def test_ids_beyond_int(make):
    big = 3_000_000_000
    inputs = state(make, materials=[dict(mm_rid=big, name="m1", code="c1")])
    out = stock_ledger(inputs, make("receipt_events", dict(RECEIPT, seq=big, serialno="S")), make("return_events"))
    assert [(r["stock_rid"], r["mat_rid"]) for r in out["stock"].collect()] == [(big, big)]
    assert [r["mat_rid"] for r in out["stock_serials"].collect()] == [big]


def test_unusual_events(make):
    """Unknown contractors and materials, serials that are NULL, types that are unknown."""
    receipts = [
        dict(RECEIPT, seq=1, serialno="A", materialcode="none"),
        dict(RECEIPT, seq=2, serialno="B", contractorcode="404"),
        dict(RECEIPT, seq=3, serialno=None),
        dict(RECEIPT, seq=4, serialno="C", type="other"),
        dict(BULK, seq=5, quantity=3, contractorcode="404"),
    ]
    out = stock_ledger(state(make), make("receipt_events", *receipts), make("return_events"))
    assert {(r["stock_rid"], r["mat_rid"], r["holder_rid"], int(r["qty"])) for r in out["stock"].collect()} == {(1, None, 11, 1), (3, 1, 11, 1), (5, 2, None, 3)}
    assert {(r["stock_rid"], r["serial_no"]) for r in out["stock_serials"].collect()} == {(1, "A"), (3, None)}


@pytest.mark.parametrize("n_stocks", [2, 12])
def test_shared_serial_takes_one_pass(spark, make, n_stocks):
    """As many jobs for twelve stocks as for two."""
    materials = [dict(mm_rid=i, name=f"m{i}", code="c") for i in range(1, 13)]
    receipts = [dict(RECEIPT, seq=i, serialno="NA", materialname=f"m{i}", materialcode="c") for i in range(1, n_stocks + 1)]
    returns = [dict(seq=100 + i, serialno="NA", type="serialized") for i in range(n_stocks + 1)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"shared-{n_stocks}", "")
    out = stock_ledger(state(make, materials=materials), make("receipt_events", *receipts), make("return_events", *returns))
    moved = [(r["seq"], r["stock_id"]) for r in out["movements"].orderBy("seq").collect()]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert moved == [(i, i) for i in range(1, n_stocks + 1)] + [(99 + i, i) for i in range(1, n_stocks + 1)]
    assert len(tracker.getJobIdsForGroup(f"shared-{n_stocks}")) < 90


def test_effects_are_merged_with_receipts(make, monkeypatch):
    """As many effects as receipts, in files small enough to be broadcast: their join goes by a shuffle."""
    rng = random.Random(6)
    rows, serials = stocks(rng, empty=False)
    ins, outs = random_events(rng, 60)
    inputs = {
        "stock": make("stock", *rows),
        "stock_serials": make("stock_serials", *serials),
        "materials": make("materials", *MATERIALS),
        "contractors": make("contractors", *CONTRACTORS),
    }
    plans = {}

    def noted(rows, name, **options):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return stage(rows, name, **options)

    monkeypatch.setattr("fieldsync.plans.stock.stage", noted)
    out = stock_ledger(inputs, make("receipt_events", *ins), make("return_events", *outs))
    assert "SortMergeJoin" in plans["stock-changes"] and "BroadcastHashJoin" not in plans["stock-changes"]
    joins = [line for line in out["stock_serials"]._jdf.queryExecution().executedPlan().toString().splitlines() if "HashJoin [seq" in line]
    assert not joins
