import math
import random

import pytest

from fieldsync.operators import keyed, ledger, locating, running
from fieldsync.operators.ledger import fold_serials
from fieldsync.operators.locating import corrections
from fieldsync.operators.running import plan_blocks
from fieldsync.sources.staging import stage

EFFECT = ["cell", "stock_id", "seq", "kind", "delta", "effective"]


def walked(events, held):
    """(seq, stock) of the returns that find a stock, and what is held after, by one walk over (seq, stock or None)."""
    held, found = set(held), []
    for seq, stock in events:
        if stock is not None:
            held.add(stock)
        elif held:
            found.append((seq, min(held)))
            held.remove(min(held))
    return found, held


def summary(events, n_stocks):
    """What the pass from block to block reads of a block, and the first answers."""
    answers, _ = walked(events, set())
    by_seq, nth, few = dict(answers), {}, []
    stocks = {}
    for seq, stock in events:
        if stock is None:
            answer = by_seq.get(seq, math.inf)
            nth[answer] = nth.get(answer, 0) + 1
            if nth[answer] <= n_stocks:
                few.append((seq, answer))
        elif stock not in stocks:
            stocks[stock] = seq
    _, end = walked(events, set())
    return {s: (first, s in end) for s, first in stocks.items()}, few, by_seq


@pytest.mark.parametrize("n_stocks", [1, 2, 5, 9])
def test_corrections_equal_a_walk(n_stocks):
    """For any events and anything held before: the same returns take from the same stocks, the same stocks hold after."""
    rng = random.Random(n_stocks)
    for _ in range(3000):
        share = rng.choice([0.2, 0.5, 0.8])
        events = [(i, None if rng.random() < share else rng.randrange(n_stocks)) for i in range(1, rng.randint(1, 30))]
        before = {s for s in range(n_stocks) if rng.random() < rng.choice([0.1, 0.5, 0.9])}
        stocks, few, answers = summary(events, n_stocks)
        corrected, after = corrections(before, stocks, few)
        found, held = walked(events, before)
        assert sorted({**answers, **corrected}.items()) == found
        assert after == held
        assert len(corrected) <= len(before | stocks.keys())


def random_moves(seed, n_events, n_stocks):
    """One serial with most events, some others; old copies (`L`), and stocks that never give back."""
    rng = random.Random(seed)
    inserts, returns = [], []
    for seq in range(1, n_events + 1):
        cell = "HOT" if rng.random() < 0.8 else rng.choice(["A", "B", "C"])
        if rng.random() < 0.5:
            inserts.append((cell, rng.randint(1, n_stocks), seq, rng.choice("RRL")))
        else:
            returns.append((cell, seq))
    opening = [(c, s, 0, "L") for c in ("HOT", "A") for s in rng.sample(range(1, n_stocks + 1), n_stocks // 2)]
    return opening + inserts, returns


def plain(inserts, returns, inert):
    copies, out = {}, set()
    events = [(s, c, i, k) for c, i, s, k in inserts] + [(s, c, None, "T") for c, s in returns]
    for seq, cell, stock, kind in sorted(events, key=lambda e: e[0]):
        held = copies.setdefault(cell, {})
        if kind != "T":
            delta = 1 if kind == "L" or not held.get(stock) else 0
            held[stock] = held.get(stock, 0) + delta
            out.add((cell, stock, seq, kind, delta, False))
        elif held:
            lowest = min(held)
            end = inert.get(cell)
            if end is None or not (end[1] < seq and end[0] < lowest):
                out.add((cell, lowest, seq, "T", -held.pop(lowest), True))
    return out


@pytest.mark.parametrize("seed,n_stocks,inert", [(1, 3, {}), (2, 12, {}), (3, 8, {"HOT": (4, 150), "A": (2, 0)}), (4, 6, {"HOT": (1, 90)})])
def test_blocks_equal_one_walk(spark, seed, n_stocks, inert):
    n = 600
    inserts, returns = random_moves(seed, n, n_stocks)
    inserts = [(c, 2 * s, q, k) for c, s, q, k in inserts]  # inert stocks have ids of their own
    inert = {c: (2 * s - 1, q) for c, (s, q) in inert.items()}
    frames = (
        spark.createDataFrame(inserts, "cell string, stock_id long, seq long, kind string"),
        spark.createDataFrame(returns, "cell string, seq long"),
        spark.createDataFrame([(c, i, s) for c, (i, s) in inert.items()], "cell string, inert_id long, inert_seq long"),
    )
    wanted = plain(inserts, returns, inert)
    for block_rows in (10**6, 40):
        rows = [tuple(r) for r in fold_serials(*frames, block_rows=block_rows).select(*EFFECT).collect()]
        got = {r for r in rows if r[3] != "T" or r[5]}
        assert got == wanted and len(got) == len([r for r in rows if r[3] != "T" or r[5]])


def test_many_blocks_in_few_partitions(spark):
    """Blocks of a few events each, several to a partition, equal one walk."""
    inserts, returns = random_moves(7, 900, 5)
    frames = (
        spark.createDataFrame(inserts, "cell string, stock_id long, seq long, kind string"),
        spark.createDataFrame(returns, "cell string, seq long"),
        spark.createDataFrame([], "cell string, inert_id long, inert_seq long"),
    )
    named = frames[0].select("cell", "seq").unionByName(frames[1].select("cell", "seq"))
    assert plan_blocks(named, ["cell"], "seq", 20).partitions <= spark.sparkContext.defaultParallelism
    rows = [tuple(r) for r in fold_serials(*frames, block_rows=20).select(*EFFECT).collect()]
    got = [r for r in rows if r[3] != "T" or r[5]]
    assert len(got) == len(set(got)) and set(got) == plain(inserts, returns, {})


def test_no_returns_or_no_receipts_of_a_huge_serial(spark):
    receipts = [("HOT", 1 + i % 3, i, "R") for i in range(1, 201)]
    frame = spark.createDataFrame(receipts, "cell string, stock_id long, seq long, kind string")
    none = spark.createDataFrame([], "cell string, seq long")
    inert = spark.createDataFrame([], "cell string, inert_id long, inert_seq long")
    assert fold_serials(frame, none, inert, block_rows=40).where("delta = 1").count() == 3
    asked = spark.createDataFrame([("HOT", i) for i in range(1, 201)], "cell string, seq long")
    assert fold_serials(frame.limit(0), asked, inert, block_rows=40).where("effective").count() == 0


def test_many_serials_are_not_broadcast(spark, monkeypatch):
    """Serials, spans and blocks may be as many as events: joins with them are merged, and give the same rows."""
    plans = []

    def noted(rows, name, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stage(rows, name, **options)

    for module in (ledger, locating, running):
        monkeypatch.setattr(module, "stage", noted)
    monkeypatch.setattr(keyed, "FEW_ROWS", 1)
    inserts, returns = random_moves(11, 500, 6)
    empty = [("A", 100, 50), ("B", 0, 0)]
    frames = (
        stage(spark.createDataFrame(inserts, "cell string, stock_id long, seq long, kind string"), "inserts"),
        stage(spark.createDataFrame(returns, "cell string, seq long"), "returns"),
        stage(spark.createDataFrame(empty, "cell string, inert_id long, inert_seq long"), "inert"),
    )
    out = fold_serials(*frames, block_rows=100)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    joins = [line for plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line]
    # Huge serials alone are few: they are broadcast to pick their events, or to be left out.
    assert not [line for line in joins if "LeftOuter" in line]
    rows = [tuple(r) for r in out.select(*EFFECT).collect()]
    got = [r for r in rows if r[3] != "T" or r[5]]
    assert len(got) == len(set(got)) and set(got) == plain(inserts, returns, {c: (i, s) for c, i, s in empty})


def test_returns_that_share_a_seq(spark):
    """Where blocks begin makes no difference, also if returns come twice with the same `seq`."""
    inserts, returns = random_moves(13, 600, 9)
    frames = (
        spark.createDataFrame(inserts, "cell string, stock_id long, seq long, kind string"),
        spark.createDataFrame([r for r in returns for _ in range(2)], "cell string, seq long"),
        spark.createDataFrame([], "cell string, inert_id long, inert_seq long"),
    )
    taken = plain(inserts, [r for r in returns for _ in range(2)], {})
    wanted = {(r[0], r[1], r[2]) for r in taken if r[5]}
    for block_rows in (10**6, 60, 25):
        out = fold_serials(*frames, block_rows=block_rows).where("effective")
        assert {(r["cell"], r["stock_id"], r["seq"]) for r in out.collect()} == wanted
