"""The stock job over a stream of files, killed between its two commits and started again."""

import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from fieldsync.plans.stock import STATE_KEYS
from fieldsync.sources import runlog, state
from fieldsync.streaming import stock as streaming
from tests.fold import Book
from tests.test_stock import CONTRACTORS, MATERIALS, random_events, stocks


def test_killed_and_restarted(spark, make, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows, serials = stocks(rng, False)
    ins, outs = random_events(rng, 40)
    root, inbox, checkpoint = (str(tmp_path / n) for n in ("state", "inbox", "checkpoint"))
    state.start_state(spark, root, {"stock": make("stock", *rows), "stock_serials": make("stock_serials", *serials)}, STATE_KEYS)
    book, declared = Book(rows, serials, MATERIALS, CONTRACTORS), streaming.event_schema()
    for n, part in enumerate((range(1, 21), range(21, 41))):
        events = [dict(e, event="receipt" if "contractorcode" in e else "return") for e in ins + outs if e["seq"] in part]
        other = dict(seq=1000 + n, event="audit", type="serialized", serialno="A1")
        given = spark.createDataFrame([tuple(e.get(c) for c in declared.names) for e in [*events, other]], declared)
        given.coalesce(1).write.parquet(f"{inbox}-{n}")
        os.makedirs(inbox, exist_ok=True)
        for file in (tmp_path / f"inbox-{n}").glob("part-*.parquet"):
            os.link(file, f"{inbox}/{n}.parquet")
            os.utime(f"{inbox}/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
        book.next_base = max(book.stock)
        for event in sorted((e for e in events), key=lambda e: e["seq"]):
            book.receipt(event) if event["event"] == "receipt" else book.give_back(event)

    def start():
        read = spark.readStream.schema(declared).option("maxFilesPerTrigger", 1).parquet(inbox)
        dimensions = lambda _: {"materials": make("materials", *MATERIALS), "contractors": make("contractors", *CONTRACTORS)}
        return streaming.stock_stream(read, root, "stock", dimensions, checkpoint, share=None, availableNow=True)

    whole = streaming.change_stock

    def killed(*args):
        whole(*args)
        raise RuntimeError("killed after the state was changed")

    monkeypatch.setattr(streaming, "change_stock", killed)
    with pytest.raises(StreamingQueryException, match="killed"):
        start().awaitTermination()
    assert runlog.head(spark, f"{root}/_log") == 2
    monkeypatch.setattr(streaming, "change_stock", whole)
    start().awaitTermination()
    assert [e["run_id"] for e in runlog.entries(spark, f"{root}/_log")] == [None, "stock-0", "stock-1"]
    now = state.read_state(spark, root, STATE_KEYS)
    assert {r["stock_rid"]: r["qty"] for r in now["stock"].collect()} == {i: None if s["qty"] is None else Decimal(s["qty"]) for i, s in book.stock.items()}
    held = Counter((r["stock_rid"], r["serial_no"]) for r in now["stock_serials"].collect())
    assert held == Counter((s["stock_rid"], s["serial_no"]) for s in book.serials)
