"""Which stock a return takes its serial from, when one serial has very many events.

A return takes the serial from the lowest stock that holds it. What a stock holds depends on all events
before, so the events of a serial are walked through in order; a serial with more events than a block may
have is walked through in blocks, all at once:

1. Each block is walked as if no stock held the serial before it. That gives every return a first answer.
2. What stocks hold before a block changes few of its answers. Seen from one stock, in the order of ids, the
   returns that get past all lower stocks are those of the first answer without a prefix: a stock that holds
   the serial takes the first return that gets to it, and one more return is gone for the stocks above. So one
   pass over the stocks of a block, lowest first, with the time up to which returns are gone, gives the block's
   corrections, at most one for each stock, and what stocks hold after it. This pass goes from block to block,
   and reads a summary of the block: its stocks, and of the returns with the same answer the first ones only,
   as many as the serial has stocks.
3. Answers and corrections are joined by the return's place in its block, as returns may share a `seq`.

No task reads all events of a serial. Stocks that hold a serial and never give it back (`inert`) end the
search of every return that gets to them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.operators.running import Blocks
from fieldsync.sources.staging import stage

_ANSWER = "cell string, _block long, at long, seq long, stock_id long, stuck boolean, nth long"
_CORRECTION = "cell string, _block long, at long, stock_id long"


def _first_answers(batches: Iterator) -> Iterator:
    """Per block, each return with the lowest stock that holds the serial by events of this block alone.

    `at` counts the returns of the block, `nth` those with the same answer.
    """
    import heapq

    import pyarrow as pa

    block, held, lowest, answered, at = None, set(), [], {}, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "_block", "seq", "stock_id", "inert_id", "inert_seq")]
        out = []
        for cell, number, seq, stock, inert_id, inert_seq in zip(*columns, strict=True):
            if (cell, number) != block:
                block, held, lowest, answered, at = (cell, number), set(), [], {}, 0
            if stock is not None:
                if stock not in held:
                    held.add(stock)
                    heapq.heappush(lowest, stock)
                continue
            stuck = inert_id is not None and inert_seq < seq and not (lowest and lowest[0] < inert_id)
            answer = inert_id if stuck else None
            if lowest and not stuck:
                answer = heapq.heappop(lowest)
                held.discard(answer)
            answered[answer] = answered.get(answer, 0) + 1
            at += 1
            out.append((cell, number, at, seq, answer, stuck, answered[answer]))
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        names = ["cell", "_block", "at", "seq", "stock_id", "stuck", "nth"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)


def corrections(before: set[int], stocks: dict[int, tuple[int, bool]], returns: list[tuple[int, float]]) -> tuple[dict[int, int], set[int]]:
    """A block's corrected returns, and the stocks that hold the serial after it.

    `stocks` has each stock's first receipt in the block and whether it holds the serial at the end by events
    of the block alone, `returns` the first answers in the order of events (infinite for none).
    """
    corrected, after, at = {}, set(), 0
    for stock in sorted(before | stocks.keys()):
        first, at_end = stocks.get(stock, (None, False))
        while at < len(returns) and returns[at][1] < stock:
            at += 1
        if at == len(returns):  # no return gets here: what has come stays
            after.add(stock)
            continue
        seq = returns[at][0]
        if stock in before or first < seq:
            corrected[seq] = stock
            at += 1
        if at_end:
            after.add(stock)
    return corrected, after


def _hand_on(batches: Iterator) -> Iterator:
    """Corrections of all blocks of a serial, from its first block to its last."""
    import math

    import pyarrow as pa

    def settled(block, held, stocks, returns):
        corrected, after = corrections(held, stocks, sorted(returns))
        rows = [(*block, at, stock) for (_, at), stock in corrected.items()]
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=["cell", "_block", "at", "stock_id"]), after

    block, held, stocks, returns = None, set(), {}, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "_block", "stock_id", "first", "at_end", "seq", "at")]
        for cell, number, stock, first, at_end, seq, at in zip(*columns, strict=True):
            if (cell, number) != block:
                if block is not None:
                    rows, held = settled(block, held, stocks, returns)
                    yield rows
                    held = held if block[0] == cell else set()
                block, stocks, returns = (cell, number), {}, []
            if seq is None:
                stocks[stock] = ((first, math.inf), at_end)
            else:
                returns.append(((seq, at), math.inf if stock is None else stock))
    if block is not None:
        yield settled(block, held, stocks, returns)[0]


def located_in_blocks(moves: DataFrame, n_stocks: DataFrame, blocks: Blocks) -> DataFrame:
    """Returns that take a serial from a stock, as (cell, stock_id, seq).

    `moves` has the receipts (cell, stock_id, seq) and returns (stock_id NULL, with inert_id and inert_seq) of
    huge serials only, `n_stocks` (cell, n_stocks) how many stocks hold each at any time.
    """
    _, cut = blocks.cut(moves.select("cell", *[F.col(c).cast("long").alias(c) for c in ("seq", "stock_id", "inert_id", "inert_seq")]))
    in_order = cut.repartition("cell", "_block").sortWithinPartitions("cell", "_block", "seq")
    answers = stage(in_order.mapInArrow(_first_answers, _ANSWER), "first-answers")

    by = ["cell", "_block", "stock_id"]
    come = cut.where(F.col("stock_id").isNotNull()).groupBy(*by).agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    gone = answers.where(~F.col("stuck")).groupBy(*by).agg(F.max("seq").alias("gone"))
    at_end = F.col("gone").isNull() | (F.col("gone") < F.col("last"))
    no_number = F.lit(None).cast("long")
    stocks = come.join(gone.hint("merge"), by, "left").select(*by, "first", at_end.alias("at_end"), no_number.alias("seq"), no_number.alias("at"))
    few = answers.join(n_stocks, "cell").where(F.col("nth") <= F.col("n_stocks"))
    returns = few.select(*by, no_number.alias("first"), F.lit(None).cast("boolean").alias("at_end"), "seq", "at")
    summary = stocks.unionByName(returns).repartition("cell").sortWithinPartitions("cell", "_block")
    corrected = summary.mapInArrow(_hand_on, _CORRECTION).withColumnRenamed("stock_id", "corrected")

    stock = F.coalesce("corrected", F.when(~F.col("stuck"), F.col("stock_id")))
    found = answers.join(corrected.hint("merge"), ["cell", "_block", "at"], "left").select("cell", stock.alias("stock_id"), "seq")
    return found.where(F.col("stock_id").isNotNull())
