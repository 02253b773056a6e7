"""Serial and quantity ledger as running values.

Movements of one serial in one stock, and then of one stock, depend on what
went before. Both dependencies can be written as running sums, minima and
maxima, which `operators.running` evaluates for keys of any size. Only returns
of a serial that lies in several stocks need its events walked through in order,
in blocks if there are very many (`operators.locating`).

Kinds of serial movement: `L` always adds a copy, `R` adds one unless there is
one, `T` removes all copies. Kinds of stock movement: `Q` opening quantity,
`R` serialised receipt, `T` effective serialised return, `BR` and `BT` bulk
receipt and return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.operators.keyed import merged_if_many
from fieldsync.operators.locating import located_in_blocks
from fieldsync.operators.running import BLOCK_ROWS, Blocks, Measure, plan_blocks
from fieldsync.sources.staging import stage

_EFFECT = ["cell", "stock_id", "seq", "kind", "delta", "effective"]


def serial_effects(moves: DataFrame, blocks: Blocks) -> DataFrame:
    """Change in copies for every movement of (cell, stock_id, seq, kind).

    The returns cut the movements of a serial into spans that each start with
    no copy. Within a span there are as many copies as `L` rows, plus one if an
    `R` row came first of all.
    """
    is_return = F.when(F.col("kind") == "T", 1).otherwise(0)
    spans = blocks.running(moves, {"span": Measure("sum", is_return)}, also_by=("stock_id",), before=True)
    spans = spans.withColumn("span", F.coalesce("span", F.lit(0)))
    if blocks.huge is not None:
        spans = stage(spans, "serial-spans")
    seen = blocks.running(
        spans,
        {
            "n_always": Measure("sum", F.when(F.col("kind") == "L", 1).otherwise(0)),
            "first_always": Measure("min", F.when(F.col("kind") == "L", F.col("seq"))),
            "first_once": Measure("min", F.when(F.col("kind") == "R", F.col("seq"))),
        },
        also_by=("stock_id", "span"),
        before=True,
    )
    once_came_first = F.col("first_once").isNotNull() & (
        F.col("first_always").isNull() | (F.col("first_once") < F.col("first_always"))
    )
    copies = F.coalesce("n_always", F.lit(0)) + F.when(once_came_first, 1).otherwise(0)
    delta = (
        F.when(F.col("kind") == "L", F.lit(1))
        .when(F.col("kind") == "T", -copies)
        .otherwise(F.when(copies == 0, 1).otherwise(0))
    )
    return seen.withColumn("delta", delta.cast("long")).select(
        "cell", "stock_id", "seq", "kind", "delta", ((F.col("kind") == "T") & (F.col("delta") < 0)).alias("effective")
    )


def fold_serials(
    inserts: DataFrame, returns: DataFrame, inert: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Effects of the inserts and of the returns, which name a serial but no stock.

    A return goes to the lowest stock that holds the serial at that time. For
    a serial that lies in one stock, as it should, that is a running value. The
    events of a serial that has been in several stocks are walked through in
    order, with the copies per stock as state: one pass over sorted rows,
    however many stocks there are, that holds the state of one serial only.
    Such a serial with more events than a block has its returns located in
    blocks; its copies are running values, too.

    `inert` (cell, inert_id, inert_seq) names the lowest holder that never gives
    the serial back: returns after `inert_seq` get no further than to it.
    """
    named = inserts.select("cell", "seq").unionByName(returns.select("cell", "seq"))
    blocks = plan_blocks(named, ["cell"], "seq", block_rows)
    holders = stage(
        inserts.groupBy("cell", "stock_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n_stocks"), F.min("stock_id").alias("stock_id"))
        .join(returns.select("cell").distinct().hint("merge"), "cell", "left_semi"),
        "serial-holders",
    )
    asked = returns.join(merged_if_many(inert), "cell", "left").select("cell", "seq", "inert_id", "inert_seq")
    one = asked.join(merged_if_many(holders.where("n_stocks = 1").select("cell", "stock_id")), "cell")
    stuck = (F.col("inert_seq") < F.col("seq")) & (F.col("inert_id") < F.col("stock_id"))
    reaching = one.where(~F.coalesce(stuck, F.lit(False))).select("cell", "stock_id", "seq", F.lit("T").alias("kind"))

    shared = holders.where("n_stocks > 1").select("cell")
    several = merged_if_many(shared)
    added = inserts.select("cell", "stock_id", "seq", "kind")
    if several.isEmpty():
        return serial_effects(added.unionByName(reaching), blocks).select(*_EFFECT)
    rest = added.join(several, "cell", "left_anti").unionByName(reaching)
    if blocks.huge is not None:
        hot = stage(holders.where("n_stocks > 1").join(blocks.huge, "cell", "left_semi").select("cell", "n_stocks"), "hot-serials")
        given_back = located_in_blocks(_to_locate(added, asked, hot.select("cell")), hot, blocks)
        rest = rest.unionByName(added.join(hot, "cell", "left_semi")).unionByName(
            given_back.withColumn("kind", F.lit("T"))
        )
        several = merged_if_many(shared.join(hot, "cell", "left_anti"))
    walked = located(_to_locate(added, asked, several))
    return serial_effects(rest, blocks).select(*_EFFECT).unionByName(walked)


def _to_locate(added: DataFrame, asked: DataFrame, cells: DataFrame) -> DataFrame:
    """Receipts and returns of the cells, as `located` takes them."""
    nothing = F.lit(None).cast("long")
    return (
        added.join(cells, "cell", "left_semi")
        .withColumns({"inert_id": nothing, "inert_seq": nothing})
        .unionByName(asked.join(cells, "cell", "left_semi").withColumns({"stock_id": nothing, "kind": F.lit("T")}))
    )


def located(moves: DataFrame) -> DataFrame:
    """Effects of (cell, stock_id, seq, kind, inert_id, inert_seq) whose returns name no stock."""
    names = ["cell", "stock_id", "seq", "kind", "delta", "effective"]

    def walk(batches):
        import heapq

        import pyarrow as pa

        cell, copies, lowest = None, {}, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "stock_id", "seq", "kind", "inert_id", "inert_seq")]
            out = []
            for this, stock, seq, kind, inert_id, inert_seq in zip(*columns, strict=True):
                if this != cell:
                    cell, copies, lowest = this, {}, []
                if kind != "T":
                    held = copies.get(stock, 0)
                    delta = 1 if kind == "L" or not held else 0
                    if not held:
                        heapq.heappush(lowest, stock)
                    copies[stock] = held + delta
                    out.append((cell, stock, seq, kind, delta, False))
                elif lowest and not (inert_id is not None and inert_seq < seq and inert_id < lowest[0]):
                    stock = heapq.heappop(lowest)
                    out.append((cell, stock, seq, kind, -copies.pop(stock), True))
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    in_order = moves.select("cell", F.col("stock_id").cast("long"), F.col("seq").cast("long"), "kind", F.col("inert_id").cast("long"), F.col("inert_seq").cast("long"))
    in_order = in_order.repartition("cell").sortWithinPartitions("cell", "seq")
    return in_order.mapInArrow(walk, "cell string, stock_id long, seq long, kind string, delta long, effective boolean")


def fold_quantities(
    moves: DataFrame, block_rows: int = BLOCK_ROWS, layout: DataFrame | None = None
) -> DataFrame:
    """Serial count and quantity of the stock after every (stock_id, seq, kind, delta, quantity).

    A serialised receipt adds the whole count, not one. An effective return
    sets the quantity to the count. A bulk movement without quantity makes it
    unknown; receipts start again from zero, bulk returns leave it unknown.
    `layout` may give the same stocks and order at less cost, to look for huge
    stocks in.
    """
    blocks = plan_blocks(moves if layout is None else layout, ["stock_id"], "seq", block_rows)
    kind, amount = F.col("kind"), F.col("quantity")
    bulk_unknown = kind.isin("BR", "BT") & amount.isNull()
    unknown = bulk_unknown | ((kind == "Q") & amount.isNull())
    known = kind.isin("R", "T") | (kind.isin("BR", "Q") & amount.isNotNull())
    # The latest row that settles it says whether the quantity is known.
    settles = F.when(known, F.col("seq") * 2 + 1).when(unknown, F.col("seq") * 2)
    counted = blocks.running(
        moves,
        {
            "count_after": Measure("sum", F.col("delta")),
            "part": Measure("sum", F.when((kind == "T") | bulk_unknown, 1).otherwise(0)),
            "settled": Measure("max", settles),
        },
    )
    is_known = F.coalesce(F.col("settled") % 2 == 1, F.lit(False))
    change = (
        F.when(kind.isin("R", "T"), F.col("count_after").cast("decimal(28,4)"))
        .when(kind.isin("BR", "Q"), amount)
        .when((kind == "BT") & is_known, -amount)
    )
    changes = counted.withColumn("change", F.coalesce(change.cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)")))
    changes = changes.withColumn("is_known", is_known)
    if blocks.huge is not None:
        changes = stage(changes, "quantity-changes")
    summed = blocks.running(changes, {"total": Measure("sum", F.col("change"))}, also_by=("part",))
    return summed.select(
        "stock_id",
        "seq",
        "kind",
        "count_after",
        F.when(F.col("is_known"), F.col("total")).cast("decimal(38,4)").alias("qty_after"),
    )


def closing(movements: DataFrame) -> DataFrame:
    """Count and quantity of each stock after its last movement."""
    return movements.groupBy("stock_id").agg(
        F.max_by("count_after", "seq").alias("serials"), F.max_by("qty_after", "seq").alias("qty")
    )


def counted_balance(effects: DataFrame, bulk: DataFrame) -> DataFrame:
    """The plain balance: serials held, each once, plus bulk in minus bulk out.

    `bulk` has (stock_id, amount) with the sign of the movement.
    """
    held = (
        effects.groupBy("stock_id", "cell")
        .agg(F.sum("delta").alias("copies"))
        .groupBy("stock_id")
        .agg(F.count(F.when(F.col("copies") > 0, 1)).alias("serials"))
    )
    net = bulk.groupBy("stock_id").agg(F.sum("amount").alias("bulk"))
    zero = F.lit(0)
    both = held.join(net, "stock_id", "full")
    return both.select(
        "stock_id",
        F.coalesce("serials", zero).cast("long").alias("serials"),
        (F.coalesce("serials", zero) + F.coalesce("bulk", zero)).cast("decimal(38,4)").alias("qty"),
    )
