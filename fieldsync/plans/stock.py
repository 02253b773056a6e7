"""Receipts and returns: stock state, document logs and device attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsync.config import BULK, DEVICE_ATTRIBUTES, SERIALISED, StockConfig
from fieldsync.functions import documents as doc
from fieldsync.functions.text import QUANTITY, out_of_range, quantity
from fieldsync.operators.keyed import absent, first_orders, highest, lowest_id
from fieldsync.operators.ledger import closing, counted_balance, fold_quantities, fold_serials
from fieldsync.operators.running import BLOCK_ROWS
from fieldsync.operators.scd import replace_current
from fieldsync.sources.staging import stage
from fieldsync.sources.state import COMPACT_AT, Change, change_state

Inputs = dict[str, DataFrame]

#: What the rows of the stock state are changed by.
STATE_KEYS = {"stock": ("stock_rid",), "stock_serials": ("stock_rid", "serial_no")}

TOO_MUCH = "quantity out of range"


def check_receipts(receipts: DataFrame) -> DataFrame:
    """Add `reject_reason`: what makes a receipt fail as a whole."""
    file = F.col("factoryfile")
    holds_file = (F.col("type") == SERIALISED) & file.isNotNull() & (file != "")
    logged = F.col("type").isin(SERIALISED, BULK)
    return receipts.withColumn(
        "reject_reason",
        F.when(holds_file & ~doc.is_json(file), F.lit("attribute document does not parse"))
        .when(
            logged & F.col("crvdate").isNotNull() & F.col("crvdate").try_cast("date").isNull(), F.lit("bad date")
        )
        .when(
            logged & F.col("contractorcode").isNotNull() & F.col("contractorcode").try_cast("int").isNull(),
            F.lit("contractor code is not a number"),
        ),
    )


def check_returns(returns: DataFrame) -> DataFrame:
    bad_date = F.col("cridate").isNotNull() & F.col("cridate").try_cast("date").isNull()
    return returns.withColumn(
        "reject_reason",
        F.when(F.col("type").isin(SERIALISED, BULK) & bad_date, F.lit("bad date")).when(
            (F.col("type") == BULK) & out_of_range(F.col("quantity")), F.lit(TOO_MUCH)
        ),
    )


def receipt_log_delta(receipts: DataFrame, log: DataFrame) -> DataFrame:
    """Receipts that are logged, with `seq`. A document is logged once per serial or per material.

    The log keeps serials in upper case and is asked with the serial as it
    came: a serial that is not in upper case is never found, so it is logged
    each time, and it makes a later upper-case one known.
    """
    # Which rows are logged is settled on the staged keys alone; the rows are fetched by `seq`.
    narrow = receipts.where(F.col("type").isin(SERIALISED, BULK)).select(
        "seq",
        "serialno",
        F.upper("serialno").alias("upper_serial"),
        F.col("doc_number").alias("documentnumber"),
        "materialcode",
        "type",
    )
    keys = stage(narrow, "receipt-keys")
    known = log.where(F.col("serialno").isNotNull())
    serial = stage(absent(keys.where(F.col("type") == SERIALISED), known, ["serialno", "documentnumber"]), "receipt-serials")
    # An exact serial is logged if it comes first of its document; any other one always is.
    exact = F.coalesce(F.col("serialno") == F.col("upper_serial"), F.lit(False))
    always = serial.where(~exact).select("seq")
    first = first_orders(serial, ["upper_serial", "documentnumber"], "seq")

    bulk_keys = ["documentnumber", "materialcode", "type"]
    bulk = first_orders(absent(keys.where(F.col("type") == BULK), log, bulk_keys), bulk_keys, "seq")

    kept = receipts.join(always.unionByName(first).unionByName(bulk), "seq", "left_semi")
    return kept.select(
        "seq",
        F.col("doc_number").alias("documentnumber"),
        F.col("crvdate").cast("date").alias("crvdate"),
        "remarks",
        "warehousecode",
        F.col("contractorcode").cast("int").alias("contractorcode"),
        "divisioncode",
        "materialname",
        "materialcode",
        "uom",
        "stockcondition",
        "quantity",
        F.upper("serialno").alias("serialno"),
        "type",
        F.lit("CRV").alias("wh_activity"),
    )


def return_log_delta(returns: DataFrame, log: DataFrame) -> DataFrame:
    """Returns that are logged, with `seq`. Serials and dates stay as they came."""
    named = returns.withColumn("serial_num", F.col("serialno")).withColumn("doc_num", F.col("doc_number"))

    def once(kind: str, keys: list[str]) -> DataFrame:
        return first_orders(absent(named.where(F.col("type") == kind).select("seq", *keys), log, keys), keys, "seq")

    kept = named.join(
        once(SERIALISED, ["serial_num", "doc_num"]).unionByName(once(BULK, ["doc_num", "materialcode", "type"])),
        "seq",
        "left_semi",
    )
    return kept.select(
        "seq",
        "doc_num",
        F.col("cridate").cast("date").cast("string").alias("cridate"),
        "remarks",
        "fromcontractorcode",
        "materialname",
        "materialcode",
        "uom",
        F.col("stockcondition").alias("stock_condition"),
        "quantity",
        "serial_num",
        "type",
        F.lit("CRI").alias("wh_activity"),
    )


def attribute_columns(document: str) -> list:
    """The declared attributes of a device document; all NULL for an empty one."""
    fields = ",".join(f"`{name}`:string" for name in DEVICE_ATTRIBUTES)
    text = F.col(document)
    parsed = F.from_json(F.when(doc.is_object(text), doc.as_written(text)), f"struct<{fields}>", doc.STRICT)
    return [doc.written(parsed[name], doc.is_marked(text)).alias(column) for name, column in DEVICE_ATTRIBUTES.items()]


def device_attributes_replace(
    current: DataFrame, receipts: DataFrame, logged: DataFrame, cfg: StockConfig = StockConfig()
) -> dict[str, DataFrame]:
    """Newly logged serialised receipts replace the attributes of their device.

    `logged` is read more than once, so it should be a staged table.
    """
    fresh = receipts.where(F.col("type") == SERIALISED).join(logged.select("seq"), "seq", "left_semi")
    events = fresh.select(
        "seq",
        F.upper("serialno").alias("serial_number"),
        *attribute_columns("factoryfile"),
        F.lit(cfg.labels.attribute_source).alias("type_source"),
    )
    # Documents are parsed once, for what stays current and for what becomes history.
    events = stage(events, "device-events")
    return replace_current(current, events, "serial_number", "seq", [*DEVICE_ATTRIBUTES.values(), "type_source"])


def _movements(receipts: DataFrame, returns: DataFrame) -> DataFrame:
    """Both kinds of event as rows of the same few columns, with the reason why one is rejected."""
    serial = F.col("type") == SERIALISED
    columns = ["seq", "materialname", "materialcode", "vendor_code", "quantity", "serialno", "kind", "reject_reason"]
    received = (
        check_receipts(receipts.where(F.col("type").isin(SERIALISED, BULK)))
        .withColumn("vendor_code", F.col("contractorcode"))
        .withColumn("kind", F.when(serial, "R").otherwise("BR"))
    )
    given_back = (
        check_returns(returns.where(F.col("type").isin(SERIALISED, BULK)))
        .withColumn("vendor_code", F.col("fromcontractorcode"))
        .withColumn("kind", F.when(serial, "T").otherwise("BT"))
    )
    return received.select(*columns).unionByName(given_back.select(*columns))


def _resolve(inputs: Inputs, moves: DataFrame, cfg: StockConfig) -> DataFrame:
    """Movements that name a stock by material and contractor, with the id of that stock.

    A receipt makes the stock that is missing. When material or contractor is
    unknown nothing can be found again by them, so each such receipt makes a
    stock of its own (`alone`).
    """
    named = ["materialname", "materialcode", "vendor_code"]
    moves = moves.where(F.col("kind") != "T")
    materials = lowest_id(inputs["materials"], ["name", "code"], "mm_rid").select(
        F.col("name").alias("materialname"), F.col("code").alias("materialcode"), F.col("mm_rid").alias("mat_rid")
    )
    contractors = lowest_id(inputs["contractors"], ["vendor_code"], "contact_rid").withColumnRenamed(
        "contact_rid", "holder_rid"
    )
    stocks = lowest_id(
        inputs["stock"].where(F.col("stock_condition_index") == cfg.condition), ["mat_rid", "holder_rid"], "stock_rid"
    )
    # Looked up once per combination of names, not once per movement.
    found = stage(
        moves.groupBy(*named)
        .agg(F.min(F.when(F.col("kind") != "BT", F.col("seq"))).alias("received_seq"))
        .join(materials, ["materialname", "materialcode"], "left")
        .join(contractors, "vendor_code", "left")
        .join(stocks, ["mat_rid", "holder_rid"], "left"),
        "stock-names",
    )
    both = F.col("mat_rid").isNotNull() & F.col("holder_rid").isNotNull()
    made = (
        found.where(F.col("stock_rid").isNull() & both)
        .groupBy("mat_rid", "holder_rid")
        .agg(F.min("received_seq").alias("made_seq"))
    )
    ids = found.join(made, ["mat_rid", "holder_rid"], "left").drop("received_seq")
    for name in named:
        ids = ids.withColumnRenamed(name, f"_{name}")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in named]

    start = F.lit(highest(inputs["stock"], "stock_rid")).cast("long")
    alone = F.col("stock_rid").isNull() & ~both
    resolved = moves.join(ids, same, "left").select(
        "seq",
        "kind",
        "mat_rid",
        "holder_rid",
        F.col("serialno").alias("serial"),
        F.upper("serialno").alias("upper_serial"),
        quantity(F.col("quantity")).alias("quantity"),
        alone.alias("alone"),
        (F.col("stock_rid").isNull()).alias("is_new"),
        F.when(alone, start + F.col("seq")).otherwise(F.coalesce("stock_rid", start + F.col("made_seq"))).alias("stock_id"),
        "made_seq",
    )
    # The receipt that makes its stock may bring any quantity, one that adds to a stock may not.
    makes = F.col("alone") | (F.col("is_new") & (F.col("made_seq") == F.col("seq")))
    too_much = (F.col("kind") == "BR") & out_of_range(F.col("quantity")) & ~F.coalesce(makes, F.lit(False))
    resolved = resolved.withColumn("too_much", F.coalesce(too_much, F.lit(False)))
    exists = (F.col("kind") != "BT") | (
        ~F.col("alone") & F.col("stock_id").isNotNull() & (~F.col("is_new") | (F.col("made_seq") < F.col("seq")))
    )
    has_holder = (F.col("kind") != "R") | F.col("holder_rid").isNotNull()
    return resolved.where(exists & has_holder).drop("made_seq")


def _serial_effects(
    inputs: Inputs, moves: DataFrame, resolved: DataFrame, cfg: StockConfig, block_rows: int
) -> DataFrame:
    """What every serialised receipt and return does to the serials of which stock."""
    asked = moves.where((F.col("kind") == "T") & F.col("serialno").isNotNull()).select(
        F.col("serialno").alias("cell"), "seq"
    )
    received = resolved.where((F.col("kind") == "R") & F.col("serial").isNotNull())
    inserts = received.where(~F.col("alone")).select(
        F.col("upper_serial").alias("cell"),
        "stock_id",
        "seq",
        F.when(F.col("serial") == F.col("upper_serial"), "R").otherwise("L").alias("kind"),
        "serial",
    )

    # Of the serials on hand only those that a movement names take part.
    named = asked.select("cell").unionByName(inserts.select("cell")).unionByName(inserts.select(F.col("serial").alias("cell")))
    usable = inputs["stock"].where(F.col("stock_condition_index") == cfg.condition).select("stock_rid")
    on_hand = (
        inputs["stock_serials"]
        .where(F.col("serial_no").isNotNull())
        .select("stock_rid", F.col("serial_no").alias("cell"))
        .join(named.distinct().hint("merge"), "cell", "left_semi")
    )
    opening = on_hand.join(usable, "stock_rid", "left_semi").select(
        "cell",
        F.col("stock_rid").alias("stock_id"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("L").alias("kind"),
        F.lit(None).cast("string").alias("serial"),
    )
    moves_in = stage(inserts.unionByName(opening), "serial-inserts")
    fixed = on_hand.join(usable, "stock_rid", "left_anti").select(
        "cell", F.col("stock_rid").alias("inert_id"), F.lit(0).cast("long").alias("inert_seq")
    )
    on_their_own = received.where(F.col("alone")).select(
        F.col("upper_serial").alias("cell"), F.col("stock_id").alias("inert_id"), F.col("seq").alias("inert_seq")
    )
    inert = stage(
        fixed.unionByName(on_their_own)
        .groupBy("cell")
        .agg(F.min(F.struct("inert_id", "inert_seq")).alias("_inert"))
        .select("cell", "_inert.*"),
        "inert-serials",
    )

    # Old serials that are not in upper case: a receipt that names one exactly adds nothing.
    is_old = (F.col("seq") == 0) & (F.col("cell") != F.upper("cell"))
    old = moves_in.where(is_old).drop("serial")
    if old.isEmpty():
        return fold_serials(moves_in.drop("serial"), asked, inert, block_rows)

    old_cells = old.select("cell").distinct()
    old_effects = stage(fold_serials(old, asked.join(old_cells, "cell", "left_semi"), inert, block_rows), "old-serials")
    gone = old_effects.where("effective").groupBy("stock_id", "cell").agg(F.min("seq").alias("gone_seq"))
    held = (
        old.select("stock_id", "cell")
        .distinct()
        .join(gone, ["stock_id", "cell"], "left")
        .withColumnRenamed("cell", "serial")
        .withColumn("held", F.lit(True))
    )
    still = F.col("held") & (F.col("gone_seq").isNull() | (F.col("gone_seq") > F.col("seq")))
    adding = (
        moves_in.where(~is_old)
        .join(held, ["stock_id", "serial"], "left")
        .where(~F.coalesce(still, F.lit(False)))
        .select("cell", "stock_id", "seq", "kind")
    )
    effects = fold_serials(
        stage(adding, "serial-inserts"), asked.join(old_cells, "cell", "left_anti"), inert, block_rows
    )
    return effects.unionByName(old_effects)


def stock_ledger(
    inputs: Inputs,
    receipts: DataFrame,
    returns: DataFrame,
    cfg: StockConfig = StockConfig(),
    block_rows: int = BLOCK_ROWS,
) -> dict[str, DataFrame]:
    """Fold a batch of receipts and returns, ordered by `seq`, into the stock state.

    Gives the new `stock` and `stock_serials` snapshots, the `changes` that lead to them, every movement with
    the quantity after it, the plain `balance`, and the rejected events.
    """
    # The events, which may be wide, are read and checked once; all else works on a few columns.
    checked = stage(_movements(receipts, returns), "stock-events")
    rejected = checked.where(F.col("reject_reason").isNotNull()).select("seq", "reject_reason")
    moves = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")

    settled = stage(_resolve(inputs, moves, cfg), "stock-moves")
    resolved = settled.where(~F.col("too_much")).drop("too_much")
    rejected = rejected.unionByName(settled.where("too_much").select("seq", F.lit(TOO_MUCH).alias("reject_reason")))
    effects = stage(_serial_effects(inputs, moves, resolved, cfg, block_rows), "serial-effects")
    shared = resolved.where(~F.col("alone"))

    # Serialised receipts count even if they add no serial; one without serial always adds one.
    # As many rows as receipts: merged, as their files are small enough to be broadcast long after they are not.
    in_effect = effects.where((F.col("seq") > 0) & (F.col("kind") != "T")).select("seq", "delta").hint("merge")
    serial_in = (
        shared.where(F.col("kind") == "R")
        .join(in_effect, "seq", "left")
        .select(
            "stock_id",
            "seq",
            "kind",
            F.when(F.col("serial").isNull(), F.lit(1)).otherwise(F.coalesce("delta", F.lit(0))).cast("long").alias("delta"),
            F.lit(None).cast(QUANTITY).alias("quantity"),
        )
    )
    serial_out = effects.where("effective").select(
        "stock_id", "seq", "kind", "delta", F.lit(None).cast(QUANTITY).alias("quantity")
    )
    bulk = shared.where(F.col("kind") != "R").select(
        "stock_id", "seq", "kind", F.lit(0).cast("long").alias("delta"), "quantity"
    )
    moved = stage(serial_in.unionByName(serial_out).unionByName(bulk), "stock-changes")

    touched = moved.select("stock_id").distinct()
    on_hand = inputs["stock_serials"].select(F.col("stock_rid").alias("stock_id")).join(touched, "stock_id", "left_semi")
    held = on_hand.groupBy("stock_id").agg(F.count(F.lit(1)).alias("delta"))
    opening = (
        inputs["stock"]
        .select(F.col("stock_rid").alias("stock_id"), quantity(F.col("qty")).alias("quantity"))
        .join(touched, "stock_id", "left_semi")
        .join(held, "stock_id", "left")
        .select(
            "stock_id",
            F.lit(0).cast("long").alias("seq"),
            F.lit("Q").alias("kind"),
            F.coalesce("delta", F.lit(0)).cast("long").alias("delta"),
            "quantity",
        )
    )
    movements = fold_quantities(moved.unionByName(opening), block_rows, layout=moved)
    end = closing(movements)

    amount = F.when(F.col("kind") == "BT", -F.col("quantity")).otherwise(F.col("quantity"))
    opening_bulk = opening.where(F.col("delta") == 0).select("stock_id", F.col("quantity").alias("amount"))
    on_hand_cells = (
        inputs["stock_serials"]
        .where(F.col("serial_no").isNotNull())
        .select(F.col("stock_rid").alias("stock_id"), F.col("serial_no").alias("cell"))
        .join(touched, "stock_id", "left_semi")
        .select("cell", "stock_id", F.lit(1).cast("long").alias("delta"))
    )
    balance = counted_balance(
        effects.where(F.col("seq") > 0).select("cell", "stock_id", "delta").unionByName(on_hand_cells),
        bulk.select("stock_id", amount.alias("amount")).unionByName(opening_bulk),
    )
    old = inputs["stock_serials"]
    serials = _serials_change(old, resolved, effects)
    return {
        "stock": _stock_rows(inputs["stock"], resolved, end, cfg),
        "stock_serials": old.join(serials.removed, ["stock_rid", "serial_no"], "left_anti").unionByName(serials.added),
        "changes": {"stock": _stock_change(inputs["stock"], touched, resolved, end, cfg), "stock_serials": serials},
        "movements": movements.where(F.col("seq") > 0),
        "closing": end,
        "balance": balance,
        "rejected": rejected,
    }


def _stock_rows(old: DataFrame, resolved: DataFrame, end: DataFrame, cfg: StockConfig) -> DataFrame:
    """The old rows and the new ones, with the quantity after the batch."""
    opened = F.when(F.col("alone"), F.when(F.col("kind") == "R", F.lit(1)).otherwise(F.col("quantity")))
    new = resolved.where("is_new").select("stock_id", "mat_rid", "holder_rid", opened.alias("qty")).distinct()
    values = {
        "stock_rid": F.col("stock_id"),
        "mat_rid": F.col("mat_rid"),
        "price": F.lit(0),
        "stock_condition_index": F.lit(cfg.condition),
        "uom_rid": F.lit(cfg.uom),
        "qty": F.col("qty"),
        "holder_rid": F.col("holder_rid"),
        "holder_type": F.lit(cfg.holder_type),
        "bu_rid": F.lit(cfg.bu),
        "group_rid": F.lit(cfg.group),
        "created_datetime": F.current_timestamp(),
    }
    types = {field.name: field.dataType for field in old.schema.fields}
    rows = old.unionByName(new.select(*[values[c].cast(types[c]).alias(c) for c in old.columns]))
    results = end.select(F.col("stock_id").alias("stock_rid"), F.col("qty").alias("_qty"), F.lit(True).alias("_moved"))
    qty = F.when(F.col("_moved"), F.col("_qty")).otherwise(F.col("qty")).cast("decimal(38,4)").alias("qty")
    return rows.join(results, "stock_rid", "left").select(*[qty if c == "qty" else F.col(c) for c in old.columns])


def _serials_change(old: DataFrame, resolved: DataFrame, effects: DataFrame) -> Change:
    """Serials that leave their stock, all copies at once, and rows that come and stay."""
    gone = effects.where("effective").groupBy("stock_id", "cell").agg(F.max("seq").alias("gone_seq"))
    added = (
        effects.where((F.col("seq") > 0) & (F.col("kind") != "T") & (F.col("delta") == 1))
        .join(gone, ["stock_id", "cell"], "left")
        .where(F.col("gone_seq").isNull() | (F.col("seq") > F.col("gone_seq")))
        .select("seq")
    )
    received = resolved.where(F.col("kind") == "R")
    untracked = F.col("serial").isNull() | F.col("alone")
    rows = received.join(added.withColumn("_added", F.lit(True)).hint("merge"), "seq", "left").where(
        untracked | F.coalesce("_added", F.lit(False))
    )
    types = {field.name: field.dataType for field in old.schema.fields}
    values = {
        "stock_rid": F.col("stock_id"),
        "mat_rid": F.col("mat_rid"),
        "serial_no": F.col("upper_serial"),
        "make_rid": F.lit(0),
    }
    removed = gone.select(F.col("stock_id").cast(types["stock_rid"]).alias("stock_rid"), F.col("cell").alias("serial_no"))
    return Change(removed, rows.select(*[values[c].cast(types[c]).alias(c) for c in old.columns]))


def _stock_change(old: DataFrame, touched: DataFrame, resolved: DataFrame, end: DataFrame, cfg: StockConfig) -> Change:
    """Rows of the stocks that the batch touches, and no others."""
    keys = touched.select(F.col("stock_id").alias("stock_rid"))
    return Change(keys, _stock_rows(old.join(keys, "stock_rid", "left_semi"), resolved, end, cfg))


def change_stock(
    spark: SparkSession,
    root: str,
    run_id: str,
    dimensions: Inputs,
    receipts: DataFrame,
    returns: DataFrame,
    cfg: StockConfig = StockConfig(),
    share: float | None = COMPACT_AT,
) -> int:
    """Fold a batch into the state under `root`, writing only what it changes; the same run again has no effect.

    `dimensions` has `materials` and `contractors`.
    """

    def job(state: dict[str, DataFrame]) -> dict[str, Change]:
        return stock_ledger({**dimensions, **state}, receipts, returns, cfg)["changes"]

    return change_state(spark, root, STATE_KEYS, run_id, job, share)


def stock_sync(
    inputs: Inputs,
    receipts: DataFrame,
    returns: DataFrame,
    cfg: StockConfig = StockConfig(),
    block_rows: int = BLOCK_ROWS,
) -> dict[str, DataFrame]:
    """The whole stock job: state, logs and device attributes from one batch."""
    out = stock_ledger(inputs, receipts, returns, cfg, block_rows)
    # The documents were checked above; the rejected events are taken out by `seq`.
    good_in = absent(receipts, out["rejected"], ["seq"])
    good_out = absent(returns, out["rejected"], ["seq"])
    logged = stage(receipt_log_delta(good_in, inputs["receipt_log"]), "receipt-log")
    devices = device_attributes_replace(inputs["device_current"], good_in, logged, cfg)
    return {
        **out,
        "receipt_log": logged,
        "return_log": return_log_delta(good_out, inputs["return_log"]),
        "device_current": devices["current"],
        "device_history": devices["history"],
    }
