"""Registered queries: each runs a job or an operator over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsync.catalog import derive as d
from fieldsync.functions import documents as doc
from fieldsync.functions import text
from fieldsync.operators import keyed
from fieldsync.operators.pivot import wide_by_key
from fieldsync.operators.previous import previous_flagged
from fieldsync.operators.quarantine import document_counts, split_documents
from fieldsync.operators.skew import skew_join
from fieldsync.plans import audit, dimensions, feeds, installs, people, stock
from fieldsync.sources.outbox import append_run, compact, land_api, land_raw, read_outbox, returned, with_defaults
from fieldsync.sources.staging import stage, staging_root
from fieldsync.sources.state import read_state, start_state
from fieldsync.sources.tables import empty

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def members(request: str, names: list[str], aliases: dict[str, str] | None = None) -> list[Column]:
    """Members of a payload as columns, for comparing payloads by value."""
    fields = ",".join(f"`{name}`:string" for name in names)
    parsed = F.from_json(request, f"struct<{fields}>")
    return [parsed[name].alias((aliases or {}).get(name, name.replace(" ", "_"))) for name in names]


# --- documents and install messages -----------------------------------------


@query
def install_pivot(spark, sf_dir):
    """One wide row per user from the property rows."""
    rows = d.given(spark, sf_dir, "events").select("user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    mapping = {
        "max_view": ("k", ("view",)),
        "max_buy": ("k", ("purchase", "signup")),
        "max_error": ("k", ("error",)),
        "max_click": ("k", ("click",)),
    }
    wide = wide_by_key(rows, ["user_id"], "event_type", mapping)
    return wide.select(
        "user_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in mapping], F.coalesce("max_buy", "max_view", F.lit(0)).alias("best")
    )


@query
def install_attributes(spark, sf_dir):
    """Ten attributes of every survey, or why it cannot be used."""
    rows = installs.install_attributes(d.responses(spark, sf_dir).select("responselogid", "response"))
    return rows.drop("response")


@query
def install_seals(spark, sf_dir):
    """Seals of surveys that tell them twice: the greater text by a collation, where small and capital letters are neighbours."""
    rows = installs.install_attributes(d.sealed_responses(spark, sf_dir), installs.InstallConfig(collation="UNICODE"))
    return rows.select("responselogid", *d.SEALS, "reject_reason")


@query
def install_pivot_collated(spark, sf_dir):
    """One wide row per brand from its parts' types, small and capital, the greatest by a collation."""
    size = F.col("p_size")
    name = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_type")).otherwise(F.col("p_type"))
    rows = d.given(spark, sf_dir, "part").select("p_brand", (size % 3).alias("third"), name.alias("name"))
    mapping = {"first": ("name", (0,)), "others": ("name", (1, 2))}
    return wide_by_key(rows, ["p_brand"], "third", mapping, collation="UNICODE")


@query
def json_numbers(spark, sf_dir):
    """Numbers of documents as they were written, in members, in what is below them, and as attributes of a survey."""
    price, quantity = F.format_string("%.2f", "l_extendedprice"), F.format_string("%.3f", "l_quantity")
    number = F.concat("l_orderkey", F.lpad("l_partkey", 22, "0"))
    document = d.text('{"price": ', price, ', "below": {"list": [', quantity, ', 7]}, "number": 1', number, ', "propertiesBean":[',
                      '{"categorypropertyallocationid":941,"value":', quantity, '},{"categorypropertyallocationid":"650","value":"{\\"value\\":', price, '}"}]}')
    rows = d.given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", document.alias("response"))
    told = ["price", "below", "number"]
    read = installs.install_attributes(doc.read_members(rows, "response", told))
    return read.select("l_orderkey", "l_linenumber", *told, "cablelength", "barcode", "reject_reason")


@query
def install_explode(spark, sf_dir):
    """Property rows of all surveys, counted per id."""
    surveys = doc.read_documents(d.responses(spark, sf_dir), "response").select(F.explode("properties").alias("p"))
    return surveys.groupBy(F.col("p.categorypropertyallocationid").alias("property_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("p.value").alias("max_value"), F.count_distinct("p.value").alias("n_values")
    )


@query
def install_push(spark, sf_dir):
    delta = installs.install_push(d.installs(spark, sf_dir))["delta"]
    return delta.select("responselogid", "distnid", "distributionnodecode", "description", "type_id", *members("request", installs.PAYLOAD))


@query
def install_rejects(spark, sf_dir):
    return installs.install_push(d.installs(spark, sf_dir))["rejected"]


@query
def install_wanted(spark, sf_dir):
    """A push of named responses: those whose order had a line returned."""
    returned = d.given(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("responselogid"))
    inputs = d.installs(spark, sf_dir)
    wanted = inputs["responses"].join(returned, "responselogid", "left_semi").select("responselogid", "projectid", "activityid")
    delta = installs.install_push(inputs, wanted)["delta"]
    return delta.select("responselogid", "distnid", "distributionnodecode", "description", "type_id", *members("request", installs.PAYLOAD))


@query
def install_returned(spark, sf_dir):
    """What a push hands back for sending, once it is in the outbox."""
    inputs = d.installs(spark, sf_dir)
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/outbox-{uuid.uuid4().hex}"
    written = append_run(installs.install_push(inputs)["delta"], "install_outbox", path, "first", "id", inputs["install_outbox"]).written
    return returned(written).select("url", "codepart", *members("json1", installs.PAYLOAD))


@query
def outbox_rejects(spark, sf_dir):
    """Messages of very long documents through the outbox: written with an id, or refused with a reason."""
    longer = F.when(F.col("doc_id") % 50 == 0, F.repeat("text", 300)).otherwise(F.col("text"))
    texts = d.given(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("distnid"), longer.alias("request"))
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/outbox-{uuid.uuid4().hex}"
    run = append_run(texts, "install_outbox", path, "first", "id", empty(spark, "install_outbox"))
    taken = run.written.select("distnid", F.char_length("request").alias("chars"), F.when(F.col("id") > 0, "written").alias("outcome"))
    return taken.unionByName(run.rejected.select("distnid", F.char_length("request").alias("chars"), F.col("reject_reason").alias("outcome")))


@query
def outbox_two_runs(spark, sf_dir):
    """Two runs at once into one outbox, whose customers overlap: a customer gets one message, and no id is given twice."""
    orders = d.given(spark, sf_dir, "orders").select(F.col("o_custkey").cast("int").alias("distnid"), "o_orderstatus", "o_orderpriority")
    halves = {"closed": F.col("o_orderstatus") == "F", "urgent": F.col("o_orderpriority") == "1-URGENT"}
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/outbox-{uuid.uuid4().hex}"
    nothing = empty(spark, "install_outbox")

    def run(name):
        delta = orders.where(halves[name]).select("distnid").distinct()
        return append_run(delta, "install_outbox", path, name, "id", nothing, unique=[["distnid"]])

    with ThreadPoolExecutor(len(halves)) as pool:
        list(pool.map(run, halves))
    log = read_outbox(spark, path, "install_outbox")
    alike = log.groupBy("id").agg(F.count(F.lit(1)).alias("same_id"))
    return log.join(alike, "id").groupBy("distnid").agg(F.count(F.lit(1)).alias("messages"), F.max("same_id").alias("same_id"))


@query
def outbox_compacted(spark, sf_dir):
    """Five runs of messages, put together after three and after five, as a reader finds them: by node and type, with their serials."""
    orders = d.given(spark, sf_dir, "orders")
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/outbox-{uuid.uuid4().hex}"
    nothing = empty(spark, "install_outbox")
    kinds = d.by_value(F.col("o_orderstatus"), {"F": 105, "O": 106, "P": 108}).cast("int")
    runs = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    for n, priority in enumerate(runs, 1):
        delta = orders.where(F.col("o_orderpriority") == priority).select(
            F.col("o_custkey").cast("int").alias("distnid"),
            d.text('{"serialNumber": "MT', F.col("o_orderkey") % 1000, '"}').alias("request"),
            kinds.alias("type_id"),
        )
        append_run(delta, "install_outbox", path, priority, "id", nothing)
        if n in (3, 5):
            compact(spark, path, "install_outbox", "id")
    log = read_outbox(spark, path, "install_outbox")
    return log.groupBy("distnid", "type_id", F.col("run_id").alias("run")).agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("id").alias("ids"), F.max("serial_number").alias("last_serial")
    )


@query
def install_repush(spark, sf_dir):
    delta = installs.install_repush(d.installs(spark, sf_dir))["delta"]
    return delta.select("responselogid", "distnid", "distributionnodecode", "description", "type_id", *members("request", installs.PAYLOAD))


@query
def install_payload(spark, sf_dir):
    """Payload text with NULL members kept, and its members read back."""
    orders, customers = d.given(spark, sf_dir, "orders"), d.given(spark, sf_dir, "customer")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    nested = F.struct(F.lit("").alias("location"), F.col("c_mktsegment").alias("date"))
    request = doc.payload(
        [
            F.col("c_name").alias("serialNumber"),
            F.col("o_orderstatus").alias("Stock Status"),
            F.when(F.col("c_acctbal") > 0, F.col("o_orderpriority")).alias("serviceCategory"),
            nested.alias("subdivision"),
        ]
    )
    read = rows.select("o_orderkey", request.alias("request"))
    return read.select(
        "o_orderkey",
        *members("request", ["serialNumber", "Stock Status", "serviceCategory"]),
        F.get_json_object("request", "$.subdivision.date").alias("segment"),
        F.size(F.json_object_keys("request")).alias("n_members"),
    )


@query
def repush_backlog(spark, sf_dir):
    """Orders without an open line, times the receipts of their parts; copies stay."""
    orders, lines, parts = (d.given(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    open_lines = lines.where(F.col("l_linestatus") == "O").select(F.col("l_orderkey").alias("o_orderkey"))
    backlog = keyed.absent(orders.select("o_orderkey", "o_custkey"), open_lines, ["o_orderkey"])
    received = lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    return backlog.join(received, "o_orderkey").join(parts.select("p_partkey", "p_brand"), "p_partkey").select(
        "o_orderkey", "o_custkey", "p_brand"
    )


@query
def skewed_joins(spark, sf_dir):
    """A third of all lines on one part, joined as the left and as the right side, with partners and without."""
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long")
    part = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).cast("long")
    lines = d.given(spark, sf_dir, "lineitem").select(part.alias("part"), line.alias("line"))
    parts = d.given(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("part"), "p_brand", "p_size")
    small = parts.where((F.col("p_size") <= 25) | (F.col("part") == 1))
    unlisted = parts.where(F.col("part") > 1).select("part", "p_brand")
    joins = {
        "left": skew_join(lines, small, ["part"], "left", "line", "part"),
        "right": skew_join(parts, lines.where(F.col("line") % 2 == 0), ["part"], "left", "part", "line"),
        "inner": skew_join(small, lines, ["part"], "inner", "part", "line"),
        "semi": skew_join(lines, small, ["part"], "left_semi", "line").withColumn("p_brand", F.lit(None).cast("string")),
        "anti": skew_join(lines, unlisted, ["part"], "left_anti", "line").withColumn("p_brand", F.lit(None).cast("string")),
    }
    rows = [j.select(F.lit(name).alias("kind"), "p_brand", "part", "line") for name, j in joins.items()]
    summed = reduce(DataFrame.unionByName, rows).groupBy("kind", "p_brand")
    return summed.agg(F.count(F.lit(1)).alias("n"), F.count("line").alias("n_lines"), F.sum("part").alias("parts"), F.sum("line").alias("lines"))


@query
def previous_flag(spark, sf_dir):
    """`Resurvey` when the customer's previous order has status F."""
    orders = d.given(spark, sf_dir, "orders")
    flagged = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    marks = previous_flagged(orders.select("o_custkey", "o_orderkey"), flagged, "o_custkey", "o_orderkey")
    return marks.select(
        "o_orderkey",
        F.col("previous_id").alias("previous_order"),
        F.when(F.col("previous_flagged"), "Resurvey").otherwise("Fresh MI").alias("remarks"),
    )


# --- contractors and technicians --------------------------------------------

_CONTRACTOR = ["uniqueId", "agencyCode", "userName", "mobileNo", "emailAddress", "role", "dob", "isActive"]
_TECHNICIAN = ["technician_Id", "name", "mobile_number", "email_address", "contractorName", "contractorId", "contractorLoginId", "dob"]


@query
def contact_new(spark, sf_dir):
    delta = people.contact_create_delta(d.people(spark, sf_dir))
    return delta.select("contractorid", "roleid", "inchargeid", "type_id", *members("request", _CONTRACTOR))


@query
def contact_changed(spark, sf_dir):
    delta = people.contact_update_delta(d.people(spark, sf_dir))
    return delta.select("contractorid", "roleid", "inchargeid", "type_id", *members("request", _CONTRACTOR))


@query
def technician_new(spark, sf_dir):
    delta = people.technician_create_delta(d.people(spark, sf_dir))
    return delta.select("userid", "contactid", "roleid", "type_id", *members("request", _TECHNICIAN))


@query
def technician_changed(spark, sf_dir):
    delta = people.technician_update_delta(d.people(spark, sf_dir))
    return delta.select("userid", "contactid", "roleid", "type_id", *members("request", _TECHNICIAN))


# --- delete and swap feeds ----------------------------------------------------


@query
def delete_feed(spark, sf_dir):
    delta = feeds.install_delete_feed(d.feeds(spark, sf_dir))["delta"]
    return delta.select("pushlog_id", "distnid", "distributionnodecode", "serial_number", "description", "type_id",
                        F.get_json_object("request", "$.miDeleteFlag").alias("flag"))


@query
def swap_feed(spark, sf_dir):
    delta = feeds.meter_swap_feed(d.feeds(spark, sf_dir))
    names = ["serialNumber", "consumerId", "consumername", "oldMeterSerialNumber"]
    return delta.select("distnid", "distributionnodecode", "description", "type_id", *members("request", names))


# --- stock ----------------------------------------------------------------------


def _ledger(spark, sf_dir, serial=d.own_serial) -> dict[str, DataFrame]:
    return stock.stock_ledger(
        d.stock_state(spark, sf_dir), d.receipt_events(spark, sf_dir, serial), d.return_events(spark, sf_dir, serial)
    )


@query
def stock_ledger(spark, sf_dir):
    """Stock rows after all events: quantity as the source system keeps it."""
    return _ledger(spark, sf_dir)["stock"].select("stock_rid", "mat_rid", "holder_rid", "qty")


@query
def stock_movements(spark, sf_dir):
    """Serial count and quantity after every movement."""
    return _ledger(spark, sf_dir)["movements"].select("stock_id", "seq", "count_after", F.col("qty_after").cast("decimal(18,4)").alias("qty_after"))


@query
def stock_serials(spark, sf_dir):
    """Serials held after all events, copies counted."""
    return _ledger(spark, sf_dir)["stock_serials"].groupBy("stock_rid", "mat_rid", "serial_no").agg(F.count(F.lit(1)).alias("copies"))


@query
def stock_balance(spark, sf_dir):
    """Distinct serials held plus bulk in minus bulk out."""
    return _ledger(spark, sf_dir)["balance"].select("stock_id", "serials", F.col("qty").cast("decimal(18,4)").alias("qty"))


@query
def stock_movements_split(spark, sf_dir):
    """As `stock_movements`, with stocks cut into blocks of a few hundred rows."""
    out = stock.stock_ledger(d.stock_state(spark, sf_dir), d.receipt_events(spark, sf_dir), d.return_events(spark, sf_dir), block_rows=500)
    return out["movements"].select("stock_id", "seq", "count_after", F.col("qty_after").cast("decimal(18,4)").alias("qty_after"))


@query
def stock_shared_serials(spark, sf_dir):
    """As `stock_ledger`, with serials that lie in several stocks at once, so that returns have to be located."""
    return _ledger(spark, sf_dir, d.shared_serial)["stock"].select("stock_rid", "mat_rid", "holder_rid", "qty")


@query
def stock_hot_serial(spark, sf_dir):
    """Movements with most events on one serial that lies in several stocks, located in blocks of a few thousand rows."""
    events = d.receipt_events(spark, sf_dir, d.hot_serial), d.return_events(spark, sf_dir, d.hot_serial)
    out = stock.stock_ledger(d.stock_state(spark, sf_dir), *events, block_rows=2_000)
    return out["movements"].select("stock_id", "seq", "count_after", F.col("qty_after").cast("decimal(18,4)").alias("qty_after"))


@query
def stock_odd_events(spark, sf_dir):
    """Stock rows and their serials after events with unknown contractors and materials, without serials, of unknown types."""
    receipts = d.odd_events(d.receipt_events(spark, sf_dir), "contractorcode")
    returns = d.odd_events(d.return_events(spark, sf_dir), "fromcontractorcode")
    out = stock.stock_ledger(d.stock_state(spark, sf_dir), receipts, returns)
    held = out["stock_serials"].groupBy("stock_rid").agg(F.count(F.lit(1)).alias("serials"), F.count("serial_no").alias("named"))
    rows = out["stock"].join(held, "stock_rid", "left").select("stock_rid", "mat_rid", "holder_rid", "qty", "serials", "named")
    return rows.fillna(0, ["serials", "named"])


@query
def stock_incremental(spark, sf_dir):
    """Stock rows and serials after all events in two batches, each of which writes its changes beside the base."""
    root = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/state-{uuid.uuid4().hex}"
    opening = d.stock_state(spark, sf_dir)
    start_state(spark, root, opening, stock.STATE_KEYS)
    receipts, returns = d.receipt_events(spark, sf_dir), d.return_events(spark, sf_dir)
    half = keyed.highest(receipts, "seq") // 2
    for run_id, part in (("first", F.col("seq") <= half), ("second", F.col("seq") > half)):
        stock.change_stock(spark, root, run_id, opening, receipts.where(part), returns.where(part), share=None)
    state = read_state(spark, root, stock.STATE_KEYS)
    held = state["stock_serials"].groupBy("stock_rid").agg(F.count(F.lit(1)).alias("serials"))
    rows = state["stock"].join(held, "stock_rid", "left")
    return rows.select("mat_rid", "holder_rid", "qty", F.coalesce("serials", F.lit(0)).cast("long").alias("serials"))


@query
def receipt_log_once(spark, sf_dir):
    logged = stock.receipt_log_delta(d.receipt_events(spark, sf_dir), d.stock_logs(spark, sf_dir)["receipt_log"])
    return logged.select("seq", "documentnumber", "crvdate", "contractorcode", "materialcode", "quantity", "serialno", "type", "wh_activity")


@query
def return_log_once(spark, sf_dir):
    logged = stock.return_log_delta(d.return_events(spark, sf_dir), d.stock_logs(spark, sf_dir)["return_log"])
    return logged.select("seq", "doc_num", "cridate", "fromcontractorcode", "materialcode", "quantity", "serial_num", "type", "wh_activity")


def _devices(spark, sf_dir) -> dict[str, DataFrame]:
    receipts = d.receipt_events(spark, sf_dir)
    logged = stage(stock.receipt_log_delta(receipts, d.stock_logs(spark, sf_dir)["receipt_log"]).select("seq"), "logged")
    return stock.device_attributes_replace(d.device_current(spark, sf_dir), receipts, logged)


_DEVICE = ["serial_number", "device_id", "sim_no", "meter_make", "hls_us", "lls", "type_source"]


@query
def attributes_current(spark, sf_dir):
    return _devices(spark, sf_dir)["current"].select(*_DEVICE)


@query
def attributes_history(spark, sf_dir):
    return _devices(spark, sf_dir)["history"].select(*_DEVICE)


@query
def document_log_once(spark, sf_dir):
    """First line per (order, part) in an order over all columns."""
    lines = d.given(spark, sf_dir, "lineitem")
    columns = ["l_linenumber", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"]
    first = lines.groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct(*columns)).alias("_first"))
    return first.select("l_orderkey", "l_partkey", *[F.col(f"_first.{c}").alias(c) for c in columns])


# --- dimensions -------------------------------------------------------------------


@query
def contractor_first_wins(spark, sf_dir):
    new = dimensions.contractor_upsert({"contractors": d.known_contractors(spark, sf_dir)}, d.contractor_events(spark, sf_dir))
    return new.select("contact_rid", "firm_name", "contact_person", "mobile", "address", "vendor_code", "group_rid", "status", "created_user_rid", "data_json")


def _materials(spark, sf_dir) -> dict[str, DataFrame]:
    return dimensions.material_upsert(d.material_state(spark, sf_dir), d.material_events(spark, sf_dir))


@query
def material_cascade(spark, sf_dir):
    return _materials(spark, sf_dir)["materials"].select(
        "mm_rid", "name", "code", "description", "uom_group_rid", "hsn_code", "mc_rid", "msc_rid", "serial_flag", "default_uom_rid"
    )


@query
def material_units(spark, sf_dir):
    made = _materials(spark, sf_dir)
    groups = made["uom_groups"].select("ug_rid", F.col("name").alias("group_name"))
    return groups.join(made["uoms"].select("ug_rid", "uom_rid", F.col("name").alias("unit_name")), "ug_rid")


@query
def material_categories(spark, sf_dir):
    made = _materials(spark, sf_dir)
    categories = made["material_categories"].select("mc_rid", F.col("title").alias("category"))
    return categories.join(made["material_subcategories"].select("mc_rid", "msc_rid", F.col("title").alias("sub_category")), "mc_rid")


@query
def material_partner_ids(spark, sf_dir):
    return _materials(spark, sf_dir)["material_ids"]


# --- documents, audit, landing ----------------------------------------------------


@query
def json_rejects(spark, sf_dir):
    """Per language: texts, those that look like a document, and those that are one."""
    rows = d.given(spark, sf_dir, "documents").select("lang", "text")
    return document_counts(rows, "text", ["lang"], n_looks=F.count(F.when(F.col("text").startswith("{"), 1)))


@query
def survey_rejects(spark, sf_dir):
    """Surveys that do not parse."""
    return split_documents(d.responses(spark, sf_dir), "response")["rejected"].select("responselogid", "distcode", "response")


@query
def audit_text(spark, sf_dir):
    """Audit texts; a nation without a region of its number gives NULL."""
    nation, region = d.given(spark, sf_dir, "nation"), d.given(spark, sf_dir, "region")
    rows = nation.join(region, nation["n_nationkey"] == region["r_regionkey"], "left")
    return audit.audit_append(rows, "nation", ["n_nationkey", "n_name", "r_name"]).select("fntext")


@query
def receipt_audit(spark, sf_dir):
    """One audit text per receipt, with the attribute document masked."""
    return audit.audit_append(d.receipt_events(spark, sf_dir), "receipt", audit.ARGUMENTS["receipt_events"]).select("fntext")


@query
def raw_landing(spark, sf_dir):
    landed = land_raw(d.given(spark, sf_dir, "pages"), "html", "page pull")
    return landed.select("details", "activity_type", F.col("createddatetime").isNotNull().alias("is_dated"))


@query
def api_landing(spark, sf_dir):
    landed = land_api(d.given(spark, sf_dir, "conversations"), "text", "serialized", "CRV")
    return landed.select("details", "type", "wh_activity", "status", F.col("createddatetime").isNotNull().alias("is_dated"))


@query
def outbox_defaults(spark, sf_dir):
    """Outbox rows with what the sink fills in."""
    rows = d.contractor_outbox(spark, sf_dir).select("contractorid", "roleid", F.lit(102).alias("type_id"))
    filled = with_defaults(rows, "contractor_outbox", "api_id")
    return filled.select("contractorid", "roleid", "type_id", "status_created", "inserted", "request")


# --- expressions and small shapes ---------------------------------------------------


@query
def lookup_lowest_id(spark, sf_dir):
    """Every line with the lowest part id of its part's name and brand."""
    parts, lines = d.given(spark, sf_dir, "part"), d.given(spark, sf_dir, "lineitem")
    lowest = keyed.lowest_id(parts, ["p_name", "p_brand"], "p_partkey").withColumnRenamed("p_partkey", "lowest_partkey")
    named = parts.select("p_partkey", "p_name", "p_brand").join(lowest, ["p_name", "p_brand"], "left")
    return (
        lines.select(F.col("l_partkey").alias("p_partkey"))
        .join(named, "p_partkey", "left")
        .groupBy("p_partkey", "lowest_partkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def concat_skip_null(spark, sf_dir):
    customers, nations = d.given(spark, sf_dir, "customer"), d.given(spark, sf_dir, "nation")
    rows = customers.join(nations, customers["c_custkey"] == nations["n_nationkey"], "left")
    return rows.select(
        "c_custkey",
        text.concat_skip_null(F.col("c_name"), F.col("n_name")).alias("skipped"),
        F.concat("c_name", F.lit(" "), "n_name").alias("joined"),
    )


def _date_of_text(spark, sf_dir):
    orders = d.given(spark, sf_dir, "orders")
    day = F.concat_ws("/", F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate"))
    return orders.select("o_orderkey", text.date_of_text(day, F.lit("9:05:00")).alias("order_day"))


@query
def decimal_qty(spark, sf_dir):
    lines = d.given(spark, sf_dir, "lineitem")
    return lines.groupBy("l_partkey").agg(F.sum(text.quantity(F.col("l_quantity"))).cast("decimal(18,4)").alias("qty"))


@query
def distinct_typed(spark, sf_dir):
    lines = d.given(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()
    request = doc.payload([F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line")])
    return lines.select("l_partkey", request.alias("request")).select(
        "l_partkey", F.get_json_object("request", "$.flag").alias("flag"), F.get_json_object("request", "$.line").alias("line")
    )


@query
def not_in_nulls(spark, sf_dir):
    """Documents whose quality label is known and not in the list."""
    documents, labels = d.given(spark, sf_dir, "documents"), d.given(spark, sf_dir, "labels")
    rows = documents.select("doc_id", "lang").join(labels, "doc_id", "left")
    return rows.where(~F.col("quality").isin(-1, 0)).select("doc_id", "lang", "quality")


@query
def latest_row(spark, sf_dir):
    """Newest event of a kind per user."""
    events = d.given(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    return keyed.latest_per_key(events, ["user_id"], "event_id", ["event_type", "value", "props"])


REGISTERED["date_of_text"] = _date_of_text
