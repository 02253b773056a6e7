"""Install messages: survey responses to outbox rows of type 106."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.config import METER_INSTALL, InstallConfig
from fieldsync.functions import documents as doc
from fieldsync.functions.text import concat_skip_null, date_of_text, decode, or_blank
from fieldsync.operators.keyed import absent, present
from fieldsync.operators.pivot import wide
from fieldsync.operators.previous import previous_flagged
from fieldsync.sources.clustered import point_scan
from fieldsync.sources.outbox import with_serial
from fieldsync.sources.staging import stage

Inputs = dict[str, DataFrame]

PAYLOAD = [
    "serialNumber", "meterStatus", "Stock Status", "meterInstalledById", "meterInstalledByName",
    "meterInstalledDate", "Id", "oldMeterSerialNumber", "BodySeal1", "BodySeal2", "BoxSeal1",
    "BoxSeal2", "TerminalSeal1", "TerminalSeal2", "smcBoxOEMId", "smcBoxSAPId",
    "cableLengthConsumed", "cableSAPId", "cableOEMID", "newCT", "newCTRatio", "SIMNo",
    "serviceCategory", "serviceSubCategory",
]

_HEADER = ["responselogid", "distnid", "distcode", "serveyorid", "surveydate", "responsetime", "nodetype", "activityid"]


def strict_properties(properties: Column) -> Column:
    """(id text, meter_Id, value, seal_number) per property; a value with a leading brace is a document.

    Two steps, so that a value is read once however many members are taken.
    """

    def read(p: Column) -> Column:
        nested = p["value"].startswith("{")
        return F.struct(
            p["categorypropertyallocationid"].alias("id"),
            p["value"].alias("text"),
            nested.alias("nested"),
            doc.open_value(F.when(nested, p["value"])).alias("opened"),
        )

    def pick(v: Column) -> Column:
        return F.struct(
            v["id"].alias("id"),
            doc.value_member(v["opened"], "meter_Id").alias("meter_Id"),
            F.when(v["nested"], doc.value_member(v["opened"], "value")).otherwise(v["text"]).alias("value"),
            doc.value_member(v["opened"], "seal_number").alias("seal_number"),
            (v["nested"] & ~doc.value_ok(v["opened"])).alias("broken"),
        )

    return F.transform(F.transform(properties, read), pick)


def tolerant_properties(properties: Column) -> Column:
    """As above, but a value is a document when it parses at all, and ids are numbers.

    A plain `123` or `true` parses, as a scalar without members: such values
    are lost here, and kept in the strict form.
    """

    def read(p: Column) -> Column:
        return F.struct(
            F.nullif(p["categorypropertyallocationid"], F.lit("")).alias("id"),
            p["value"].alias("text"),
            doc.open_value(p["value"]).alias("opened"),
        )

    def pick(v: Column) -> Column:
        number = v["id"].try_cast("int")
        parses = doc.value_ok(v["opened"])
        return F.struct(
            number.alias("id"),
            F.when(parses, doc.value_member(v["opened"], "meter_Id")).alias("meter_Id"),
            F.when(parses, doc.value_member(v["opened"], "value")).otherwise(v["text"]).alias("value"),
            F.when(parses, doc.value_member(v["opened"], "seal_number")).alias("seal_number"),
            F.when(parses, doc.value_member(v["opened"], "meter_Id")).otherwise(v["text"]).alias("any_meter"),
            (v["id"].isNotNull() & number.isNull()).alias("broken"),
        )

    return F.transform(F.transform(properties, read), pick)


def install_attributes(responses: DataFrame, cfg: InstallConfig = InstallConfig()) -> DataFrame:
    """One row per response with its ten attributes and, if unusable, the reason."""
    text_ids = {name: (m, tuple(str(i) for i in ids)) for name, (m, ids) in cfg.properties.items()}
    read = doc.read_documents(responses, "response").withColumn(
        "_properties", strict_properties(F.col("properties"))
    )
    reason = F.coalesce(
        doc.broken_document("response"),
        F.when(F.exists("_properties", lambda p: p["broken"]), F.lit("a property value does not parse")),
    )
    return read.select(
        *responses.columns, *wide(F.col("_properties"), text_ids, collation=cfg.collation), reason.alias("reject_reason")
    )


def _header(cfg: InstallConfig) -> dict[str, Column]:
    return {
        "meterinstallbyid": F.col("username"),
        "meterinstalledby": concat_skip_null(F.col("FirstName"), F.col("LastName")),
        "installation_date": date_of_text(F.col("surveydate"), F.col("responsetime")),
        "servicecategory": decode(F.col("nodetype"), cfg.category_by_node_type),
        "servicesubcategory": decode(F.col("activityid"), cfg.sub_category_by_activity),
    }


def _remarks(rows: DataFrame, eligible: DataFrame, inputs: Inputs) -> DataFrame:
    """`Resurvey` when the previous response of the node is flagged, else `Fresh MI`.

    Any earlier response of the node counts, so the whole history of the nodes
    at hand is looked at, and of those nodes only. `eligible` names the rows'
    nodes in a narrow staged table.
    """
    history = present(inputs["responses"].select("distnid", "responselogid"), eligible, ["distnid"])
    flagged = inputs["resurvey_flags"].where(F.col("resurvey") == 1).select(F.col("responseid").alias("responselogid"))
    marks = previous_flagged(stage(history, "node-history"), flagged, "distnid", "responselogid").where("previous_flagged")
    marked = rows.join(marks.select("responselogid", "previous_flagged"), "responselogid", "left")
    remark = F.when(F.col("previous_flagged"), F.lit("Resurvey")).otherwise(F.lit("Fresh MI"))
    return marked.withColumn("remarks", remark).drop("previous_flagged")


def meter_materials(inputs: Inputs, cfg: InstallConfig) -> DataFrame:
    """One row per receipt of a serial (times its material ids) with box and cable ids."""
    ids = inputs["material_ids"].select("mat_rid", "smcbox_oemid", "smcbox_sapid", "mat_subcategory")
    materials = inputs["materials"].select("mm_rid", "name", "code")
    receipts = inputs["receipt_log"].where(F.col("serialno").isNotNull()).select("serialno", "materialname", "materialcode")
    joined = receipts.join(
        materials, (F.col("name") == F.col("materialname")) & (F.col("code") == F.col("materialcode")), "left"
    ).join(ids, F.col("mat_rid") == F.col("mm_rid"), "left")

    def only(sub_category: str, column: str) -> Column:
        return F.when(F.col("mat_subcategory") == sub_category, F.col(column)).otherwise(F.lit("NA"))

    return joined.select(
        F.col("serialno"),
        F.struct(
            only(cfg.box_sub_category, "smcbox_oemid").alias("box_oem"),
            only(cfg.box_sub_category, "smcbox_sapid").alias("box_sap"),
            only(cfg.cable_sub_category, "smcbox_sapid").alias("cable_sap"),
            only(cfg.cable_sub_category, "smcbox_oemid").alias("cable_oem"),
        ).alias("ids"),
    )


def _payload_columns() -> list[Column]:
    none = F.struct(*[F.lit("NA").alias(n) for n in ("box_oem", "box_sap", "cable_sap", "cable_oem")])
    ids = F.coalesce(F.col("ids"), none)
    values = {
        "serialNumber": F.col("meternum"),
        "meterStatus": F.lit("10"),
        "Stock Status": F.lit("No"),
        "meterInstalledById": or_blank(F.col("meterinstallbyid")),
        "meterInstalledByName": or_blank(F.col("meterinstalledby")),
        "meterInstalledDate": or_blank(F.col("installation_date").cast("string")),
        "Id": or_blank(F.col("distcode")),
        "oldMeterSerialNumber": F.coalesce(F.col("oldmeternum"), F.col("barcode"), F.lit("")),
        "BodySeal1": or_blank(F.col("bodyseal1")),
        "BodySeal2": or_blank(F.col("bodyseal2")),
        "BoxSeal1": or_blank(F.col("boxseal1")),
        "BoxSeal2": or_blank(F.col("boxseal2")),
        "TerminalSeal1": or_blank(F.col("termseal1")),
        "TerminalSeal2": or_blank(F.col("termseal2")),
        "smcBoxOEMId": ids["box_oem"],
        "smcBoxSAPId": ids["box_sap"],
        "cableLengthConsumed": or_blank(F.col("cablelength")),
        "cableSAPId": ids["cable_sap"],
        "cableOEMID": ids["cable_oem"],
        "newCT": F.lit(""),
        "newCTRatio": F.lit(""),
        "SIMNo": or_blank(F.col("sim_no")),
        "serviceCategory": F.col("servicecategory"),
        "serviceSubCategory": F.col("servicesubcategory"),
    }
    return [values[name].alias(name) for name in PAYLOAD]


def _enrich(rows: DataFrame, inputs: Inputs, materials: DataFrame, receipt_join: str) -> DataFrame:
    sims = inputs["device_current"].select(F.col("serial_number").alias("_sim_serial"), "sim_no")
    with_ids = rows.join(materials, F.col("meternum") == F.col("serialno"), receipt_join)
    return with_ids.join(sims, F.upper("meternum") == F.col("_sim_serial"), "left")


def _messages(rows: DataFrame, push_datetime: Column) -> DataFrame:
    return rows.select(
        "responselogid",
        "distnid",
        F.col("distcode").alias("distributionnodecode"),
        doc.payload([F.col(f"`{name}`") for name in PAYLOAD]).alias("request"),
        F.col("remarks").alias("description"),
        F.lit(METER_INSTALL).alias("type_id"),
        push_datetime.alias("push_datetime"),
        F.col("serialNumber").alias("serial_number"),
    )


def first_per_node(rows: DataFrame) -> DataFrame:
    """(responselogid, distnid) of the lowest response of each node; a response without a node is on its own."""
    alone = F.when(F.col("distnid").isNull(), F.col("responselogid")).alias("_alone")
    return rows.groupBy("distnid", alone).agg(F.min("responselogid").alias("responselogid")).select("responselogid", "distnid")


def install_push(
    inputs: Inputs,
    wanted: DataFrame | None = None,
    cfg: InstallConfig = InstallConfig(),
    one_open_per_node: bool = True,
) -> dict[str, DataFrame]:
    """Messages for the wanted (responselogid, projectid, activityid), or for all responses.

    Pushing one response leaves an open row that blocks its node for the next
    one; over a batch the response with the lowest id of a node therefore goes
    first and the others wait. `one_open_per_node=False` lets all pass that the
    outbox does not block yet.
    """
    responses = inputs["responses"].where(
        F.col("activityid").isin(*cfg.activities) & (F.col("responsestatusid") >= 0)
    )
    if wanted is not None:
        wanted = stage(wanted, "install-wanted")
        responses = point_scan(responses, wanted, "responselogid").join(wanted, ["responselogid", "projectid", "activityid"], "left_semi")
    users = inputs["users"].select(F.col("userid").alias("serveyorid"), "username", "FirstName", "LastName")

    # Documents are parsed once; both outputs are taken from the staged rows.
    attributes = stage(
        install_attributes(responses.select(*_HEADER, "response"), cfg).drop("response").join(users, "serveyorid"),
        "install-attributes",
    )
    rejected = attributes.where(F.col("reject_reason").isNotNull()).select("responselogid", "reject_reason")

    # Which responses go is settled on two narrow columns; the wide rows are fetched once.
    open_rows = inputs["install_outbox"].where(F.col("status") == False)  # noqa: E712
    usable = attributes.where(F.col("reject_reason").isNull() & F.col("meternum").isNotNull())
    free = absent(usable.select("responselogid", "distnid"), open_rows, ["distnid"])
    if one_open_per_node:
        free = first_per_node(free)
    eligible = stage(free, "install-eligible")
    chosen = usable.join(eligible.select("responselogid"), "responselogid", "left_semi")
    shown = _remarks(chosen.withColumns(_header(cfg)), eligible, inputs)
    enriched = _enrich(shown, inputs, meter_materials(inputs, cfg).distinct(), "left")
    distinct = enriched.select(
        "responselogid", "distnid", "distcode", "remarks", *_payload_columns()
    ).distinct()
    return {"delta": _messages(distinct, F.current_timestamp()), "rejected": rejected}


def install_repush(inputs: Inputs, cfg: InstallConfig = InstallConfig()) -> dict[str, DataFrame]:
    """Messages for every response of the backlog whose meter was received and not yet sent."""
    # The outbox is read once: node, serial, and whether the message is open.
    is_open = F.coalesce(F.col("status") == False, F.lit(False))  # noqa: E712
    outbox = stage(with_serial(inputs["install_outbox"]).select("distnid", "serial_number", "type_id", is_open.alias("is_open")), "install-log")
    backlog = inputs["responses"].where(
        (F.col("projectid") == cfg.repush_project)
        & (F.col("responsestatusid") >= 0)
        & ~F.col("activityid").isin(*cfg.repush_skipped_activities)
        & F.col("response").startswith("{")
    )
    backlog = absent(
        backlog.select(*_HEADER, "response"), outbox.where(F.col("is_open") & (F.col("type_id") == METER_INSTALL)), ["distnid"]
    )

    # Texts that do not parse have no properties here, without being rejected.
    read = doc.read_documents(backlog, "response").withColumn(
        "_properties", tolerant_properties(F.col("properties"))
    )
    reason = F.when(
        F.col("document_ok"),
        F.coalesce(
            doc.broken_document("response"),
            F.when(F.exists("_properties", lambda p: p["broken"]), F.lit("a property id is not a number")),
        ),
    )
    meters = F.array_distinct(
        F.filter(F.transform("_properties", lambda p: p["any_meter"]), lambda m: m.isNotNull() & (m != ""))
    )
    attributes = stage(
        read.select(
            *_HEADER,
            *wide(F.col("_properties"), cfg.properties, collation=cfg.collation),
            meters.alias("meters"),
            reason.alias("reject_reason"),
        ),
        "repush-attributes",
    )
    rejected = attributes.where(F.col("reject_reason").isNotNull()).select("responselogid", "reject_reason")
    usable = attributes.where(F.col("reject_reason").isNull())

    # A response counts when any of its meters was received and not sent for its node.
    received = inputs["receipt_log"].select(F.col("serialno").alias("serial_number"))
    candidates = usable.where(F.col("meternum").isNotNull()).select(
        "responselogid", "distnid", F.explode("meters").alias("serial_number")
    )
    unsent = absent(present(candidates, received, ["serial_number"]), outbox, ["distnid", "serial_number"])
    free = absent(unsent.select("responselogid", "distnid").distinct(), outbox.where("is_open"), ["distnid"])
    eligible = stage(free, "repush-eligible")

    users = inputs["users"].select(F.col("userid").alias("serveyorid"), "username", "FirstName", "LastName")
    chosen = usable.join(eligible.select("responselogid"), "responselogid", "left_semi").join(users, "serveyorid")
    shown = _remarks(chosen.withColumns(_header(cfg)), eligible, inputs)
    enriched = _enrich(shown, inputs, meter_materials(inputs, cfg), "inner")
    rows = enriched.select("responselogid", "distnid", "distcode", "remarks", *_payload_columns())
    return {"delta": _messages(rows, F.lit(None).cast("timestamp")), "rejected": rejected}
