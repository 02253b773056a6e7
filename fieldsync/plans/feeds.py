"""Delete and swap messages driven by the request table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.config import METER_DELETE, METER_SWAP, FeedConfig
from fieldsync.functions import documents as doc
from fieldsync.operators.keyed import absent, present
from fieldsync.sources.outbox import with_serial
from fieldsync.sources.staging import stage

Inputs = dict[str, DataFrame]


def _open_requests(inputs: Inputs, remark: str) -> DataFrame:
    return inputs["swap_requests"].where((F.col("status") == False) & (F.col("remarks") == remark))  # noqa: E712


def removal_meters(properties: Column, ids: tuple[int, ...]) -> Column:
    """(meter, broken, unknown) of the properties that name a meter: a document with `meter_Id`, or plain text.

    A property whose id is not a number is unknown: it can't be told what it
    names. An empty id names nothing, as in the repush.
    """
    number = lambda p: p["categorypropertyallocationid"].try_cast("int")
    unknown = lambda p: F.nullif(p["categorypropertyallocationid"], F.lit("")).isNotNull() & number(p).isNull()
    wanted = F.filter(properties, lambda p: number(p).isin(*ids) | unknown(p))

    def read(p: Column) -> Column:
        nested = p["value"].startswith("{")
        return F.struct(
            p["value"].alias("text"),
            nested.alias("nested"),
            doc.open_value(F.when(nested, p["value"])).alias("opened"),
            unknown(p).alias("unknown"),
        )

    def pick(v: Column) -> Column:
        return F.struct(
            F.when(v["nested"], doc.value_member(v["opened"], "meter_Id")).otherwise(v["text"]).alias("meter"),
            (v["nested"] & ~doc.value_ok(v["opened"])).alias("broken"),
            v["unknown"].alias("unknown"),
        )

    return F.transform(F.transform(wanted, read), pick)


def install_delete_feed(inputs: Inputs, cfg: FeedConfig = FeedConfig()) -> dict[str, DataFrame]:
    """One delete message per open request whose meter was pushed before.

    A request with several such meters takes the lowest serial.
    """
    requests = _open_requests(inputs, cfg.delete_remark).select(F.col("swapid").alias("pushlog_id"), "distnid")
    surveys = inputs["responses"].where(
        (F.col("projectid") == cfg.removal_project) & (F.col("responsestatusid") >= 0)
    )
    meters = F.array_distinct(F.filter(F.transform("_meters", lambda m: m["meter"]), lambda m: m.isNotNull()))
    reason = F.coalesce(
        doc.broken_document("response"),
        F.when(F.exists("_meters", lambda m: m["broken"]), F.lit("a property value does not parse")),
        F.when(F.exists("_meters", lambda m: m["unknown"]), F.lit("a property id is not a number")),
    )
    # Only surveys of requested nodes are parsed, and only once.
    of_requests = present(surveys, requests, ["distnid"])
    read = stage(
        doc.read_documents(of_requests, "response")
        .withColumn("_meters", removal_meters(F.col("properties"), cfg.meter_properties))
        .select("responselogid", "distnid", "distcode", meters.alias("meters"), reason.alias("reject_reason")),
        "removal-meters",
    )
    rejected = read.where(F.col("reject_reason").isNotNull()).select("responselogid", "reject_reason")

    found = (
        read.where(F.col("reject_reason").isNull())
        .select("distnid", "distcode", F.explode("meters").alias("serial_number"))
        .distinct()
    )
    pushed = with_serial(inputs["install_outbox"]).where(F.col("status")).select("serial_number")
    log = with_serial(inputs["swap_outbox"])
    open_deletes = log.where((F.col("description") == cfg.delete_remark) & (F.col("status") == False))  # noqa: E712
    candidates = absent(present(found, pushed, ["serial_number"]), open_deletes, ["serial_number", "distnid"])

    # Every request of a node asks for the same meters, so the lowest one is
    # found per node, before the requests come in. Requests without an id never
    # clash with each other, and get all meters of their node.
    lowest = candidates.groupBy("distnid").agg(F.min(F.struct("serial_number", "distcode")).alias("_lowest"))
    with_id = absent(
        requests.where(F.col("pushlog_id").isNotNull()), log.where(F.col("pushlog_id").isNotNull()), ["pushlog_id"]
    )
    chosen = with_id.join(lowest, "distnid").select(
        "pushlog_id", "distnid", F.col("_lowest.distcode").alias("distcode"), F.col("_lowest.serial_number").alias("serial_number")
    )
    without_id = present(candidates, requests.where(F.col("pushlog_id").isNull()), ["distnid"]).select(
        F.lit(None).cast("long").alias("pushlog_id"), "distnid", "distcode", "serial_number"
    )
    delta = chosen.unionByName(without_id).select(
        "distnid",
        F.col("distcode").alias("distributionnodecode"),
        doc.payload([F.col("serial_number").alias("serialNumber"), F.lit(True).alias("miDeleteFlag")]).alias("request"),
        F.lit(cfg.delete_remark).alias("description"),
        F.lit(METER_DELETE).alias("type_id"),
        "pushlog_id",
        "serial_number",
    )
    return {"delta": delta, "rejected": rejected}


def meter_swap_feed(inputs: Inputs, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Swap messages for open requests, from every source that knows the node. Copies stay."""
    requests = _open_requests(inputs, cfg.swap_remark).select("distnid", "meternum", "remarks")
    blank = F.lit("")
    sources = [
        inputs["swap_src_installs"].select(
            "distributionnodecode",
            F.col("distributionnodeid").alias("distnid"),
            F.col("_19").alias("consumer_name"),
            F.col("_354").alias("oldmeternum"),
        ),
        inputs["swap_src_connections"].select(
            "distributionnodecode",
            F.col("distributionnodeid").alias("distnid"),
            F.col("distributionnodename").alias("consumer_name"),
            blank.alias("oldmeternum"),
        ),
        inputs["swap_src_transformers"].select(
            "distributionnodecode", "distnid", blank.alias("consumer_name"), blank.alias("oldmeternum")
        ),
    ]
    nodes = sources[0].unionByName(sources[1]).unionByName(sources[2])

    open_rows = inputs["swap_outbox"].where(F.col("status") == False)  # noqa: E712
    blocked = open_rows.select("distnid", F.col("description").alias("remarks"))
    matched = nodes.join(absent(requests, blocked, ["distnid", "remarks"]), "distnid")
    return matched.select(
        "distnid",
        "distributionnodecode",
        doc.payload(
            [
                F.col("meternum").alias("serialNumber"),
                F.col("distributionnodecode").alias("consumerId"),
                F.col("consumer_name").alias("consumername"),
                F.col("oldmeternum").alias("oldMeterSerialNumber"),
            ]
        ).alias("request"),
        F.col("remarks").alias("description"),
        F.lit(METER_SWAP).alias("type_id"),
        F.col("meternum").alias("serial_number"),
    )
