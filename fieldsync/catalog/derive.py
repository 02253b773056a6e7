"""The jobs' input tables, derived from the given tables by Spark.

Every given row becomes an input row; nothing is left out or made up. Documents
are built inside the row they describe, so no derivation gathers rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer splits than there are cores.

    Reading documents is heavy on the processor; a table of many files is
    spread already and stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def text(*parts: Column | str) -> Column:
    """Concatenation where plain strings are literals and columns become text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def by_value(col: Column, pairs: dict) -> Column:
    out = F.lit(None)
    for value, result in pairs.items():
        out = F.when(col == value, F.lit(result)).otherwise(out)
    return out


def k() -> Column:
    """The number every event carries."""
    return F.get_json_object("props", "$.k").cast("int")


def users(spark, sf_dir) -> DataFrame:
    nation = F.col("c_nationkey")
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("userid"),
        F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("FirstName"),
        F.when(F.col("c_acctbal") >= 0, text("N", nation)).alias("LastName"),
        text("9", F.col("c_custkey")).alias("mobileno"),
        text(F.col("c_name"), "@example.com").alias("alternative_emailid"),
        F.when(nation < 20, 3).otherwise(4).alias("companyid"),
        F.when(F.col("c_acctbal") > 1000, 1).otherwise(0).alias("status"),
        F.date_add(F.lit("1980-01-01").cast("date"), nation).alias("date_of_birth"),
    )


def user_projects(spark, sf_dir) -> DataFrame:
    roles = {"1-URGENT": 2, "2-HIGH": 26, "3-MEDIUM": 5, "4-NOT SPECIFIED": 7, "5-LOW": 65}
    return given(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("userid"),
        F.when(F.col("o_orderstatus") == "F", 20).otherwise(19).alias("projectid"),
        by_value(F.col("o_orderpriority"), roles).alias("roleid"),
    )


def roles(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("roleid"), F.col("n_name").alias("discription"))


def contractors(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    return given(spark, sf_dir, "customer").select(
        key.alias("contact_rid"),
        text("firm ", key).alias("firm_name"),
        text("V", key).alias("vendor_code"),
        F.floor(key / 3).cast("int").alias("incharge_user_rid"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("status"),
    )


def user_contractors(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    return given(spark, sf_dir, "customer").select(key.alias("user_rid"), F.floor(key / 2).cast("int").alias("contact_rid"))


def contractor_categories(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("contact_rid"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), 753).otherwise(1).alias(
            "contact_category_index"
        ),
    )


def contractor_outbox(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.col("event_id").alias("api_id"),
        F.col("user_id").cast("int").alias("contractorid"),
        F.when(k() >= 10, k() % 10).alias("roleid"),
        F.floor(F.col("user_id") / 3).cast("int").alias("inchargeid"),
        (kind == "signup").alias("inserted"),
        (kind == "purchase").alias("updated"),
    )


def technician_outbox(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.col("event_id").alias("api_id"),
        F.col("user_id").cast("int").alias("userid"),
        F.when(k() >= 10, k() % 10).alias("roleid"),
        F.floor(F.col("user_id") / 2).cast("int").alias("contactid"),
        (kind == "signup").alias("inserted"),
        (kind == "click").alias("updated"),
        F.when((kind == "view") & (k() < 5), False).when(kind == "purchase", True).alias("status_created"),
    )


def people(spark, sf_dir) -> dict[str, DataFrame]:
    tables: list[Callable] = [
        users, user_projects, roles, contractors, user_contractors, contractor_categories,
        contractor_outbox, technician_outbox,
    ]
    return {table.__name__: table(spark, sf_dir) for table in tables}


# A survey document with five properties: ids as text and as number, values as
# text, as JSON text and as objects. `%1$d` is the order, `%2$s` the meter.
_SURVEY = (
    '{"propertiesBean":['
    '{"categorypropertyallocationid":"57","value":%2$s},'
    '{"categorypropertyallocationid":354,"value":"{\\"value\\":\\"OLD%3$d\\"}"},'
    '{"categorypropertyallocationid":"68","value":{"seal_number":"S%4$d","seen":true}},'
    '{"categorypropertyallocationid":941,"value":"%5$d"},'
    '{"categorypropertyallocationid":"674","value":"BC%1$d"}]}'
)
_SURVEY_WITHOUT_OLD = _SURVEY.replace('"categorypropertyallocationid":354,', '"categorypropertyallocationid":"",')


def responses(spark, sf_dir) -> DataFrame:
    """One survey per order. Nodes are the customers, so orders of a customer follow each other."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    status = F.col("o_orderstatus")
    meter = text("MT", order % 500)
    plain = (status == "O") & (order % 2 == 0)
    meter_value = F.when(plain, text('"', meter, '"')).otherwise(text('"{\\"meter_Id\\":\\"', meter, '\\"}"'))

    def survey(form: str) -> Column:
        return F.format_string(form, order, meter_value, customer, order % 97, order % 50)

    document = F.when(order % 3 == 0, survey(_SURVEY)).otherwise(survey(_SURVEY_WITHOUT_OLD))
    cut_off = F.expr("substring(_document, 1, length(_document) - 2)")
    activities = {"1-URGENT": 72, "2-HIGH": 3, "3-MEDIUM": 44, "4-NOT SPECIFIED": 10, "5-LOW": 99}
    return (
        spread(given(spark, sf_dir, "orders"))
        .withColumn("_document", document)
        .select(
            order.alias("responselogid"),
            by_value(status, {"P": 19, "F": 20, "O": 999}).alias("projectid"),
            by_value(F.col("o_orderpriority"), activities).alias("activityid"),
            customer.cast("int").alias("serveyorid"),
            F.when(order % 101 == 0, cut_off).otherwise(F.col("_document")).alias("response"),
            F.when(F.col("o_totalprice") < 20000, -1).otherwise(1).alias("responsestatusid"),
            text("N", customer).alias("distcode"),
            customer.cast("int").alias("distnid"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("surveydate"),
            F.lit("10:20:30").alias("responsetime"),
            (customer % 10).cast("int").alias("nodetype"),
        )
    )


# Attributes with two of their property ids each.
SEALS = {"bodyseal2": (359, 958), "boxseal1": (70, 575), "boxseal2": (71, 576), "termseal1": (67, 568), "termseal2": (203, 569)}


def sealed_responses(spark, sf_dir) -> DataFrame:
    """Surveys whose seals are told twice, in small and in capital letters; some leave one out."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")

    def told(number: int, value: Column) -> Column:
        seal = F.to_json(F.struct(value.alias("seal_number")))
        return F.struct(F.lit(number).cast("string").alias("categorypropertyallocationid"), seal.alias("value"))

    twice = [
        told(number, value)
        for n, (small, capital) in enumerate(SEALS.values(), 3)
        for number, value in (
            (small, F.when(customer % 11 != n, text("seal ", customer % n))),
            (capital, F.when(order % 7 != n, text("SEAL ", order % n))),
        )
    ]
    document = F.to_json(F.struct(F.array(*twice).alias("propertiesBean")))
    return given(spark, sf_dir, "orders").select(order.alias("responselogid"), document.alias("response"))


def resurvey_flags(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("responseid"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("resurvey")
    )


def receipt_log(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "part").select(
        text("MT", F.col("p_partkey") * 3).alias("serialno"),
        F.col("p_brand").alias("materialname"),
        F.col("p_type").alias("materialcode"),
        F.col("p_size").alias("documentnumber"),
        F.lit("serialized").alias("type"),
    )


def materials(spark, sf_dir) -> DataFrame:
    return (
        given(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("name"), F.col("p_type").alias("code"))
        .agg(F.min("p_partkey").alias("mm_rid"))
    )


def material_ids(spark, sf_dir) -> DataFrame:
    return materials(spark, sf_dir).select(
        F.col("mm_rid").alias("mat_rid"),
        text(F.col("name"), "-O").alias("smcbox_oemid"),
        text(F.col("code"), "-S").alias("smcbox_sapid"),
        by_value(F.col("mm_rid") % 3, {0: "SMC Box", 1: "Service Cable"}).alias("mat_subcategory"),
    )


def install_outbox(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("int").alias("distnid"),
        text('{"serialNumber": "MT', k(), '"}').alias("request"),
        F.when((kind == "view") & (k() < 3), False).when(kind == "purchase", True).alias("status"),
        F.when(k() % 2 == 0, 106).otherwise(105).alias("type_id"),
    )


def device_current_sims(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "supplier").select(
        text("MT", F.col("s_suppkey")).alias("serial_number"), text("SIM", F.col("s_nationkey")).alias("sim_no")
    )


def installs(spark, sf_dir) -> dict[str, DataFrame]:
    tables: list[Callable] = [
        responses, users, resurvey_flags, receipt_log, materials, material_ids, install_outbox,
    ]
    found = {table.__name__: table(spark, sf_dir) for table in tables}
    return {**found, "device_current": device_current_sims(spark, sf_dir)}


def swap_requests(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.col("event_id").alias("swapid"),
        F.col("user_id").cast("int").alias("distnid"),
        text("MT", k()).alias("meternum"),
        kind.isin("purchase").alias("status"),
        F.when(kind == "click", "consumer swap").otherwise("delete").alias("remarks"),
    )


def swap_outbox(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("distnid"),
        text('{"serialNumber": "MT', k(), '"}').alias("request"),
        F.when(kind == "signup", "delete").otherwise("consumer swap").alias("description"),
        ((kind == "error") | (k() >= 3)).alias("status"),
        F.when(kind == "signup", F.col("event_id") + 1).alias("pushlog_id"),
    )


def feeds(spark, sf_dir) -> dict[str, DataFrame]:
    customer, supplier, part = (given(spark, sf_dir, t) for t in ("customer", "supplier", "part"))
    return {
        "swap_requests": swap_requests(spark, sf_dir),
        "swap_outbox": swap_outbox(spark, sf_dir),
        "install_outbox": install_outbox(spark, sf_dir),
        "responses": responses(spark, sf_dir),
        "swap_src_installs": customer.select(
            text("N", F.col("c_custkey")).alias("distributionnodecode"),
            F.col("c_custkey").cast("int").alias("distributionnodeid"),
            F.col("c_name").alias("_19"),
            text("OLD", F.col("c_custkey")).alias("_354"),
        ),
        "swap_src_connections": supplier.select(
            text("C", F.col("s_suppkey")).alias("distributionnodecode"),
            F.col("s_suppkey").cast("int").alias("distributionnodeid"),
            F.col("s_name").alias("distributionnodename"),
        ),
        "swap_src_transformers": part.select(
            text("T", F.col("p_partkey")).alias("distributionnodecode"), F.col("p_partkey").cast("int").alias("distnid")
        ),
    }


# Ten stocks: five materials (the regions) at two contractors. The first five
# are there from the start, the others come into being with their first receipt.
def slot() -> Column:
    return F.col("user_id") % 10


def _stock_events(spark, sf_dir, serial: Callable[[], Column]) -> DataFrame:
    return spread(given(spark, sf_dir, "events")).select(
        (F.col("event_id") + 1).alias("seq"),
        F.col("user_id").cast("int").alias("doc_number"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("event_type"),
        k().alias("k"),
        text("mat", slot() % 5).alias("materialname"),
        (slot() % 5).cast("string").alias("materialcode"),
        F.when(slot() < 5, "1").otherwise("2").alias("vendor"),
        F.when(k() % 20 != 0, F.floor("value").cast("int")).alias("quantity"),
        serial().alias("serialno"),
        F.concat(F.lit('{"Device ID":"D'), F.col("event_id").cast("string"), F.lit('","SIM No":'), k().cast("string"), F.lit(',"HLS (US)":"h","LLS":null}')).alias("factoryfile"),
    )


def own_serial() -> Column:
    """Serials that lie in one stock only."""
    return text("S", slot(), "-", k())


def shared_serial() -> Column:
    """Serials that lie in several stocks."""
    return text("S", k())


def hot_serial() -> Column:
    """Serials that lie in several stocks, one of them with most events."""
    return text("S", F.when(k() % 10 < 7, 0).otherwise(k()))


def receipt_events(spark, sf_dir, serial: Callable[[], Column] = own_serial) -> DataFrame:
    kind = F.col("event_type")
    rows = _stock_events(spark, sf_dir, serial).where(kind.isin("purchase", "view", "click"))
    lower = (kind == "view") & (F.col("k") % 5 == 0)
    return rows.select(
        "seq",
        "doc_number",
        F.lit(1).alias("bu_rid"),
        F.col("day").alias("crvdate"),
        F.lit("r").alias("remarks"),
        F.lit("w").alias("warehousecode"),
        F.col("vendor").alias("contractorcode"),
        F.lit("d").alias("divisioncode"),
        "materialname",
        "materialcode",
        F.lit("EA").alias("uom"),
        F.lit("new").alias("stockcondition"),
        "quantity",
        F.when(lower, F.lower("serialno")).otherwise(F.col("serialno")).alias("serialno"),
        F.when(F.col("k") % 7 != 0, F.col("factoryfile")).alias("factoryfile"),
        F.when(kind == "click", "non-serialized").otherwise("serialized").alias("type"),
    )


def return_events(spark, sf_dir, serial: Callable[[], Column] = own_serial) -> DataFrame:
    kind = F.col("event_type")
    rows = _stock_events(spark, sf_dir, serial).where(kind.isin("error", "signup"))
    return rows.select(
        "seq",
        "doc_number",
        F.col("day").alias("cridate"),
        F.lit("r").alias("remarks"),
        F.col("vendor").alias("fromcontractorcode"),
        "materialname",
        "materialcode",
        F.lit("EA").alias("uom"),
        F.lit("new").alias("stockcondition"),
        "quantity",
        "serialno",
        F.when(kind == "signup", "non-serialized").otherwise("serialized").alias("type"),
    )


def odd_events(events: DataFrame, contractor: str) -> DataFrame:
    """Events of which some name no known contractor or material, no serial, or a type that is none."""
    seq = F.col("seq")
    return events.withColumns(
        {
            contractor: F.when(seq % 11 == 0, "0").otherwise(F.col(contractor)),
            "materialname": F.when(seq % 13 != 0, F.col("materialname")),
            "serialno": F.when(seq % 17 != 0, F.col("serialno")),
            "type": F.when(seq % 19 == 0, "on loan").otherwise(F.col("type")),
        }
    )


def stock_state(spark, sf_dir) -> dict[str, DataFrame]:
    region, nation = given(spark, sf_dir, "region"), given(spark, sf_dir, "nation")
    key = F.col("r_regionkey")
    none = F.lit(None)
    return {
        "materials": region.select(
            (key + 100).cast("long").alias("mm_rid"), text("mat", key).alias("name"), key.cast("string").alias("code")
        ),
        "contractors": given(spark, sf_dir, "supplier").select(
            (F.col("s_suppkey") + 1).cast("int").alias("contact_rid"),
            (F.col("s_suppkey") + 1).cast("string").alias("vendor_code"),
        ),
        "stock": region.select(
            (key + 1).cast("long").alias("stock_rid"),
            (key + 100).cast("long").alias("mat_rid"),
            F.lit(0).cast("decimal(18,4)").alias("price"),
            F.lit(800).alias("stock_condition_index"),
            F.lit(1).alias("uom_rid"),
            F.when(key != 2, key).cast("decimal(38,4)").alias("qty"),
            F.lit(1).alias("holder_rid"),
            F.lit(2).alias("holder_type"),
            F.lit(20).alias("bu_rid"),
            F.lit(3).alias("group_rid"),
            none.cast("timestamp").alias("created_datetime"),
        ),
        "stock_serials": nation.select(
            (F.col("n_regionkey") + 1).cast("long").alias("stock_rid"),
            (F.col("n_regionkey") + 100).cast("long").alias("mat_rid"),
            text("S", F.col("n_regionkey"), "-", F.col("n_nationkey")).alias("serial_no"),
            F.lit(0).alias("make_rid"),
        ),
    }


def stock_logs(spark, sf_dir) -> dict[str, DataFrame]:
    """Documents logged before: receipts and returns of the parts' serials."""
    part = given(spark, sf_dir, "part")
    serial = text("S", F.col("p_partkey") % 10, "-", F.col("p_size"))
    return {
        "receipt_log": part.select(
            serial.alias("serialno"),
            F.col("p_partkey").cast("int").alias("documentnumber"),
            (F.col("p_partkey") % 5).cast("string").alias("materialcode"),
            F.when(F.col("p_size") > 25, "serialized").otherwise("non-serialized").alias("type"),
        ),
        "return_log": part.select(
            serial.alias("serial_num"),
            F.col("p_partkey").cast("int").alias("doc_num"),
            (F.col("p_partkey") % 5).cast("string").alias("materialcode"),
            F.when(F.col("p_size") > 25, "serialized").otherwise("non-serialized").alias("type"),
        ),
    }


def device_current(spark, sf_dir) -> DataFrame:
    from fieldsync.config import DEVICE_ATTRIBUTES

    serial = text("S", F.col("p_partkey") % 10, "-", F.col("p_size"))
    values = {"device_id": text("P", F.col("p_partkey")), "sim_no": F.col("p_size").cast("string"), "meter_make": F.col("p_brand")}
    return given(spark, sf_dir, "part").select(
        serial.alias("serial_number"),
        *[values.get(c, F.lit(None)).cast("string").alias(c) for c in DEVICE_ATTRIBUTES.values()],
        F.lit("factory").alias("type_source"),
    )


def contractor_events(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    return given(spark, sf_dir, "customer").select(
        (key + 1).alias("seq"),
        text("V", key).alias("vendor_code"),
        F.when(F.col("c_acctbal") > -900, text(F.col("c_mktsegment"), " ", F.col("c_nationkey"))).alias("firm_name"),
        F.col("c_name").alias("search_term"),
        text("9", key).alias("mobileno"),
        text("street ", key).alias("address"),
    )


def known_contractors(spark, sf_dir) -> DataFrame:
    return given(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("contact_rid"), text("MACHINERY ", F.col("s_nationkey")).alias("firm_name")
    )


def material_events(spark, sf_dir) -> DataFrame:
    size = F.col("p_size")
    return given(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("seq"),
        F.when(size != 50, text("unit ", size)).alias("uom"),
        F.col("p_brand").alias("matcat"),
        text(F.col("p_type"), " ", size % 7).alias("matsubcat"),
        F.col("p_name").alias("matname"),
        F.col("p_brand").alias("matcode"),
        text("size ", size).alias("mat_description"),
        text("V", size).alias("sap_vendorcode"),
        F.col("p_type").alias("sap_oemname"),
        F.lit("EA").alias("deliverynoteunit"),
        F.lit("each").alias("unitdesc"),
        F.when(size > 25, "true").otherwise("TRUE").alias("serialised"),
        F.when(size % 2 == 0, text(size)).alias("hsncode"),
    )


def material_state(spark, sf_dir) -> dict[str, DataFrame]:
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return {
        "uom_groups": nation.select(key.cast("long").alias("ug_rid"), text("unit ", key * 2).alias("name")),
        "uoms": nation.select(key.cast("long").alias("uom_rid"), text("unit ", key).alias("name")),
        "material_categories": region.select(
            (F.col("r_regionkey") + 1).cast("long").alias("mc_rid"), text("Brand#", F.col("r_regionkey") * 2).alias("title")
        ),
        "material_subcategories": nation.select(
            key.cast("long").alias("msc_rid"), text("PROMO ", F.col("n_regionkey")).alias("title")
        ),
        "materials": nation.select(
            key.cast("long").alias("mm_rid"), F.lit("red widget").alias("name"), text("Brand#", key).alias("code")
        ),
    }
