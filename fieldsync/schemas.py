"""Declared schemas of every table and event the jobs read. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType

from fieldsync.config import DEVICE_ATTRIBUTES

_ATTRIBUTES = ", ".join(f"{column} string" for column in DEVICE_ATTRIBUTES.values())

_LOG_FLAGS = (
    "source string, request_url string, request string, response string, description string, "
    "status_created boolean, status_updated boolean, created_datetime timestamp_ntz, "
    "inserted boolean, updated boolean, type_id int, push_datetime timestamp_ntz"
)

TABLES: dict[str, str] = {
    # Outboxes, logs and landings.
    "install_outbox": (
        "id long, distnid int, distributionnodecode string, request string, response string, "
        "description string, status boolean, created_datetime timestamp_ntz, type_id int, "
        "push_datetime timestamp_ntz, serial_number string"
    ),
    "swap_outbox": (
        "swap_id long, distnid int, distributionnodecode string, source string, request string, "
        "response string, description string, status boolean, created_datetime timestamp_ntz, "
        "type_id int, push_datetime timestamp_ntz, pushlog_id long, serial_number string"
    ),
    "swap_requests": (
        "swapid long, distnid int, consumer_number string, meternum string, status boolean, "
        "createddatetime timestamp_ntz, remarks string"
    ),
    "contractor_outbox": f"api_id long, contractorid int, roleid int, inchargeid int, {_LOG_FLAGS}",
    "technician_outbox": f"api_id long, userid int, roleid int, contactid int, {_LOG_FLAGS}",
    "receipt_log": (
        "crvid long, documentnumber int, crvdate date, remarks string, warehousecode string, "
        "contractorcode int, divisioncode string, materialname string, materialcode string, "
        "uom string, stockcondition string, quantity int, serialno string, type string, "
        "wh_activity string, createddatetime timestamp_ntz"
    ),
    "return_log": (
        "criid long, doc_num int, cridate string, remarks string, fromcontractorcode string, "
        "materialname string, materialcode string, uom string, stock_condition string, "
        "quantity int, serial_num string, type string, wh_activity string, "
        "createddatetime timestamp_ntz"
    ),
    "material_ids": (
        "imm_id long, mat_rid long, smcbox_oemid string, smcbox_sapid string, "
        "createddatetime timestamp_ntz, mat_subcategory string"
    ),
    "device_history": (
        f"history_id long, serial_number string, {_ATTRIBUTES}, devicecreation_mdm boolean, "
        "devicecreation_hes boolean, type_source string, created_datetime timestamp_ntz"
    ),
    "api_landing": (
        "crvid long, details string, type string, wh_activity string, "
        "createddatetime timestamp_ntz, response string, status boolean, document_number int"
    ),
    "master_landing": "mcd_id long, details string, activity_type string, createddatetime timestamp_ntz",
    "audit": "fntext string, created timestamp",
    "acknowledgement": "seq long, message_id long, status boolean, response string, push_datetime timestamp_ntz",
    # Operational tables.
    "responses": (
        "responselogid long, projectid int, activityid int, serveyorid int, response string, "
        "responsestatusid int, distcode string, distnid int, surveydate string, "
        "responsetime string, nodetype int"
    ),
    "resurvey_flags": "responseid long, resurvey int",
    "users": (
        "userid int, username string, FirstName string, LastName string, mobileno string, "
        "alternative_emailid string, companyid int, status int, date_of_birth date"
    ),
    "user_projects": "userid int, projectid int, roleid int",
    "roles": "roleid int, discription string",
    "contractors": (
        "contact_rid int, firm_name string, contact_person string, email string, mobile string, "
        "office_contact string, address string, image_url string, group_rid int, status int, "
        "created_user_rid int, created_datetime timestamp, vendor_code string, "
        "alternate_contact string, website string, type_of_org int, incharge_user_rid int, "
        "data_json string"
    ),
    "user_contractors": "user_rid int, contact_rid int",
    "contractor_categories": "contact_rid int, contact_category_index int",
    "stock": (
        "stock_rid long, mat_rid long, price decimal(18,4), stock_condition_index int, uom_rid int, "
        "qty decimal(38,4), holder_rid int, holder_type int, bu_rid int, group_rid int, "
        "created_datetime timestamp"
    ),
    "stock_serials": "stock_rid long, mat_rid long, serial_no string, make_rid int",
    "materials": (
        "mm_rid long, name string, code string, description string, uom_group_rid long, "
        "hsn_code string, mc_rid long, msc_rid long, group_rid int, is_set int, is_global int, "
        "serial_flag int, status int, created_user_rid int, created_datetime timestamp, "
        "code_part_type int, has_make int, short_name string, has_labour int, is_box_serial int, "
        "gst_slab int, sgst decimal(10,4), cgst decimal(10,4), igst decimal(10,4), "
        "default_uom_rid long"
    ),
    "uom_groups": "ug_rid long, name string, description string, group_rid int, status int, def_uom_rid int",
    "uoms": "uom_rid long, name string, ug_rid long, status int, is_whole_number int",
    "material_categories": (
        "mc_rid long, title string, code string, status int, created_user_rid int, "
        "created_datetime timestamp"
    ),
    "material_subcategories": (
        "msc_rid long, mc_rid long, title string, code string, status int, created_user_rid int, "
        "created_datetime timestamp"
    ),
    "device_current": f"serial_number string, {_ATTRIBUTES}, type_source string",
    "swap_src_installs": "distributionnodecode string, distributionnodeid int, _19 string, _354 string",
    "swap_src_connections": "distributionnodecode string, distributionnodeid int, distributionnodename string",
    "swap_src_transformers": "distributionnodecode string, distnid int",
    # Events. seq is positive and unique over all events of a run, and gives their order.
    "receipt_events": (
        "seq long, doc_number int, bu_rid int, crvdate string, remarks string, "
        "warehousecode string, contractorcode string, divisioncode string, materialname string, "
        "materialcode string, uom string, stockcondition string, quantity int, serialno string, "
        "factoryfile string, type string"
    ),
    "return_events": (
        "seq long, doc_number int, cridate string, remarks string, fromcontractorcode string, "
        "materialname string, materialcode string, uom string, stockcondition string, "
        "quantity int, serialno string, type string"
    ),
    "contractor_events": (
        "seq long, vendor_code string, firm_name string, search_term string, mobileno string, "
        "address string"
    ),
    "material_events": (
        "seq long, uom string, matcat string, matsubcat string, matname string, matcode string, "
        "mat_description string, sap_vendorcode string, sap_oemname string, "
        "deliverynoteunit string, unitdesc string, serialised string, hsncode string"
    ),
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])
