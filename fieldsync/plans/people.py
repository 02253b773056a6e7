"""Contractor and technician messages: who is new, who has changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.config import (
    CONTRACTOR_CREATED,
    CONTRACTOR_UPDATED,
    CREATE_TECHNICIAN,
    TECHNICIAN_UPDATED,
    PeopleConfig,
)
from fieldsync.functions.documents import payload
from fieldsync.functions.text import differs, spaced_name, true_false
from fieldsync.operators.keyed import absent, latest_per_key, present
from fieldsync.sources.staging import stage

Inputs = dict[str, DataFrame]


def contractor_candidates(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Contractors of the category with the login and role of who is in charge.

    The two map tables only have to hold a matching row, so they are semi-joins
    and add no copies.
    """
    users = inputs["users"].where(F.col("companyid") == cfg.company)
    projects = inputs["user_projects"].where(F.col("projectid") == cfg.contractor_project)
    categories = inputs["contractor_categories"].where(F.col("contact_category_index") == cfg.contractor_category)
    mapped = inputs["user_contractors"].select(F.col("user_rid").alias("incharge_user_rid"))

    logins = (
        users.select("userid", "username", "mobileno", "alternative_emailid", "date_of_birth", "status")
        .join(projects.select("userid", "roleid"), "userid")
        .join(inputs["roles"].select("roleid", "discription"), "roleid")
        .withColumnRenamed("userid", "incharge_user_rid")
    )
    contractors = inputs["contractors"].select("contact_rid", "vendor_code", "incharge_user_rid")
    wanted = present(present(contractors, categories, ["contact_rid"]), mapped, ["incharge_user_rid"])
    return wanted.join(logins, "incharge_user_rid")


def _contractor_fields(cfg: PeopleConfig, division: bool) -> list[Column]:
    fields = [
        F.col("contact_rid").alias("uniqueId"),
        F.col("vendor_code").alias("agencyCode"),
        F.col("username").alias("userName"),
        F.col("mobileno").alias("mobileNo"),
        F.col("alternative_emailid").alias("emailAddress"),
        F.col("discription").alias("role"),
        F.lit("false").alias(cfg.labels.account_member),
        F.lit("").alias("password"),
        F.col("date_of_birth").alias("dob"),
        true_false(F.col("status") == cfg.active).alias("isActive"),
        F.lit(cfg.labels.source).alias("Source"),
    ]
    return fields + [F.lit("").alias("division")] if division else fields


def _contractor_messages(rows: DataFrame, cfg: PeopleConfig, division: bool) -> DataFrame:
    fields = _contractor_fields(cfg, division)
    keys = [
        F.col("contact_rid").alias("contractorid"),
        F.col("roleid"),
        F.col("incharge_user_rid").alias("inchargeid"),
    ]
    # Distinct on the typed values; the text is built from what is left.
    distinct = rows.select(*keys, F.struct(*fields).alias("_payload")).distinct()
    return distinct.select(
        "contractorid",
        "roleid",
        "inchargeid",
        F.to_json("_payload", {"ignoreNullFields": "false"}).alias("request"),
    )


def contact_create_delta(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Contractors that were never logged as inserted."""
    logged = inputs["contractor_outbox"].where(F.col("inserted")).select(F.col("contractorid").alias("contact_rid"))
    rows = absent(contractor_candidates(inputs, cfg), logged, ["contact_rid"])
    return _contractor_messages(rows, cfg, division=True).select(
        "*",
        F.lit("Contractor Created").alias("description"),
        F.lit(CONTRACTOR_CREATED).alias("type_id"),
        F.lit(True).alias("inserted"),
    )


def contact_update_delta(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Contractors whose role or in-charge is not that of their newest log row."""
    candidates = stage(contractor_candidates(inputs, cfg), "contractors")
    log = inputs["contractor_outbox"].where(F.col("inserted") | F.col("updated"))
    # Of the log only what concerns the candidates is looked through for newest rows.
    log = present(log, candidates.select(F.col("contact_rid").alias("contractorid")), ["contractorid"])
    newest = latest_per_key(
        log.select("contractorid", "api_id", F.col("roleid").alias("old_role"), F.col("inchargeid").alias("old_incharge")),
        ["contractorid"],
        "api_id",
        ["old_role", "old_incharge"],
    ).withColumnRenamed("contractorid", "contact_rid")
    changed = differs(
        [(F.col("old_role"), F.col("roleid")), (F.col("old_incharge"), F.col("incharge_user_rid"))]
    )
    rows = candidates.join(newest, "contact_rid").where(changed)
    return _contractor_messages(rows, cfg, division=False).select(
        "*",
        F.lit("Contractor Updated").alias("description"),
        F.lit(CONTRACTOR_UPDATED).alias("type_id"),
        F.lit(True).alias("updated"),
    )


def technician_candidates(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Technicians of the company with their role and active contractor."""
    users = inputs["users"].where(F.col("companyid") == cfg.company)
    roles = inputs["user_projects"].where(F.col("roleid").isin(*cfg.technician_roles))
    contractors = inputs["contractors"].where(F.col("status") == cfg.active)
    return (
        users.select(
            "userid",
            "username",
            spaced_name(F.col("FirstName"), F.col("LastName")).alias("uname"),
            "mobileno",
            "alternative_emailid",
            "date_of_birth",
        )
        .join(roles.select("userid", "roleid"), "userid")
        .join(inputs["user_contractors"].withColumnRenamed("user_rid", "userid"), "userid")
        .join(contractors.select("contact_rid", "firm_name", "vendor_code", "incharge_user_rid"), "contact_rid")
    )


def _technician_messages(rows: DataFrame, inputs: Inputs) -> DataFrame:
    in_charge = inputs["users"].select(
        F.col("userid").alias("incharge_user_rid"), F.col("username").alias("incharge_login")
    )
    fields = F.struct(
        F.col("username").alias("technician_Id"),
        F.col("uname").alias("name"),
        F.col("mobileno").alias("mobile_number"),
        F.col("alternative_emailid").alias("email_address"),
        F.lit("").alias("password"),
        F.col("firm_name").alias("contractorName"),
        F.col("vendor_code").alias("contractorId"),
        F.col("incharge_login").alias("contractorLoginId"),
        F.struct(F.lit("").alias("location"), F.lit("").alias("date")).alias("subdivision"),
        F.col("date_of_birth").alias("dob"),
    )
    distinct = (
        rows.join(in_charge, "incharge_user_rid", "left")
        .select("userid", F.col("contact_rid").alias("contactid"), "roleid", fields.alias("_payload"))
        .distinct()
    )
    return distinct.select(
        "userid", "contactid", "roleid", F.to_json("_payload", {"ignoreNullFields": "false"}).alias("request")
    )


def technician_create_delta(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Technicians without a log row that is done or open.

    Done and open are the two values of one flag, so one anti-join on the rows
    that have the flag at all does for both.
    """
    logged = inputs["technician_outbox"].where(F.col("status_created").isNotNull())
    rows = absent(technician_candidates(inputs, cfg), logged, ["userid"])
    return _technician_messages(rows, inputs).select(
        "*",
        F.lit("Create Technician").alias("description"),
        F.lit(CREATE_TECHNICIAN).alias("type_id"),
        F.lit(True).alias("inserted"),
    )


def technician_update_delta(inputs: Inputs, cfg: PeopleConfig = PeopleConfig()) -> DataFrame:
    """Technicians whose role or contractor is not that of their newest log row, unless one is open."""
    candidates = stage(technician_candidates(inputs, cfg), "technicians")
    outbox = present(inputs["technician_outbox"], candidates, ["userid"])
    log = outbox.where(F.col("inserted") | F.col("updated"))
    newest = latest_per_key(
        log.select("userid", "api_id", F.col("roleid").alias("old_role"), F.col("contactid").alias("old_contact")),
        ["userid"],
        "api_id",
        ["old_role", "old_contact"],
    )
    changed = differs([(F.col("old_role"), F.col("roleid")), (F.col("old_contact"), F.col("contact_rid"))])
    rows = candidates.join(newest, "userid").where(changed)
    rows = absent(rows, outbox.where(F.col("status_created") == False), ["userid"])  # noqa: E712
    return _technician_messages(rows, inputs).select(
        "*",
        F.lit("Technician Updated").alias("description"),
        F.lit(TECHNICIAN_UPDATED).alias("type_id"),
        F.lit(True).alias("updated"),
    )
