"""Contractor and material upserts from ordered events.

Every event sees what the events before it created. The set form of that is
"unknown before the batch, and first of its key within it". New ids are the
highest known id plus the event's `seq`: unique, in order of creation, the
same on every recomputation, and found without a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.config import DimensionConfig
from fieldsync.functions.text import or_blank
from fieldsync.operators.keyed import absent, all_known, highest, lowest_id, new_first_per_key
from fieldsync.sources.staging import stage

Inputs = dict[str, DataFrame]


def _new_id(known: DataFrame, id_column: str, seq: Column) -> Column:
    return F.lit(highest(known, id_column)).cast("long") + seq


def contractor_upsert(inputs: Inputs, events: DataFrame, cfg: DimensionConfig = DimensionConfig()) -> DataFrame:
    """New contractor rows, one per firm name that is not known yet."""
    contractors = inputs["contractors"]
    new = new_first_per_key(events, contractors, ["firm_name"], "seq")
    blank = F.lit("")
    return new.select(
        _new_id(contractors, "contact_rid", F.col("seq")).alias("contact_rid"),
        "firm_name",
        F.col("search_term").alias("contact_person"),
        blank.alias("email"),
        F.col("mobileno").alias("mobile"),
        blank.alias("office_contact"),
        "address",
        blank.alias("image_url"),
        F.lit(cfg.group).alias("group_rid"),
        F.lit(cfg.status).alias("status"),
        F.lit(cfg.created_by).alias("created_user_rid"),
        F.current_timestamp().alias("created_datetime"),
        "vendor_code",
        blank.alias("alternate_contact"),
        blank.alias("website"),
        F.lit(0).alias("type_of_org"),
        F.lit(0).alias("incharge_user_rid"),
        F.lit("[]").alias("data_json"),
    )


def _resolve(events: DataFrame, known: DataFrame, key: str, known_key: str, id_column: str, name: str) -> DataFrame:
    """Add the known id as `name`, and as `name_by` the seq of the event that creates the missing one."""
    ids = lowest_id(known, [known_key], id_column).select(
        F.col(known_key).alias(key), F.col(id_column).alias(name)
    )
    found = events.join(ids, key, "left")
    creators = found.where(F.col(name).isNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min("seq").alias("_by"))
    by = F.when(F.col(name).isNull(), F.coalesce(F.col("_by"), F.col("seq")))
    return found.join(creators, key, "left").withColumn(f"{name}_by", by).drop("_by")


def material_upsert(
    inputs: Inputs, events: DataFrame, cfg: DimensionConfig = DimensionConfig()
) -> dict[str, DataFrame]:
    """New rows of materials, their ids, unit groups, units, categories and sub-categories.

    Kept as the source system has it: the new unit is named after the category
    text; a sub-category is only ever created together with a category; the
    default unit of a material is its unit group; the vendor code lands in the
    OEM column and the OEM name in the SAP column.
    """
    base = {
        name: highest(inputs[name], id_column)
        for name, id_column in (
            ("uom_groups", "ug_rid"),
            ("uoms", "uom_rid"),
            ("material_categories", "mc_rid"),
            ("material_subcategories", "msc_rid"),
            ("materials", "mm_rid"),
        )
    }

    def made(table: str, seq: str) -> Column:
        return F.lit(base[table]).cast("long") + F.col(seq)

    known = inputs["materials"].select(F.col("name").alias("matname"), F.col("code").alias("matcode"))
    accepted = stage(new_first_per_key(events, known, ["matname", "matcode"], "seq"), "accepted-materials")
    with_unit = _resolve(accepted, inputs["uom_groups"], "uom", "name", "ug_rid", "known_group")
    with_category = _resolve(with_unit, inputs["material_categories"], "matcat", "title", "mc_rid", "known_category")

    resolved = stage(
        with_category.withColumn("makes_group", F.coalesce(F.col("known_group_by") == F.col("seq"), F.lit(False)))
        .withColumn("makes_category", F.coalesce(F.col("known_category_by") == F.col("seq"), F.lit(False)))
        .withColumn("group_id", F.coalesce("known_group", made("uom_groups", "known_group_by")))
        .withColumn("category_id", F.coalesce("known_category", made("material_categories", "known_category_by"))),
        "resolved-materials",
    )

    # A sub-category is known from before, made by this event, or by an earlier one.
    subs = lowest_id(inputs["material_subcategories"], ["title"], "msc_rid").select(
        F.col("title").alias("matsubcat"), F.col("msc_rid").alias("known_sub")
    )
    sub_makers = (
        resolved.where(F.col("makes_category") & all_known(["matsubcat"]))
        .groupBy("matsubcat")
        .agg(F.min("seq").alias("sub_by"))
    )
    complete = (
        resolved.join(subs, "matsubcat", "left")
        .join(sub_makers, "matsubcat", "left")
        .withColumn(
            "sub_id",
            F.when(F.col("makes_category"), made("material_subcategories", "seq"))
            .when(F.col("known_sub").isNotNull(), F.col("known_sub"))
            .when(F.col("sub_by") < F.col("seq"), made("material_subcategories", "sub_by")),
        )
    )

    now = F.current_timestamp().alias("created_datetime")
    status, created_by = F.lit(cfg.status).alias("status"), F.lit(cfg.created_by).alias("created_user_rid")
    zero, blank = F.lit(0), F.lit("")
    makes_group, makes_category = resolved.where("makes_group"), resolved.where("makes_category")
    return {
        "uom_groups": makes_group.select(
            made("uom_groups", "seq").alias("ug_rid"),
            F.col("uom").alias("name"),
            blank.alias("description"),
            F.lit(cfg.group).alias("group_rid"),
            status,
            F.lit(1).alias("def_uom_rid"),
        ),
        "uoms": makes_group.select(
            made("uoms", "seq").alias("uom_rid"),
            F.col("matcat").alias("name"),
            made("uom_groups", "seq").alias("ug_rid"),
            status,
            zero.alias("is_whole_number"),
        ),
        "material_categories": makes_category.select(
            made("material_categories", "seq").alias("mc_rid"),
            F.col("matcat").alias("title"),
            blank.alias("code"),
            status,
            created_by,
            now,
        ),
        "material_subcategories": makes_category.select(
            made("material_subcategories", "seq").alias("msc_rid"),
            made("material_categories", "seq").alias("mc_rid"),
            F.col("matsubcat").alias("title"),
            blank.alias("code"),
            status,
            created_by,
            now,
        ),
        "materials": complete.select(
            made("materials", "seq").alias("mm_rid"),
            F.col("matname").alias("name"),
            F.col("matcode").alias("code"),
            F.col("mat_description").alias("description"),
            F.col("group_id").alias("uom_group_rid"),
            or_blank(F.col("hsncode")).alias("hsn_code"),
            F.col("category_id").alias("mc_rid"),
            F.col("sub_id").alias("msc_rid"),
            F.lit(cfg.group).alias("group_rid"),
            zero.alias("is_set"),
            zero.alias("is_global"),
            F.when(F.col("serialised") == "true", 1).otherwise(0).alias("serial_flag"),
            status,
            created_by,
            now,
            zero.alias("code_part_type"),
            zero.alias("has_make"),
            blank.alias("short_name"),
            zero.alias("has_labour"),
            zero.alias("is_box_serial"),
            F.lit(None).cast("int").alias("gst_slab"),
            *[zero.cast("decimal(10,4)").alias(tax) for tax in ("sgst", "cgst", "igst")],
            F.col("group_id").alias("default_uom_rid"),
        ),
        "material_ids": resolved.select(
            made("materials", "seq").alias("mat_rid"),
            F.col("sap_vendorcode").alias("smcbox_oemid"),
            F.col("sap_oemname").alias("smcbox_sapid"),
        ),
    }
