"""One audit text per event: a label and the arguments joined with slashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Arguments of each event, in call order.
ARGUMENTS = {
    "receipt_events": [
        "doc_number", "bu_rid", "crvdate", "remarks", "warehousecode", "contractorcode",
        "divisioncode", "materialname", "materialcode", "uom", "stockcondition", "quantity",
        "serialno", "factoryfile", "type",
    ],
    "contractor_events": ["vendor_code", "firm_name", "search_term", "mobileno", "address"],
    "material_events": [
        "uom", "matcat", "matsubcat", "matname", "matcode", "mat_description", "sap_vendorcode",
        "sap_oemname", "deliverynoteunit", "unitdesc", "serialised", "hsncode",
    ],
}

# Attribute documents carry device keys and stay out of the audit.
MASKED = ("factoryfile",)


def audit_append(events: DataFrame, label: str, arguments: list[str], masked: tuple[str, ...] = MASKED) -> DataFrame:
    """(fntext, created). One NULL argument makes the whole text NULL."""
    parts = [F.lit(label)]
    for i, name in enumerate(arguments):
        value = F.col(name).cast("string")
        if name in masked:
            value = F.when(value.isNotNull(), F.lit("***"))
        parts += [value] if i == 0 else [F.lit("/"), value]
    return events.select(F.concat(*parts).alias("fntext"), F.current_timestamp().alias("created"))
