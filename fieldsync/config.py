"""Job settings: keys, codes and labels that the jobs filter on or write."""

from __future__ import annotations

from dataclasses import dataclass, field

# Attribute -> (member of the property value, property ids).
INSTALL_PROPERTIES: dict[str, tuple[str, tuple[int, ...]]] = {
    "meternum": ("meter_Id", (57, 908, 624, 1489, 1787, 1633)),
    "oldmeternum": ("value", (354, 530, 645, 1625, 1300, 1781, 993, 984)),
    "bodyseal1": ("seal_number", (68, 956, 952, 2021, 1640)),
    "bodyseal2": ("seal_number", (359, 958, 954, 2027, 1641)),
    "boxseal1": ("seal_number", (70, 575, 633)),
    "boxseal2": ("seal_number", (71, 576, 634)),
    "termseal1": ("seal_number", (67, 568, 630)),
    "termseal2": ("seal_number", (203, 569, 631)),
    "cablelength": ("value", (941, 797, 943)),
    "barcode": ("value", (674, 650)),
}

# Property ids that carry the meter in a removal survey.
REMOVAL_METER_PROPERTIES = (57, 908, 624, 1489, 1633, 1787)

# Member of the attribute document -> column.
DEVICE_ATTRIBUTES: dict[str, str] = {
    "Device ID": "device_id",
    "Meter Make": "meter_make",
    "Meter Type": "meter_type",
    "Phase": "phase",
    "Current Rating": "current_rating",
    "Utility Name": "utility_name",
    "Meter FW Version": "meter_fw_version",
    "Manufacturing Month Year": "manufacturing_month_year",
    "Display Digits Length": "display_digits_length",
    "Meter Body Seal 1": "meter_body_seal_1",
    "Meter Body Seal 2": "meter_body_seal_2",
    "Communication medium": "communication_medium",
    "ModuleMake-Model": "modulemake_model",
    "Module FW ver": "module_fw_ver",
    "IMEI Number(Cellular)RF": "imei_number_cellular_rf",
    "IMSI Number(SIM)": "imsi_number_sim",
    "SIM No": "sim_no",
    "SIM IP address": "sim_ip_address",
    "HES Service": "hes_service",
    "HES Server IP": "hes_server_ip",
    "TCP Port": "tcp_port",
    "APN": "apn",
    "EK": "ek",
    "HLS (US)": "hls_us",
    "HLS (FW)": "hls_fw",
    "LLS": "lls",
    "AK": "ak",
    "Meter Nic Seal 1": "meter_nic_seal_1",
    "Meter Nic Seal 2": "meter_nic_seal_2",
    "Loose Seal 1": "loose_seal_1",
    "Loose Seal 2": "loose_seal_2",
    "Loose Seal 3": "loose_seal_3",
    "Loose Seal 4": "loose_seal_4",
    "Loose Seal 5": "loose_seal_5",
    "Loose Seal 6": "loose_seal_6",
}

# Message type of each outbox row.
CREATE_TECHNICIAN = 100
CONTRACTOR_CREATED = 102
CONTRACTOR_UPDATED = 103
TECHNICIAN_UPDATED = 104
METER_SWAP = 105
METER_INSTALL = 106
METER_DELETE = 108

# Names of the two kinds of stock movement.
SERIALISED = "serialized"
BULK = "non-serialized"


@dataclass(frozen=True)
class Labels:
    """Names the receiving systems expect. Set them to what your receiver uses."""

    source: str = "hub"
    account_member: str = "isPlatformAccount"
    attribute_source: str = "hub"


@dataclass(frozen=True)
class InstallConfig:
    # Fixed values.
    activities: tuple[int, ...] = (72, 3, 44, 46, 11, 12, 10)
    category_by_node_type: tuple[tuple[int, str], ...] = ((1, "Consumer"), (7, "DT"), (6, "Feeder"))
    sub_category_by_activity: tuple[tuple[tuple[int, ...], str], ...] = (
        ((72, 44, 46), "MI"),
        ((3,), "NSC"),
        ((10, 11, 12), "ONM"),
    )
    repush_project: int = 19
    repush_skipped_activities: tuple[int, ...] = (-1, 81)
    box_sub_category: str = "SMC Box"
    cable_sub_category: str = "Service Cable"
    properties: dict = field(default_factory=lambda: dict(INSTALL_PROPERTIES))
    # The greatest of several texts is found by this collation of Spark, such as `UNICODE`; None compares bytes.
    collation: str | None = None


@dataclass(frozen=True)
class PeopleConfig:
    # Fixed values.
    company: int = 3
    contractor_project: int = 20
    contractor_category: int = 753
    technician_roles: tuple[int, ...] = (2, 26, 28, 79, 80, 65)
    active: int = 1
    labels: Labels = field(default_factory=Labels)


@dataclass(frozen=True)
class FeedConfig:
    # Fixed values.
    removal_project: int = 999
    delete_remark: str = "delete"
    swap_remark: str = "consumer swap"
    meter_properties: tuple[int, ...] = REMOVAL_METER_PROPERTIES


@dataclass(frozen=True)
class StockConfig:
    # What a stock row made by a receipt carries.
    condition: int = 800
    uom: int = 1
    holder_type: int = 2
    bu: int = 20
    group: int = 3
    labels: Labels = field(default_factory=Labels)


@dataclass(frozen=True)
class DimensionConfig:
    # What a new dimension row carries.
    group: int = 3
    status: int = 1
    created_by: int = 907
