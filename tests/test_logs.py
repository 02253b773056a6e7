import json

from fieldsync.config import DEVICE_ATTRIBUTES, Labels, StockConfig
from fieldsync.plans.stock import device_attributes_replace, receipt_log_delta, return_log_delta, stock_sync


def receipt(seq, serial, document=1, kind="serialized", **other):
    return dict(dict(seq=seq, serialno=serial, doc_number=document, type=kind, crvdate="2024-01-02", contractorcode="7", materialcode="c"), **other)


def test_receipt_log(make):
    log = make("receipt_log", dict(serialno="KNOWN", documentnumber=1, type="serialized"), dict(documentnumber=9, materialcode="c", type="non-serialized"))
    events = make(
        "receipt_events",
        receipt(1, "KNOWN"),
        receipt(2, "KNOWN", 2),
        receipt(3, "A"),
        receipt(4, "A"),
        receipt(5, "a"),
        receipt(6, "a"),
        receipt(7, "b"),
        receipt(8, "B"),
        receipt(9, "N", None),
        receipt(10, "N", None),
        receipt(11, None),
        receipt(12, None),
        receipt(13, None, 9, "non-serialized"),
        receipt(14, None, 8, "non-serialized"),
        receipt(15, None, 8, "non-serialized"),
        receipt(16, None, None, "non-serialized"),
        receipt(17, None, None, "non-serialized"),
        receipt(18, "X", 1, "other"),
    )
    logged = receipt_log_delta(events, log)
    assert sorted(r["seq"] for r in logged.collect()) == [2, 3, 5, 6, 7, 9, 10, 11, 12, 14, 16, 17]
    row = logged.where("seq = 5").first()
    assert (row["serialno"], row["contractorcode"], str(row["crvdate"]), row["wh_activity"]) == ("A", 7, "2024-01-02", "CRV")


def test_return_log(make):
    log = make("return_log", dict(serial_num="KNOWN", doc_num=1, type="serialized"))

    def back(seq, serial, document=1, kind="serialized"):
        return dict(seq=seq, serialno=serial, doc_number=document, type=kind, cridate="2024-01-02", materialcode="c")

    events = make("return_events", back(1, "KNOWN"), back(2, "a"), back(3, "A"), back(4, "a"), back(5, None), back(6, None), back(7, "q", 3, "non-serialized"), back(8, "r", 3, "non-serialized"))
    logged = return_log_delta(events, log)
    assert sorted(r["seq"] for r in logged.collect()) == [2, 3, 5, 6, 7]
    row = logged.where("seq = 2").first()
    assert (row["serial_num"], row["cridate"], row["wh_activity"]) == ("a", "2024-01-02", "CRI")


def test_device_attributes(make):
    current = make("device_current", dict(serial_number="A", device_id="old", type_source="factory"), dict(serial_number="Z", device_id="stays", type_source="factory"))
    document = {name: f"v{i}" for i, name in enumerate(DEVICE_ATTRIBUTES)}
    events = make(
        "receipt_events",
        receipt(1, "a", factoryfile=json.dumps({"Device ID": "first"})),
        receipt(2, "A", 2, factoryfile=json.dumps(document)),
        receipt(3, "A", 2, factoryfile=json.dumps({"Device ID": "replay"})),
        receipt(4, "E", factoryfile=""),
        receipt(5, None, factoryfile=json.dumps({"Device ID": "n"})),
        receipt(6, "A", 3, kind="non-serialized", factoryfile="{}"),
    )
    logged = receipt_log_delta(events, make("receipt_log"))
    out = device_attributes_replace(current, events, logged, StockConfig(labels=Labels(attribute_source="tag")))
    now = {(r["serial_number"], r["device_id"], r["type_source"]) for r in out["current"].collect()}
    assert now == {("A", "v0", "tag"), ("Z", "stays", "factory"), ("E", None, "tag"), (None, "n", "tag")}
    past = [(r["serial_number"], r["device_id"], r["type_source"]) for r in out["history"].collect()]
    assert sorted(past) == [("A", "first", "tag"), ("A", "old", "factory")]
    row = out["current"].where("serial_number = 'A'").first().asDict()
    assert [row[c] for c in DEVICE_ATTRIBUTES.values()] == [f"v{i}" for i in range(35)]


def test_stock_sync_gives_every_output(make):
    inputs = {
        "stock": make("stock"),
        "stock_serials": make("stock_serials"),
        "materials": make("materials", dict(mm_rid=1, name="m", code="c")),
        "contractors": make("contractors", dict(contact_rid=7, vendor_code="7")),
        "receipt_log": make("receipt_log"),
        "return_log": make("return_log"),
        "device_current": make("device_current"),
    }
    receipts = make("receipt_events", receipt(1, "A", materialname="m"), receipt(3, "B", materialname="m"))
    returns = make("return_events", dict(seq=2, serialno="A", doc_number=1, type="serialized", cridate="2024-01-02"))
    out = stock_sync(inputs, receipts, returns)
    assert [r["serial_no"] for r in out["stock_serials"].collect()] == ["B"]
    assert [int(r["qty"]) for r in out["stock"].collect()] == [1]
    assert out["receipt_log"].count() == 2 and out["return_log"].count() == 1
    assert out["device_current"].count() == 2 and out["rejected"].count() == 0
