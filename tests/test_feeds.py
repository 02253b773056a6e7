import json

import pytest

from fieldsync.plans.feeds import install_delete_feed, meter_swap_feed
from tests.test_installs import meter, prop, survey


@pytest.fixture
def world(make):
    def build(requests=(), responses=(), pushed=(), log=(), sources=()):
        table = dict(sources)
        return {
            "swap_requests": make("swap_requests", *requests),
            "responses": make("responses", *responses),
            "install_outbox": make("install_outbox", *pushed),
            "swap_outbox": make("swap_outbox", *log),
            **{f"swap_src_{n}": make(f"swap_src_{n}", *table.get(n, ())) for n in ("installs", "connections", "transformers")},
        }

    return build


def removal(rid, node, document, **other):
    return dict(dict(responselogid=rid, projectid=999, responsestatusid=0, distnid=node, distcode=f"N{node}", response=document), **other)


def test_delete_feed(world):
    ask = [dict(swapid=i, distnid=n, status=s, remarks=r) for i, n, s, r in [(1, 1, False, "delete"), (2, 2, False, "delete"), (3, 3, False, "delete"), (4, 4, True, "delete"), (5, 5, False, "consumer swap"), (6, 6, False, "delete"), (7, 7, False, "delete"), (None, 1, False, "delete"), (9, 9, False, "delete")]]
    answers = [
        removal(1, 1, survey(prop("57", meter("B")), prop(908, "A"), prop(68, "C"))),
        removal(2, 2, survey(prop(57, "NEVER"))),
        removal(3, 3, survey(prop(57, "A"))),
        removal(4, 4, survey(prop(57, "A"))),
        removal(5, 5, survey(prop(57, "A"))),
        removal(6, 6, survey(prop(57, "A")), projectid=20),
        removal(7, 7, survey(prop(57, "{bad"))),
        removal(8, 8, "{bad"),
        removal(9, 9, survey(prop(57, "A"))),
        removal(17, 7, survey(prop("abc", "A"), prop(57, "A"))),
    ]
    pushed = [dict(id=1, serial_number="A", status=True), dict(id=2, serial_number="B", status=True), dict(id=3, serial_number="NEVER", status=False), dict(id=4, serial_number="NEVER", status=None)]
    log = [
        dict(swap_id=1, distnid=3, description="delete", status=False, serial_number="A"),
        dict(swap_id=2, distnid=1, description="delete", status=None, serial_number="A"),
        dict(swap_id=3, distnid=9, pushlog_id=9, status=True, description="delete", serial_number="Z"),
    ]
    out = install_delete_feed(world(ask, answers, pushed, log))
    got = sorted(((r["pushlog_id"], r["serial_number"]) for r in out["delta"].collect()), key=str)
    assert got == [(1, "A"), (None, "A"), (None, "B")]
    row = out["delta"].where("pushlog_id = 1").first()
    assert json.loads(row["request"]) == {"serialNumber": "A", "miDeleteFlag": True}
    assert (row["type_id"], row["description"], row["distributionnodecode"]) == (108, "delete", "N1")
    assert sorted(tuple(r) for r in out["rejected"].collect()) == [(7, "a property value does not parse"), (17, "a property id is not a number")]


def test_swap_feed(world):
    ask = [dict(swapid=i, distnid=n, meternum=f"M{i}", status=s, remarks=r) for i, n, s, r in [(1, 1, False, "consumer swap"), (2, 1, False, "consumer swap"), (3, 2, False, "consumer swap"), (4, 3, False, "consumer swap"), (5, 1, True, "consumer swap"), (6, 1, False, "delete")]]
    sources = {
        "installs": [dict(distributionnodecode="I1", distributionnodeid=1, _19="name", _354="old"), dict(distributionnodecode="I2", distributionnodeid=2)],
        "connections": [dict(distributionnodecode="C1", distributionnodeid=1, distributionnodename="conn")],
        "transformers": [dict(distributionnodecode="T1", distnid=1), dict(distributionnodecode="T3", distnid=3)],
    }
    log = [dict(swap_id=1, distnid=2, description="consumer swap", status=False), dict(swap_id=2, distnid=3, description="delete", status=False), dict(swap_id=3, distnid=1, description="consumer swap", status=True)]
    rows = meter_swap_feed(world(ask, log=log, sources=sources)).collect()
    assert sorted((r["serial_number"], r["distributionnodecode"]) for r in rows) == [("M1", "C1"), ("M1", "I1"), ("M1", "T1"), ("M2", "C1"), ("M2", "I1"), ("M2", "T1"), ("M4", "T3")]
    by_code = {r["distributionnodecode"]: json.loads(r["request"]) for r in rows if r["serial_number"] == "M1"}
    assert by_code["I1"] == {"serialNumber": "M1", "consumerId": "I1", "consumername": "name", "oldMeterSerialNumber": "old"}
    assert by_code["C1"]["consumername"] == "conn" and by_code["C1"]["oldMeterSerialNumber"] == ""
    assert by_code["T1"]["consumername"] == ""
