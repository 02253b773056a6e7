import json

import pytest

from fieldsync.plans.installs import install_push, install_repush


def prop(pid, value):
    return {"categorypropertyallocationid": pid, "value": value}


def survey(*props):
    return json.dumps({"propertiesBean": list(props)})


def meter(serial):
    return json.dumps({"meter_Id": serial})


BASE = dict(projectid=19, activityid=72, serveyorid=1, responsestatusid=0, surveydate="05/01/2024", responsetime="9:5:7", nodetype=1)


def response(rid, node, document, **other):
    return dict(BASE, responselogid=rid, distnid=node, distcode=f"N{node}", response=document, **other)


@pytest.fixture
def world(make):
    def build(responses, outbox=(), flags=(), receipts=(), devices=(), ids=()):
        return {
            "responses": make("responses", *responses),
            "users": make("users", dict(userid=1, username="u1", FirstName=None, LastName="Last"), dict(userid=2, username="u2", FirstName="F", LastName="L")),
            "resurvey_flags": make("resurvey_flags", *flags),
            "install_outbox": make("install_outbox", *outbox),
            "receipt_log": make("receipt_log", *receipts),
            "materials": make("materials", dict(mm_rid=5, name="box", code="b"), dict(mm_rid=6, name="wire", code="w")),
            "material_ids": make("material_ids", *ids),
            "device_current": make("device_current", *devices),
        }

    return build


def messages(delta):
    return sorted(
        ((r["responselogid"], r["distnid"], r["description"], json.loads(r["request"])) for r in delta.collect()),
        key=lambda m: (m[0], json.dumps(m[3])),
    )


def test_push_reads_every_form_of_property(world):
    document = survey(
        prop("57", meter("AB1")),
        prop(908, meter("AB2")),
        prop(68, {"seal_number": "S1", "x": 1}),
        prop("941", "12"),
        prop("674", "BC"),
    )
    inputs = world(
        [response(10, 1, document), response(11, 2, survey(prop(57, "PLAIN"))), response(12, 3, "{bad"), response(13, 4, document, activityid=99)],
        devices=[dict(serial_number="AB2", sim_no="SIM")],
        receipts=[dict(serialno="AB2", materialname="box", materialcode="b"), dict(serialno="AB2", materialname="wire", materialcode="w")],
        ids=[dict(mat_rid=5, smcbox_oemid="O", smcbox_sapid="P", mat_subcategory="SMC Box"), dict(mat_rid=6, smcbox_oemid="Q", smcbox_sapid="R", mat_subcategory="Service Cable")],
    )
    out = install_push(inputs)
    got = messages(out["delta"])
    assert [m[0] for m in got] == [10, 10]
    box, cable = sorted((m[3] for m in got), key=lambda p: p["smcBoxOEMId"], reverse=True)
    assert box["smcBoxOEMId"] == "O" and box["smcBoxSAPId"] == "P" and box["cableOEMID"] == "NA"
    assert cable["cableOEMID"] == "Q" and cable["cableSAPId"] == "R" and cable["smcBoxSAPId"] == "NA"
    assert box["serialNumber"] == "AB2" and box["BodySeal1"] == "S1" and box["cableLengthConsumed"] == "12"
    assert box["oldMeterSerialNumber"] == "BC" and box["SIMNo"] == "SIM" and box["meterInstalledByName"] == "Last"
    assert box["meterInstalledDate"] == "2024-01-05" and box["serviceCategory"] == "Consumer" and box["serviceSubCategory"] == "MI"
    assert list(box)[0] == "serialNumber" and len(box) == 24
    assert [tuple(r) for r in out["rejected"].collect()] == [(12, "document does not parse")]


def test_push_guards_and_marks(world):
    good = survey(prop(57, meter("M")))
    inputs = world(
        [
            response(1, 1, good),
            response(2, 1, good),
            response(3, 2, good),
            response(4, None, good),
            response(5, None, good),
            response(6, 3, good, projectid=7, activityid=99),
            response(7, 3, good, nodetype=9),
            response(8, 3, good, responsestatusid=-1),
            response(9, 4, survey(prop(57, json.dumps({"meter_Id": "M"})[:-1]))),
        ],
        outbox=[dict(id=1, distnid=2, status=False, type_id=105), dict(id=2, distnid=1, status=True, type_id=106), dict(id=3, distnid=1, status=None)],
        flags=[dict(responseid=6, resurvey=1), dict(responseid=1, resurvey=0)],
    )
    out = install_push(inputs)
    got = messages(out["delta"])
    assert [(m[0], m[2]) for m in got] == [(1, "Fresh MI"), (4, "Fresh MI"), (5, "Fresh MI"), (7, "Resurvey")]
    assert got[3][3]["serviceCategory"] is None
    assert [tuple(r) for r in out["rejected"].collect()] == [(9, "a property value does not parse")]
    assert [m[0] for m in messages(install_push(inputs, one_open_per_node=False)["delta"])] == [1, 2, 4, 5, 7]


def test_push_of_wanted_responses(world, spark):
    good = survey(prop(57, meter("M")))
    inputs = world([response(1, 1, good), response(2, 2, good), response(3, 3, good)])
    wanted = spark.createDataFrame([(2, 19, 72), (3, 19, 44)], "responselogid long, projectid int, activityid int")
    assert [m[0] for m in messages(install_push(inputs, wanted)["delta"])] == [2]


def test_repush(world):
    good = survey(prop("57", meter("AB1")), prop("", "x"), prop(941, "12"), prop(354, "OLD A"))
    inputs = world(
        [
            response(1, 1, good),
            response(2, 2, good),
            response(3, 3, good),
            response(4, 4, good, activityid=None),
            response(5, 5, good, activityid=81),
            response(6, 6, survey(prop(57, meter("NO RECEIPT")))),
            response(7, 7, "{bad"),
            response(8, 8, good, projectid=20),
            response(9, 9, survey(prop("x57", meter("AB1")))),
            response(10, 10, survey(prop(57, "123"), prop(674, "AB1"))),
            response(11, 11, good, serveyorid=77),
            response(12, 12, good, responsestatusid=-1),
        ],
        outbox=[
            dict(id=1, distnid=2, status=False, type_id=106),
            dict(id=2, distnid=3, status=True, type_id=106, serial_number="AB1"),
            dict(id=3, distnid=1, status=True, type_id=106, serial_number="OTHER"),
        ],
        receipts=[dict(serialno="AB1", materialname="box", materialcode="b"), dict(serialno="AB1", materialname="none", materialcode="b")],
    )
    out = install_repush(inputs)
    got = messages(out["delta"])
    assert [m[0] for m in got] == [1, 1]
    assert got[0][3]["cableLengthConsumed"] == "" and got[0][3]["oldMeterSerialNumber"] == "OLD A"
    assert out["delta"].where("push_datetime is not null").count() == 0
    assert [tuple(r) for r in out["rejected"].collect()] == [(9, "a property id is not a number")]

    blocked = dict(inputs, install_outbox=inputs["install_outbox"].unionByName(inputs["install_outbox"].limit(0)))
    assert len(messages(install_repush(blocked)["delta"])) == 2


def test_repush_is_blocked_by_an_open_row_of_any_type(world):
    good = survey(prop("57", meter("AB1")))
    inputs = world(
        [response(1, 1, good)],
        outbox=[dict(id=1, distnid=1, status=False, type_id=105)],
        receipts=[dict(serialno="AB1", materialname="box", materialcode="b")],
    )
    assert messages(install_repush(inputs)["delta"]) == []
