import json
from datetime import date

import pytest

from fieldsync.config import Labels, PeopleConfig
from fieldsync.plans import people


@pytest.fixture
def world(make):
    def build(contractor_log=(), technician_log=(), projects=None):
        return {
            "users": make(
                "users",
                dict(userid=1, username="boss", mobileno="9", companyid=3, status=1, date_of_birth=date(1990, 1, 2)),
                dict(userid=2, username="other", companyid=4, status=1),
                dict(userid=3, username="tech", FirstName=None, LastName="T", companyid=3, status=0),
            ),
            "user_projects": make("user_projects", *(projects or [dict(userid=1, projectid=20, roleid=5), dict(userid=1, projectid=21, roleid=6), dict(userid=3, projectid=1, roleid=26), dict(userid=1, projectid=20, roleid=99)])),
            "roles": make("roles", dict(roleid=5, discription="five"), dict(roleid=6, discription="six")),
            "contractors": make(
                "contractors",
                dict(contact_rid=10, vendor_code="V10", firm_name="f10", incharge_user_rid=1, status=1),
                dict(contact_rid=11, vendor_code="V11", firm_name="f11", incharge_user_rid=1, status=0),
                dict(contact_rid=12, vendor_code="V12", firm_name="f12", incharge_user_rid=2, status=1),
                dict(contact_rid=13, vendor_code="V13", firm_name="f13", incharge_user_rid=1, status=1),
                dict(contact_rid=14, vendor_code="V14", firm_name="f14", incharge_user_rid=77, status=1),
            ),
            "user_contractors": make("user_contractors", dict(user_rid=1, contact_rid=10), dict(user_rid=1, contact_rid=11), dict(user_rid=3, contact_rid=10), dict(user_rid=3, contact_rid=11), dict(user_rid=3, contact_rid=14)),
            "contractor_categories": make("contractor_categories", *[dict(contact_rid=i, contact_category_index=753) for i in (10, 11, 12, 14)], dict(contact_rid=13, contact_category_index=1)),
            "contractor_outbox": make("contractor_outbox", *contractor_log),
            "technician_outbox": make("technician_outbox", *technician_log),
        }

    return build


def test_new_contractors(world):
    log = [dict(api_id=1, contractorid=10, inserted=False), dict(api_id=2, contractorid=11, inserted=True)]
    rows = people.contact_create_delta(world(contractor_log=log), PeopleConfig(labels=Labels(source="S", account_member="isX"))).collect()
    assert [(r["contractorid"], r["roleid"], r["inchargeid"], r["type_id"], r["inserted"]) for r in rows] == [(10, 5, 1, 102, True)]
    assert json.loads(rows[0]["request"]) == {
        "uniqueId": 10, "agencyCode": "V10", "userName": "boss", "mobileNo": "9", "emailAddress": None, "role": "five",
        "isX": "false", "password": "", "dob": "1990-01-02", "isActive": "true", "Source": "S", "division": "",
    }


def test_changed_contractors(world):
    def delta(*log):
        rows = people.contact_update_delta(world(contractor_log=log)).collect()
        assert all("division" not in json.loads(r["request"]) and r["type_id"] == 103 and r["updated"] for r in rows)
        return [r["contractorid"] for r in rows]

    logged = dict(api_id=1, contractorid=10, roleid=5, inchargeid=1, inserted=True)
    assert delta(logged) == []
    assert delta(dict(logged, roleid=6)) == [10]
    assert delta(dict(logged, inchargeid=2)) == [10]
    assert delta(dict(logged, roleid=None)) == []
    assert delta(dict(logged, roleid=None, inchargeid=2)) == [10]
    assert delta(dict(logged, roleid=6), dict(logged, api_id=2, inserted=None, updated=True)) == []
    assert delta(logged, dict(logged, api_id=2, roleid=6, inserted=False)) == []
    assert delta() == []


def test_new_technicians(world):
    def delta(*log):
        rows = people.technician_create_delta(world(technician_log=log)).collect()
        return sorted((r["userid"], r["contactid"], r["roleid"], json.loads(r["request"])["contractorLoginId"]) for r in rows)

    both = [(3, 10, 26, "boss"), (3, 14, 26, None)]
    assert delta() == both
    assert delta(dict(api_id=1, userid=3, status_created=None)) == both
    assert delta(dict(api_id=1, userid=3, status_created=True)) == []
    assert delta(dict(api_id=1, userid=3, status_created=False)) == []
    row = people.technician_create_delta(world()).where("contactid = 10").first()
    assert json.loads(row["request"]) == {
        "technician_Id": "tech", "name": " T", "mobile_number": None, "email_address": None, "password": "",
        "contractorName": "f10", "contractorId": "V10", "contractorLoginId": "boss",
        "subdivision": {"location": "", "date": ""}, "dob": None,
    }


def test_changed_technicians(world):
    def delta(*log):
        return sorted(r["contactid"] for r in people.technician_update_delta(world(technician_log=log)).collect())

    logged = dict(api_id=1, userid=3, roleid=26, contactid=10, inserted=True, status_created=True)
    assert delta(logged) == [14]
    assert delta(dict(logged, roleid=2)) == [10, 14]
    assert delta(dict(logged, roleid=None)) == [14]
    assert delta(logged, dict(logged, api_id=2, status_created=False, inserted=None)) == []
    assert delta(dict(logged, inserted=False)) == []
