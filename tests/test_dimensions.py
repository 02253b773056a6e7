from fieldsync.plans.audit import ARGUMENTS, audit_append
from fieldsync.plans.dimensions import contractor_upsert, material_upsert


def test_contractors(make):
    known = make("contractors", dict(contact_rid=50, firm_name="known"))
    events = make(
        "contractor_events",
        dict(seq=1, firm_name="known"),
        dict(seq=3, firm_name="new", vendor_code="later"),
        dict(seq=2, firm_name="new", vendor_code="first", search_term="s"),
        dict(seq=4, firm_name=None),
        dict(seq=5, firm_name=None),
    )
    rows = contractor_upsert({"contractors": known}, events).collect()
    assert sorted((r["contact_rid"], r["firm_name"], r["vendor_code"]) for r in rows) == [(52, "new", "first"), (54, None, None), (55, None, None)]
    new = next(r for r in rows if r["contact_rid"] == 52)
    assert (new["group_rid"], new["status"], new["created_user_rid"], new["data_json"], new["contact_person"], new["email"]) == (3, 1, 907, "[]", "s", "")


def upsert_one_by_one(state, events):
    """Plain form: every event against what is there, creating what is missing."""
    base = {t: max((r[0] for r in rows), default=0) for t, rows in state.items()}
    rows = {t: list(r) for t, r in state.items()}
    materials = []

    def find(table, title):
        return min((r[0] for r in rows[table] if title is not None and r[1] == title), default=None)

    for e in sorted(events, key=lambda e: e["seq"]):
        name, code, seq = e["matname"], e["matcode"], e["seq"]
        if name is not None and code is not None and any(m[1] == name and m[2] == code for m in rows["materials"]):
            continue
        group = find("uom_groups", e["uom"])
        if group is None:
            group = base["uom_groups"] + seq
            rows["uom_groups"].append((group, e["uom"]))
            rows["uoms"].append((base["uoms"] + seq, e["matcat"]))
        cat, sub = find("material_categories", e["matcat"]), find("material_subcategories", e["matsubcat"])
        if cat is None:
            cat, sub = base["material_categories"] + seq, base["material_subcategories"] + seq
            rows["material_categories"].append((cat, e["matcat"]))
            rows["material_subcategories"].append((sub, e["matsubcat"]))
        rows["materials"].append((base["materials"] + seq, name, code))
        materials.append((base["materials"] + seq, name, code, group, cat, sub, 1 if e["serialised"] == "true" else 0, e["hsncode"] or ""))
    return rows, materials


def test_materials_equal_one_by_one(make):
    import random

    rng = random.Random(4)
    state = {
        "uom_groups": [(7, "EA"), (9, "EA")],
        "uoms": [(3, "x")],
        "material_categories": [(4, "cat1")],
        "material_subcategories": [(5, "sub1")],
        "materials": [(20, "m1", "c1")],
    }
    events = [
        dict(
            seq=i,
            uom=rng.choice(["EA", "KG", "M", None]),
            matcat=rng.choice(["cat1", "cat2", "cat3", None]),
            matsubcat=rng.choice(["sub1", "sub2", "sub3", None]),
            matname=f"m{rng.randint(1, 12)}" if rng.random() < 0.9 else None,
            matcode=f"c{rng.randint(1, 2)}",
            serialised=rng.choice(["true", "TRUE", None]),
            hsncode=rng.choice(["h", None]),
            sap_vendorcode=f"v{i}",
            sap_oemname=f"o{i}",
        )
        for i in range(1, 60)
    ]
    inputs = {
        "uom_groups": make("uom_groups", *[dict(ug_rid=i, name=n) for i, n in state["uom_groups"]]),
        "uoms": make("uoms", *[dict(uom_rid=i, name=n) for i, n in state["uoms"]]),
        "material_categories": make("material_categories", *[dict(mc_rid=i, title=n) for i, n in state["material_categories"]]),
        "material_subcategories": make("material_subcategories", *[dict(msc_rid=i, title=n) for i, n in state["material_subcategories"]]),
        "materials": make("materials", *[dict(mm_rid=i, name=n, code=c) for i, n, c in state["materials"]]),
    }
    out = material_upsert(inputs, make("material_events", *events))
    rows, materials = upsert_one_by_one(state, events)
    got = out["materials"].select("mm_rid", "name", "code", "uom_group_rid", "mc_rid", "msc_rid", "serial_flag", "hsn_code")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(materials, key=str)
    for table, columns in (("uom_groups", ("ug_rid", "name")), ("uoms", ("uom_rid", "name")), ("material_categories", ("mc_rid", "title")), ("material_subcategories", ("msc_rid", "title"))):
        made = [r for r in rows[table] if r not in state[table]]
        assert sorted(map(tuple, out[table].select(*columns).collect()), key=str) == sorted(made, key=str)
    ids = {r["mat_rid"]: (r["smcbox_oemid"], r["smcbox_sapid"]) for r in out["material_ids"].collect()}
    assert ids == {m[0]: (f"v{m[0] - 20}", f"o{m[0] - 20}") for m in materials}


def test_audit_text(make):
    events = make("contractor_events", dict(seq=1, vendor_code="v", firm_name="f", search_term="s", mobileno="m", address="a"), dict(seq=2, vendor_code="v"))
    texts = [r["fntext"] for r in audit_append(events, "contractor", ARGUMENTS["contractor_events"]).collect()]
    assert texts == ["contractorv/f/s/m/a", None]


def test_audit_masks_documents(make):
    full = {n: "x" for n in ARGUMENTS["receipt_events"]}
    events = make("receipt_events", dict(full, seq=1, doc_number=1, bu_rid=2, quantity=3, factoryfile='{"EK":"secret"}'))
    text = audit_append(events, "receipt", ARGUMENTS["receipt_events"]).first()["fntext"]
    assert "secret" not in text and text.endswith("/***/x")
