"""Plain fold of stock events, one by one, as the check for the set form."""

from __future__ import annotations

from decimal import Decimal


class Book:
    def __init__(self, stock, serials, materials, contractors):
        self.stock = {s["stock_rid"]: dict(s) for s in stock}
        self.serials = [dict(s) for s in serials]
        self.materials = materials
        self.contractors = contractors
        self.next_base = max(self.stock, default=0)
        self.after = {}

    def _material(self, e):
        ids = [m["mm_rid"] for m in self.materials if e["materialname"] is not None and m["name"] == e["materialname"] and e["materialcode"] is not None and m["code"] == e["materialcode"]]
        return min(ids, default=None)

    def _holder(self, code):
        return min((c["contact_rid"] for c in self.contractors if code is not None and c["vendor_code"] == code), default=None)

    def _stock(self, mat, holder):
        if mat is None or holder is None:
            return None
        return min((i for i, s in self.stock.items() if s["mat_rid"] == mat and s["holder_rid"] == holder and s["stock_condition_index"] == 800), default=None)

    def _count(self, sid):
        return sum(1 for s in self.serials if s["stock_rid"] == sid)

    def _new(self, e, mat, holder, qty):
        sid = self.next_base + e["seq"]
        self.stock[sid] = dict(stock_rid=sid, mat_rid=mat, holder_rid=holder, stock_condition_index=800, qty=qty)
        return sid

    def receipt(self, e):
        mat, holder = self._material(e), self._holder(e["contractorcode"])
        sid = self._stock(mat, holder)
        if e["type"] == "serialized":
            serial = e["serialno"]
            up = None if serial is None else serial.upper()
            if sid is not None:
                if serial is None or not any(s["stock_rid"] == sid and s["serial_no"] == serial for s in self.serials):
                    self.serials.append(dict(stock_rid=sid, serial_no=up))
            elif holder is not None:
                sid = self._new(e, mat, holder, Decimal(0))
                self.serials.append(dict(stock_rid=sid, serial_no=up))
            if sid is not None:
                self.stock[sid]["qty"] = (self.stock[sid]["qty"] or 0) + self._count(sid)
                self.after[e["seq"]] = (sid, self.stock[sid]["qty"])
        elif e["type"] == "non-serialized":
            q = e["quantity"]
            if sid is not None:
                self.stock[sid]["qty"] = None if q is None else (self.stock[sid]["qty"] or 0) + q
            else:
                sid = self._new(e, mat, holder, q)
            self.after[e["seq"]] = (sid, self.stock[sid]["qty"])

    def give_back(self, e):
        if e["type"] == "serialized":
            holders = [s["stock_rid"] for s in self.serials if e["serialno"] is not None and s["serial_no"] == e["serialno"]]
            if not holders:
                return
            sid = min(holders)
            row = self.stock.get(sid)
            if row is None or row["stock_condition_index"] != 800 or row["mat_rid"] is None:
                return
            self.serials = [s for s in self.serials if not (s["stock_rid"] == sid and s["serial_no"] == e["serialno"])]
            row["qty"] = self._count(sid)
            self.after[e["seq"]] = (sid, row["qty"])
        elif e["type"] == "non-serialized":
            sid = self._stock(self._material(e), self._holder(e["fromcontractorcode"]))
            if sid is None:
                return
            q, old = e["quantity"], self.stock[sid]["qty"]
            self.stock[sid]["qty"] = None if q is None or old is None else old - q
            self.after[e["seq"]] = (sid, self.stock[sid]["qty"])
