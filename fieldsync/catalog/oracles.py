"""SQL over the given tables that must give the same rows as the registered queries."""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Surveys, straight from the orders.
SURVEYS = """
surveys AS (
  SELECT o_orderkey AS id, o_custkey AS node, o_orderstatus AS st, o_orderpriority AS prio,
         'MT' || (o_orderkey % 500) AS meter,
         (o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS plain,
         (o_orderkey % 101 = 0) AS bad,
         (o_totalprice >= 20000) AS ok,
         CASE WHEN o_orderkey % 3 = 0 THEN 'OLD' || o_custkey END AS oldmeter,
         'S' || (o_orderkey % 97) AS seal, CAST(o_orderkey % 50 AS VARCHAR) AS cable,
         'BC' || o_orderkey AS barcode, strftime(o_orderdate, '%Y-%m-%d') AS day,
         CASE o_custkey % 10 WHEN 1 THEN 'Consumer' WHEN 7 THEN 'DT' WHEN 6 THEN 'Feeder' END AS category,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'MI' WHEN '2-HIGH' THEN 'NSC' WHEN '3-MEDIUM' THEN 'MI'
              WHEN '4-NOT SPECIFIED' THEN 'ONM' END AS subcategory
  FROM orders),
outbox AS (
  SELECT user_id AS node, 'MT' || k AS serial, type_id,
         CASE WHEN event_type = 'view' AND k < 3 THEN false WHEN event_type = 'purchase' THEN true END AS status
  FROM (SELECT *, {k} AS k, CASE WHEN {k} % 2 = 0 THEN 106 ELSE 105 END AS type_id FROM events)),
remarked AS (
  SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = p.prev AND l.l_returnflag = 'R')
              THEN 'Resurvey' ELSE 'Fresh MI' END AS remarks
  FROM surveys s JOIN (
    SELECT o_orderkey AS id, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM orders
  ) p USING (id)),
receipts AS (
  SELECT 'MT' || (p_partkey * 3) AS serial, p_brand || '-O' AS oem, p_type || '-S' AS sap, mm % 3 AS sort
  FROM part JOIN (SELECT p_brand, p_type, min(p_partkey) AS mm FROM part GROUP BY ALL) USING (p_brand, p_type)),
sims AS (SELECT 'MT' || s_suppkey AS serial, 'SIM' || s_nationkey AS sim FROM supplier)
""".replace("{k}", K)

INSTALL_COLUMNS = """
  x.id AS responselogid, CAST(x.node AS INTEGER) AS distnid, 'N' || x.node AS distributionnodecode,
  x.remarks AS description, 106 AS type_id,
  x.meter AS "serialNumber", '10' AS "meterStatus", 'No' AS "Stock_Status", c.c_name AS "meterInstalledById",
  c.c_mktsegment || CASE WHEN c.c_acctbal >= 0 THEN 'N' || c.c_nationkey ELSE '' END AS "meterInstalledByName",
  x.day AS "meterInstalledDate", 'N' || x.node AS "Id", coalesce(x.oldmeter, x.barcode) AS "oldMeterSerialNumber",
  x.seal AS "BodySeal1", '' AS "BodySeal2", '' AS "BoxSeal1", '' AS "BoxSeal2", '' AS "TerminalSeal1",
  '' AS "TerminalSeal2",
  CASE WHEN r.sort = 0 THEN r.oem ELSE 'NA' END AS "smcBoxOEMId",
  CASE WHEN r.sort = 0 THEN r.sap ELSE 'NA' END AS "smcBoxSAPId",
  {cable} AS "cableLengthConsumed",
  CASE WHEN r.sort = 1 THEN r.sap ELSE 'NA' END AS "cableSAPId",
  CASE WHEN r.sort = 1 THEN r.oem ELSE 'NA' END AS "cableOEMID",
  '' AS "newCT", '' AS "newCTRatio", coalesce(m.sim, '') AS "SIMNo",
  x.category AS "serviceCategory", x.subcategory AS "serviceSubCategory"
"""

PEOPLE = f"""
users AS (
  SELECT c_custkey AS userid, c_name AS username, c_mktsegment AS first,
         CASE WHEN c_acctbal >= 0 THEN 'N' || c_nationkey END AS last, '9' || c_custkey AS mobile,
         c_name || '@example.com' AS email, c_nationkey < 20 AS ours, c_acctbal > 1000 AS active,
         strftime(DATE '1980-01-01' + c_nationkey, '%Y-%m-%d') AS dob
  FROM customer),
allocations AS (
  SELECT o_custkey AS userid, o_orderstatus = 'F' AS wanted,
         CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 26 WHEN '3-MEDIUM' THEN 5
              WHEN '4-NOT SPECIFIED' THEN 7 ELSE 65 END AS roleid
  FROM orders),
firms AS (
  SELECT c_custkey AS rid, 'firm ' || c_custkey AS firm, 'V' || c_custkey AS vendor, c_custkey // 3 AS incharge,
         c_acctbal > 0 AS active, c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AS ours
  FROM customer),
ev AS (SELECT event_id, user_id, event_type, {K} AS k FROM events),
contacts AS (
  SELECT DISTINCT f.rid, a.roleid, f.incharge, f.vendor, u.username, u.mobile, u.email, n.n_name, u.dob, u.active
  FROM firms f JOIN users u ON u.userid = f.incharge JOIN allocations a ON a.userid = u.userid
  JOIN nation n ON n.n_nationkey = a.roleid
  WHERE f.ours AND u.ours AND a.wanted),
technicians AS (
  SELECT DISTINCT u.userid, f.rid, a.roleid, u.username, u.first || ' ' || coalesce(u.last, '') AS uname,
         u.mobile, u.email, f.firm, f.vendor, b.username AS login, u.dob
  FROM users u JOIN allocations a USING (userid) JOIN firms f ON f.rid = u.userid // 2
  LEFT JOIN users b ON b.userid = f.incharge
  WHERE u.ours AND f.active AND a.roleid IN (2, 26, 28, 79, 80, 65))
"""

CONTACT_COLUMNS = """
  CAST(rid AS INTEGER) AS contractorid, CAST(roleid AS INTEGER) AS roleid, CAST(incharge AS INTEGER) AS inchargeid,
  {type} AS type_id, CAST(rid AS VARCHAR) AS "uniqueId", vendor AS "agencyCode", username AS "userName",
  mobile AS "mobileNo", email AS "emailAddress", n_name AS role, dob,
  CASE WHEN active THEN 'true' ELSE 'false' END AS "isActive"
"""

TECHNICIAN_COLUMNS = """
  CAST(userid AS INTEGER) AS userid, CAST(rid AS INTEGER) AS contactid, CAST(roleid AS INTEGER) AS roleid,
  {type} AS type_id, username AS "technician_Id", uname AS name, mobile AS mobile_number, email AS email_address,
  firm AS "contractorName", vendor AS "contractorId", login AS "contractorLoginId", dob
"""

STOCK_EVENTS = f"""
ev AS (
  SELECT event_id + 1 AS seq, user_id AS docno, user_id % 10 AS slot, k, event_type, event_id,
         strftime(ts, '%Y-%m-%d') AS day,
         'S' || (user_id % 10) || '-' || k AS u,
         event_type = 'view' AND k % 5 = 0 AS low,
         CASE event_type WHEN 'purchase' THEN 'R' WHEN 'view' THEN 'R' WHEN 'error' THEN 'T'
              WHEN 'click' THEN 'BR' ELSE 'BT' END AS kind,
         CASE WHEN k % 20 <> 0 THEN CAST(floor(value) AS INTEGER) END AS q
  FROM (SELECT *, {K} AS k FROM events))
"""

SLOTS = """
slots AS (
  SELECT r_regionkey AS slot, CAST(r_regionkey + 1 AS BIGINT) AS stock_id, 0 AS made FROM region
  UNION ALL
  SELECT slot, (SELECT max(r_regionkey) + 1 FROM region) + min(seq), min(seq) FROM ev
  WHERE slot >= 5 AND kind IN ('R', 'BR') GROUP BY slot),
"""

# Serials that lie in one stock: returns cut their movements into spans.
SPANS = """
e AS (SELECT *, sum(CASE WHEN kind = 'T' THEN 1 ELSE 0 END)
        OVER (PARTITION BY slot, u ORDER BY seq ROWS UNBOUNDED PRECEDING) AS epoch FROM m),
n AS (SELECT *, sum(CASE WHEN kind <> 'T' THEN 1 ELSE 0 END)
        OVER (PARTITION BY slot, u, epoch ORDER BY seq ROWS UNBOUNDED PRECEDING) AS nth FROM e),
c AS (SELECT *, sum(CASE WHEN kind <> 'T' AND (low OR nth = 1) THEN 1 ELSE 0 END)
        OVER (PARTITION BY slot, u, epoch ORDER BY seq ROWS UNBOUNDED PRECEDING) AS copies FROM n),
effects AS (
  SELECT *, copies - lag(copies, 1, 0) OVER (PARTITION BY slot, u ORDER BY seq) AS delta,
         kind = 'T' AND lag(copies, 1, 0) OVER (PARTITION BY slot, u ORDER BY seq) > 0 AS eff
  FROM c),
"""

OWN_EFFECTS = """
m AS (
  SELECT slot, u, seq, kind, low FROM ev WHERE kind IN ('R', 'T')
  UNION ALL
  SELECT n_regionkey, 'S' || n_regionkey || '-' || n_nationkey, 0, 'INIT', false FROM nation),
""" + SPANS

# One serial with most events, in several stocks. Stock by stock, lowest first: of the returns that get there, a
# stock takes each one that a receipt of its own came before since the return before; the others go on.
_TAKEN = """
m{p} AS (SELECT slot, u, seq, kind, low, count(CASE WHEN kind = 'T' THEN 1 END)
           OVER (PARTITION BY u ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g
  FROM (SELECT slot, u, seq, kind, low FROM steps WHERE kind = 'R' AND pos = {p} UNION ALL FROM t{before})),
h{p} AS (SELECT *, bool_or(kind = 'R') OVER (PARTITION BY u, g) AS hit FROM m{p}),
t{p} AS (SELECT slot, u, seq, kind, low FROM h{p} WHERE kind = 'T' AND NOT hit),
"""

HOT_EFFECTS = (
    """
ranked AS (SELECT slot, row_number() OVER (ORDER BY stock_id) AS pos FROM slots),
steps AS (SELECT ev.slot, 'S' || CASE WHEN k % 10 < 7 THEN 0 ELSE k END AS u, seq, kind, low, pos
  FROM ev LEFT JOIN ranked USING (slot) WHERE kind IN ('R', 'T')),
t0 AS (SELECT slot, u, seq, kind, low FROM steps WHERE kind = 'T'),
"""
    + "".join(_TAKEN.format(p=p, before=p - 1) for p in range(1, 11))
    + """
m AS (
  SELECT slot, u, seq, kind, low FROM steps WHERE kind = 'R'
"""
    + "".join(
        f"  UNION ALL SELECT (SELECT slot FROM ranked WHERE pos = {p}), u, seq, kind, low FROM h{p} WHERE kind = 'T' AND hit\n"
        for p in range(1, 11)
    )
    + """  UNION ALL SELECT n_regionkey, 'S' || n_regionkey || '-' || n_nationkey, 0, 'INIT', false FROM nation),
"""
    + SPANS
)

# Serials that lie in several stocks: all serials go from event to event together,
# with the copies per stock, in the order of the stocks' ids, as state.
SHARED_EFFECTS = """
ranked AS (SELECT slot, row_number() OVER (ORDER BY stock_id) AS pos FROM slots),
steps AS (SELECT 'S' || k AS u, seq, kind, low, pos, row_number() OVER (PARTITION BY k ORDER BY seq) AS i
  FROM ev LEFT JOIN ranked USING (slot) WHERE kind IN ('R', 'T')),
walk(u, i, copies, seq, kind, pos, delta) AS (
  SELECT u, CAST(0 AS BIGINT), list_transform(range((SELECT count(*) FROM slots)), lambda x: CAST(0 AS BIGINT)),
         CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM steps WHERE i = 1
  UNION ALL
  SELECT u, i, list_transform(copies, lambda c, p: CASE WHEN p = pos THEN c + delta ELSE c END), seq, kind, pos, delta
  FROM (SELECT *, CASE WHEN kind = 'T' THEN -copies[pos] WHEN low OR copies[pos] = 0 THEN 1 ELSE 0 END AS delta
    FROM (SELECT s.u, s.i, w.copies, s.seq, s.kind, s.low,
            CASE WHEN s.kind = 'R' THEN s.pos ELSE list_position(list_transform(w.copies, lambda c: c > 0), true) END AS pos
          FROM walk w JOIN steps s ON s.u = w.u AND s.i = w.i + 1))),
effects AS (
  SELECT slot, u, seq, kind, delta, kind = 'T' AS eff FROM walk JOIN ranked USING (pos)
  UNION ALL
  SELECT n_regionkey, 'S' || n_regionkey || '-' || n_nationkey, 0, 'INIT', 1, false FROM nation),
"""

BALANCES = """
moves AS (
  SELECT slot, seq, 0 AS ord, kind, delta, eff, CAST(NULL AS INTEGER) AS q FROM effects
  UNION ALL
  SELECT slot, seq, 1, kind, 0, false, q FROM ev JOIN slots USING (slot) WHERE kind IN ('BR', 'BT') AND seq >= made
  UNION ALL
  SELECT r_regionkey, 0, 1, 'INITQ', 0, false, CASE WHEN r_regionkey <> 2 THEN r_regionkey END FROM region),
counted AS (
  SELECT *, sum(delta) OVER w AS cnt,
         sum(CASE WHEN eff OR (kind IN ('BR', 'BT') AND q IS NULL) THEN 1 ELSE 0 END) OVER w AS g
  FROM moves WINDOW w AS (PARTITION BY slot ORDER BY seq, ord ROWS UNBOUNDED PRECEDING)),
started AS (
  SELECT *, sum(CASE WHEN eff OR kind = 'R' OR (kind IN ('BR', 'INITQ') AND q IS NOT NULL) THEN 1 ELSE 0 END)
         OVER (PARTITION BY slot, g ORDER BY seq, ord ROWS UNBOUNDED PRECEDING) AS st
  FROM counted),
ledger AS (
  SELECT *, CASE WHEN st > 0 THEN sum(CASE WHEN eff OR kind = 'R' THEN cnt WHEN kind IN ('BR', 'INITQ') THEN q
                                          WHEN kind = 'BT' AND st > 0 THEN -q END)
         OVER (PARTITION BY slot, g ORDER BY seq, ord ROWS UNBOUNDED PRECEDING) END AS qty
  FROM started),
"""

LEDGER = STOCK_EVENTS + "," + SLOTS + OWN_EFFECTS + BALANCES + """
held AS (
  SELECT slot, u, arg_max(copies, seq) AS copies FROM effects GROUP BY slot, u)
"""
HOT_LEDGER = (STOCK_EVENTS + "," + SLOTS + HOT_EFFECTS + BALANCES).rstrip().rstrip(",")
SHARED_LEDGER = (STOCK_EVENTS + "," + SLOTS + SHARED_EFFECTS + BALANCES).rstrip().rstrip(",")

# Some events name no known contractor or material: a receipt of these makes a stock of its own (none without a contractor,
# if serialised), a bulk return does nothing. A serial that lies in such a stock isn't given back past it.
ODD_LEDGER = (
    STOCK_EVENTS.replace("ev AS (", "given_ev AS (", 1)
    + """,
odd_ev AS (
  SELECT * REPLACE (CASE WHEN seq % 17 <> 0 THEN u END AS u, low OR seq % 17 = 0 AS low), seq % 11 <> 0 AS firm, seq % 13 <> 0 AS material
  FROM given_ev WHERE seq % 19 <> 0),
alone AS (
  SELECT 5 + seq AS stock_id, seq, kind, u, q, CASE WHEN material THEN 100 + slot % 5 END AS mat, CASE WHEN firm THEN CASE WHEN slot < 5 THEN 1 ELSE 2 END END AS holder
  FROM odd_ev WHERE NOT (firm AND material) AND (kind = 'BR' OR kind = 'R' AND firm)),
ev AS (SELECT * FROM odd_ev WHERE kind = 'T' OR (firm AND material)),
"""
    + SLOTS
    + OWN_EFFECTS.replace(
        "WHERE kind IN ('R', 'T')",
        """WHERE kind = 'R' OR (kind = 'T' AND u IS NOT NULL AND NOT EXISTS (SELECT 1 FROM alone a JOIN slots s ON a.seq < s.made
    WHERE a.kind = 'R' AND a.u = ev.u AND s.slot = ev.slot AND a.seq < ev.seq))""",
    )
    + BALANCES
)
ODD_LEDGER = ODD_LEDGER.rstrip().rstrip(",")

RECEIPT_LOG = """
base AS (SELECT 'S' || (p_partkey % 10) || '-' || p_size AS s, p_partkey AS docno, CAST(p_partkey % 5 AS VARCHAR) AS code,
                CASE WHEN p_size > 25 THEN 'serialized' ELSE 'non-serialized' END AS type FROM part),
cand AS (
  SELECT *, CASE WHEN low THEN lower(u) ELSE u END AS s FROM ev WHERE kind = 'R'
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.s = CASE WHEN low THEN lower(u) ELSE u END AND b.docno = ev.docno)),
logged AS (
  SELECT c.* FROM cand c JOIN (SELECT u, docno, min(seq) AS first FROM cand GROUP BY u, docno) f USING (u, docno)
  WHERE low OR seq = first),
bulk AS (
  SELECT min(seq) AS seq FROM ev WHERE kind = 'BR'
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.docno = ev.docno AND b.code = CAST(slot % 5 AS VARCHAR) AND b.type = 'non-serialized')
  GROUP BY docno, slot % 5)
"""

DEVICES = (
    STOCK_EVENTS
    + ","
    + RECEIPT_LOG
    + """,
devices AS (SELECT 'S' || (p_partkey % 10) || '-' || p_size AS serial_number, 'P' || p_partkey AS device_id,
                   CAST(p_size AS VARCHAR) AS sim_no, p_brand AS meter_make, CAST(NULL AS VARCHAR) AS hls_us,
                   CAST(NULL AS VARCHAR) AS lls, 'factory' AS type_source FROM part),
loads AS (SELECT u AS serial_number, CASE WHEN k % 7 <> 0 THEN 'D' || event_id END AS device_id,
                 CASE WHEN k % 7 <> 0 THEN CAST(k AS VARCHAR) END AS sim_no, CAST(NULL AS VARCHAR) AS meter_make,
                 CASE WHEN k % 7 <> 0 THEN 'h' END AS hls_us, CAST(NULL AS VARCHAR) AS lls, 'hub' AS type_source,
                 seq = max(seq) OVER (PARTITION BY u) AS last FROM logged)
"""
)

MATERIALS = """
events_m AS (
  SELECT p_partkey + 1 AS seq, CASE WHEN p_size <> 50 THEN 'unit ' || p_size END AS uom, p_brand AS cat,
         p_type || ' ' || (p_size % 7) AS sub, p_name AS name, p_size, p_type FROM part),
accepted AS (
  SELECT * FROM events_m e WHERE NOT (name = 'red widget' AND EXISTS (SELECT 1 FROM nation WHERE 'Brand#' || n_nationkey = cat))
  QUALIFY row_number() OVER (PARTITION BY name, cat ORDER BY seq) = 1),
units AS (SELECT 'unit ' || (n_nationkey * 2) AS uom, n_nationkey AS known_unit FROM nation),
cats AS (SELECT 'Brand#' || (r_regionkey * 2) AS cat, r_regionkey + 1 AS known_cat FROM region),
subs AS (SELECT 'PROMO ' || n_regionkey AS sub, min(n_nationkey) AS known_sub FROM nation GROUP BY 1),
top AS (SELECT max(n_nationkey) AS t, (SELECT max(r_regionkey) + 1 FROM region) AS tc FROM nation),
found AS (
  SELECT a.*, known_unit, known_cat, known_sub,
         CASE WHEN a.uom IS NULL THEN seq ELSE min(seq) OVER (PARTITION BY a.uom) END AS unit_by,
         min(seq) OVER (PARTITION BY a.cat) AS cat_by
  FROM accepted a LEFT JOIN units USING (uom) LEFT JOIN cats USING (cat) LEFT JOIN subs USING (sub)),
marked AS (SELECT *, known_unit IS NULL AND unit_by = seq AS makes_unit, known_cat IS NULL AND cat_by = seq AS makes_cat FROM found),
makers AS (SELECT sub, min(seq) AS sub_by FROM marked WHERE makes_cat GROUP BY sub)
"""

ORACLES: dict[str, str] = {
    "install_pivot": f"""
WITH wide AS (
  SELECT user_id, max({K}) FILTER (event_type = 'view') AS v, max({K}) FILTER (event_type IN ('purchase', 'signup')) AS b,
         max({K}) FILTER (event_type = 'error') AS e, max({K}) FILTER (event_type = 'click') AS c
  FROM events GROUP BY user_id)
SELECT user_id, coalesce(v, -1) AS max_view, coalesce(b, -1) AS max_buy, coalesce(e, -1) AS max_error,
       coalesce(c, -1) AS max_click, coalesce(b, v, 0) AS best FROM wide""",
    "install_seals": "SELECT o_orderkey AS responselogid, "
    + ", ".join(
        f"""(SELECT arg_max(v, (lower(v), v <> lower(v))) FROM (VALUES (CASE WHEN o_custkey % 11 <> {n} THEN 'seal ' || (o_custkey % {n}) END),
  (CASE WHEN o_orderkey % 7 <> {n} THEN 'SEAL ' || (o_orderkey % {n}) END)) t(v) WHERE v IS NOT NULL) AS {name}"""
        for n, name in enumerate(("bodyseal2", "boxseal1", "boxseal2", "termseal1", "termseal2"), 3)
    )
    + ", CAST(NULL AS VARCHAR) AS reject_reason FROM orders",
    "json_numbers": """
SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice) AS price, '{"list":[' || printf('%.3f', l_quantity) || ',7]}' AS below,
       '1' || l_orderkey || lpad(l_partkey::VARCHAR, 22, '0') AS number, printf('%.3f', l_quantity) AS cablelength,
       printf('%.2f', l_extendedprice) AS barcode, CAST(NULL AS VARCHAR) AS reject_reason
FROM lineitem""",
    "install_pivot_collated": """
WITH named AS (SELECT p_brand, p_size % 3 AS third, CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE p_type END AS name FROM part)
SELECT p_brand, arg_max(name, (lower(name), name <> lower(name))) FILTER (third = 0) AS first,
       arg_max(name, (lower(name), name <> lower(name))) FILTER (third IN (1, 2)) AS others
FROM named GROUP BY p_brand""",
    "install_attributes": f"""
WITH {SURVEYS}
SELECT id AS responselogid, CASE WHEN NOT bad AND NOT plain THEN meter END AS meternum,
       CASE WHEN NOT bad THEN oldmeter END AS oldmeternum, CASE WHEN NOT bad THEN seal END AS bodyseal1,
       CAST(NULL AS VARCHAR) AS bodyseal2, CAST(NULL AS VARCHAR) AS boxseal1, CAST(NULL AS VARCHAR) AS boxseal2,
       CAST(NULL AS VARCHAR) AS termseal1, CAST(NULL AS VARCHAR) AS termseal2,
       CASE WHEN NOT bad THEN cable END AS cablelength, CASE WHEN NOT bad THEN barcode END AS barcode,
       CASE WHEN bad THEN 'document does not parse' END AS reject_reason
FROM surveys""",
    "install_explode": f"""
WITH {SURVEYS},
rows_ AS (
  SELECT '57' AS property_id, CASE WHEN plain THEN meter ELSE '{{"meter_Id":"' || meter || '"}}' END AS value FROM surveys WHERE NOT bad
  UNION ALL
  SELECT CASE WHEN oldmeter IS NULL THEN '' ELSE '354' END, '{{"value":"OLD' || node || '"}}' FROM surveys WHERE NOT bad
  UNION ALL SELECT '68', '{{"seal_number":"' || seal || '","seen":true}}' FROM surveys WHERE NOT bad
  UNION ALL SELECT '941', cable FROM surveys WHERE NOT bad
  UNION ALL SELECT '674', barcode FROM surveys WHERE NOT bad)
SELECT property_id, count(*) AS n, max(value) AS max_value, count(DISTINCT value) AS n_values FROM rows_ GROUP BY property_id""",
    "install_push": f"""
WITH {SURVEYS},
usable AS (
  SELECT * FROM remarked s WHERE prio <> '5-LOW' AND ok AND NOT bad AND NOT plain
    AND NOT EXISTS (SELECT 1 FROM outbox o WHERE o.node = s.node AND o.status = false)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY id) = 1)
SELECT {INSTALL_COLUMNS.replace("{cable}", "x.cable")}
FROM usable x JOIN customer c ON c.c_custkey = x.node LEFT JOIN receipts r ON r.serial = x.meter
LEFT JOIN sims m ON m.serial = x.meter""",
    "install_rejects": f"""
WITH {SURVEYS}
SELECT id AS responselogid, 'document does not parse' AS reject_reason FROM surveys
WHERE prio <> '5-LOW' AND ok AND bad AND node IN (SELECT c_custkey FROM customer)""",
    "outbox_rejects": """
SELECT distnid, chars, CASE WHEN chars > 500000 THEN 'request_too_long' ELSE 'written' END AS outcome
FROM (SELECT doc_id::INTEGER AS distnid, (length(text) * CASE WHEN doc_id % 50 = 0 THEN 300 ELSE 1 END)::INTEGER AS chars FROM documents)""",
    "outbox_two_runs": """
SELECT DISTINCT o_custkey::INTEGER AS distnid, 1::BIGINT AS messages, 1::BIGINT AS same_id
FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'""",
    "outbox_compacted": """
SELECT o_custkey::INTEGER AS distnid, CASE o_orderstatus WHEN 'F' THEN 105 WHEN 'O' THEN 106 WHEN 'P' THEN 108 END AS type_id, o_orderpriority AS run,
       count(*) AS messages, count(*) AS ids, max('MT' || (o_orderkey % 1000)) AS last_serial
FROM orders GROUP BY ALL""",
    "install_repush": f"""
WITH {SURVEYS},
usable AS (
  SELECT * FROM remarked s WHERE st = 'P' AND ok AND NOT bad
    AND NOT EXISTS (SELECT 1 FROM outbox o WHERE o.node = s.node AND o.status = false)
    AND NOT EXISTS (SELECT 1 FROM outbox o WHERE o.node = s.node AND o.serial = s.meter))
SELECT {INSTALL_COLUMNS.replace("{cable}", "''")}
FROM usable x JOIN customer c ON c.c_custkey = x.node JOIN receipts r ON r.serial = x.meter
LEFT JOIN sims m ON m.serial = x.meter""",
    "install_payload": """
SELECT o_orderkey, c_name AS "serialNumber", o_orderstatus AS "Stock_Status",
       CASE WHEN c_acctbal > 0 THEN o_orderpriority END AS "serviceCategory", c_mktsegment AS segment,
       CAST(4 AS INTEGER) AS n_members
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "repush_backlog": """
SELECT o_orderkey, o_custkey, p_brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = o_orderkey AND x.l_linestatus = 'O')""",
    "skewed_joins": """
WITH lines AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part, l_orderkey * 10 + l_linenumber AS line FROM lineitem),
parts AS (SELECT p_partkey AS part, p_brand, p_size FROM part),
small AS (SELECT * FROM parts WHERE p_size <= 25 OR part = 1),
joined AS (
  SELECT 'left' AS kind, p_brand, part, line FROM lines LEFT JOIN small USING (part)
  UNION ALL SELECT 'right', p_brand, part, line FROM parts LEFT JOIN (SELECT * FROM lines WHERE line % 2 = 0) USING (part)
  UNION ALL SELECT 'inner', p_brand, part, line FROM small JOIN lines USING (part)
  UNION ALL SELECT 'semi', NULL, part, line FROM lines WHERE part IN (SELECT part FROM small)
  UNION ALL SELECT 'anti', NULL, part, line FROM lines WHERE part NOT IN (SELECT part FROM parts WHERE part > 1))
SELECT kind, p_brand, count(*) AS n, count(line) AS n_lines, CAST(sum(part) AS BIGINT) AS parts, CAST(sum(line) AS BIGINT) AS lines
FROM joined GROUP BY kind, p_brand""",
    "previous_flag": """
WITH p AS (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_order FROM orders)
SELECT p.o_orderkey, previous_order, CASE WHEN q.o_orderstatus = 'F' THEN 'Resurvey' ELSE 'Fresh MI' END AS remarks
FROM p LEFT JOIN orders q ON q.o_orderkey = p.previous_order""",
    "contact_new": f"""
WITH {PEOPLE}
SELECT {CONTACT_COLUMNS.replace("{type}", "102")} FROM contacts
WHERE NOT EXISTS (SELECT 1 FROM ev WHERE user_id = rid AND event_type = 'signup')""",
    "contact_changed": f"""
WITH {PEOPLE},
newest AS (
  SELECT user_id, CASE WHEN k >= 10 THEN k % 10 END AS old_role FROM ev WHERE event_type IN ('signup', 'purchase')
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT {CONTACT_COLUMNS.replace("{type}", "103")} FROM contacts JOIN newest ON user_id = rid WHERE old_role <> roleid""",
    "technician_new": f"""
WITH {PEOPLE}
SELECT {TECHNICIAN_COLUMNS.replace("{type}", "100")} FROM technicians
WHERE NOT EXISTS (SELECT 1 FROM ev WHERE user_id = userid AND (event_type = 'purchase' OR (event_type = 'view' AND k < 5)))""",
    "technician_changed": f"""
WITH {PEOPLE},
newest AS (
  SELECT user_id, CASE WHEN k >= 10 THEN k % 10 END AS old_role FROM ev WHERE event_type IN ('signup', 'click')
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT {TECHNICIAN_COLUMNS.replace("{type}", "104")} FROM technicians JOIN newest ON user_id = userid
WHERE old_role <> roleid
  AND NOT EXISTS (SELECT 1 FROM ev WHERE ev.user_id = technicians.userid AND event_type = 'view' AND k < 5)""",
    "delete_feed": f"""
WITH {SURVEYS},
ev AS (SELECT event_id, user_id, event_type, {K} AS k FROM events),
meters AS (
  SELECT DISTINCT node, meter FROM surveys s WHERE st = 'O' AND ok AND NOT bad
    AND EXISTS (SELECT 1 FROM outbox o WHERE o.serial = s.meter AND o.status)
    AND NOT EXISTS (SELECT 1 FROM ev WHERE event_type = 'signup' AND k < 3 AND user_id = s.node AND 'MT' || k = s.meter))
SELECT event_id AS pushlog_id, CAST(node AS INTEGER) AS distnid, 'N' || node AS distributionnodecode,
       min(meter) AS serial_number, 'delete' AS description, 108 AS type_id, 'true' AS flag
FROM ev JOIN meters ON node = user_id
WHERE event_type IN ('view', 'signup', 'error')
  AND event_id NOT IN (SELECT event_id + 1 FROM ev WHERE event_type = 'signup')
GROUP BY event_id, node""",
    "swap_feed": f"""
WITH ev AS (SELECT event_id, user_id, event_type, {K} AS k FROM events),
nodes AS (
  SELECT c_custkey AS node, 'N' || c_custkey AS code, c_name AS consumer, 'OLD' || c_custkey AS oldmeter FROM customer
  UNION ALL SELECT s_suppkey, 'C' || s_suppkey, s_name, '' FROM supplier
  UNION ALL SELECT p_partkey, 'T' || p_partkey, '', '' FROM part)
SELECT CAST(node AS INTEGER) AS distnid, code AS distributionnodecode, 'consumer swap' AS description, 105 AS type_id,
       'MT' || k AS "serialNumber", code AS "consumerId", consumer AS consumername, oldmeter AS "oldMeterSerialNumber"
FROM ev JOIN nodes ON node = user_id
WHERE event_type = 'click'
  AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type IN ('view', 'click', 'purchase') AND k < 3)""",
    "stock_ledger": f"""
WITH {LEDGER}
SELECT stock_id AS stock_rid, CAST(100 + slot % 5 AS BIGINT) AS mat_rid, CASE WHEN slot < 5 THEN 1 ELSE 2 END AS holder_rid,
       CAST(qty AS DECIMAL(38,4)) AS qty
FROM (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY slot ORDER BY seq DESC, ord DESC) = 1) JOIN slots USING (slot)""",
    "stock_incremental": f"""
WITH {LEDGER}
SELECT CAST(100 + slot % 5 AS BIGINT) AS mat_rid, CASE WHEN slot < 5 THEN 1 ELSE 2 END AS holder_rid,
       CAST(qty AS DECIMAL(38,4)) AS qty, CAST(coalesce(n, 0) AS BIGINT) AS serials
FROM (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY slot ORDER BY seq DESC, ord DESC) = 1)
LEFT JOIN (SELECT slot, sum(copies) AS n FROM held WHERE copies > 0 GROUP BY slot) USING (slot)""",
    "stock_shared_serials": f"""
WITH RECURSIVE {SHARED_LEDGER}
SELECT stock_id AS stock_rid, CAST(100 + slot % 5 AS BIGINT) AS mat_rid, CASE WHEN slot < 5 THEN 1 ELSE 2 END AS holder_rid,
       CAST(qty AS DECIMAL(38,4)) AS qty
FROM (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY slot ORDER BY seq DESC, ord DESC) = 1) JOIN slots USING (slot)""",
    "stock_odd_events": f"""
WITH {ODD_LEDGER},
named AS (SELECT slot, sum(delta) AS n FROM effects WHERE u IS NOT NULL GROUP BY slot)
SELECT stock_id AS stock_rid, CAST(100 + slot % 5 AS BIGINT) AS mat_rid, CASE WHEN slot < 5 THEN 1 ELSE 2 END AS holder_rid,
       CAST(qty AS DECIMAL(38,4)) AS qty, CAST(cnt AS BIGINT) AS serials, CAST(coalesce(n, 0) AS BIGINT) AS named
FROM (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY slot ORDER BY seq DESC, ord DESC) = 1) JOIN slots USING (slot)
LEFT JOIN named USING (slot)
UNION ALL
SELECT stock_id, CAST(mat AS BIGINT), holder, CAST(CASE kind WHEN 'R' THEN 1 ELSE q END AS DECIMAL(38,4)),
       CASE kind WHEN 'R' THEN 1 ELSE 0 END, CASE WHEN kind = 'R' AND u IS NOT NULL THEN 1 ELSE 0 END FROM alone""",
    "stock_hot_serial": f"""
WITH {HOT_LEDGER}
SELECT stock_id, seq, CAST(cnt AS BIGINT) AS count_after, CAST(qty AS DECIMAL(18,4)) AS qty_after
FROM ledger JOIN slots USING (slot) WHERE eff OR kind IN ('R', 'BR', 'BT')""",
    "stock_movements": f"""
WITH {LEDGER}
SELECT stock_id, seq, CAST(cnt AS BIGINT) AS count_after, CAST(qty AS DECIMAL(18,4)) AS qty_after
FROM ledger JOIN slots USING (slot) WHERE eff OR kind IN ('R', 'BR', 'BT')""",
    "stock_serials": f"""
WITH {LEDGER}
SELECT stock_id AS stock_rid, CAST(100 + slot % 5 AS BIGINT) AS mat_rid, u AS serial_no, CAST(copies AS BIGINT) AS copies
FROM held JOIN slots USING (slot) WHERE copies > 0""",
    "stock_balance": f"""
WITH {LEDGER}
SELECT stock_id, CAST(coalesce(h.n, 0) AS BIGINT) AS serials, CAST(coalesce(h.n, 0) + coalesce(b.q, 0) AS DECIMAL(18,4)) AS qty
FROM slots LEFT JOIN (SELECT slot, count(*) AS n FROM held WHERE copies > 0 GROUP BY slot) h USING (slot)
LEFT JOIN (SELECT slot, sum(CASE WHEN kind = 'BR' THEN q ELSE -q END) AS q FROM moves WHERE kind IN ('BR', 'BT') GROUP BY slot) b USING (slot)""",
    "receipt_log_once": f"""
WITH {STOCK_EVENTS}, {RECEIPT_LOG}
SELECT seq, CAST(docno AS INTEGER) AS documentnumber, CAST(day AS DATE) AS crvdate, CASE WHEN slot < 5 THEN 1 ELSE 2 END AS contractorcode,
       CAST(slot % 5 AS VARCHAR) AS materialcode, q AS quantity, u AS serialno,
       CASE WHEN kind = 'R' THEN 'serialized' ELSE 'non-serialized' END AS type, 'CRV' AS wh_activity
FROM ev WHERE seq IN (SELECT seq FROM logged UNION ALL SELECT seq FROM bulk)""",
    "return_log_once": f"""
WITH {STOCK_EVENTS},
base AS (SELECT 'S' || (p_partkey % 10) || '-' || p_size AS s, p_partkey AS docno, CAST(p_partkey % 5 AS VARCHAR) AS code,
                CASE WHEN p_size > 25 THEN 'serialized' ELSE 'non-serialized' END AS type FROM part),
kept AS (
  SELECT min(seq) AS seq FROM ev WHERE kind = 'T'
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.s = u AND b.docno = ev.docno) GROUP BY u, docno
  UNION ALL
  SELECT min(seq) FROM ev WHERE kind = 'BT'
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.docno = ev.docno AND b.code = CAST(slot % 5 AS VARCHAR) AND b.type = 'non-serialized')
  GROUP BY docno, slot % 5)
SELECT seq, CAST(docno AS INTEGER) AS doc_num, day AS cridate, CASE WHEN slot < 5 THEN '1' ELSE '2' END AS fromcontractorcode,
       CAST(slot % 5 AS VARCHAR) AS materialcode, q AS quantity, u AS serial_num,
       CASE WHEN kind = 'T' THEN 'serialized' ELSE 'non-serialized' END AS type, 'CRI' AS wh_activity
FROM ev WHERE seq IN (SELECT seq FROM kept)""",
    "attributes_current": f"""
WITH {DEVICES}
SELECT * FROM devices WHERE serial_number NOT IN (SELECT serial_number FROM loads)
UNION ALL SELECT * EXCLUDE (last) FROM loads WHERE last""",
    "attributes_history": f"""
WITH {DEVICES}
SELECT * FROM devices WHERE serial_number IN (SELECT serial_number FROM loads)
UNION ALL SELECT * EXCLUDE (last) FROM loads WHERE NOT last""",
    "document_log_once": """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_shipdate, l_returnflag FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
                           ORDER BY l_linenumber, l_suppkey, l_quantity, l_shipdate, l_returnflag) = 1""",
    "contractor_first_wins": """
WITH e AS (SELECT *, CASE WHEN c_acctbal > -900 THEN c_mktsegment || ' ' || c_nationkey END AS firm FROM customer),
kept AS (
  SELECT * FROM e WHERE firm IS NULL
  UNION ALL
  (SELECT * FROM e WHERE firm IS NOT NULL AND firm NOT IN (SELECT 'MACHINERY ' || s_nationkey FROM supplier)
   QUALIFY row_number() OVER (PARTITION BY firm ORDER BY c_custkey) = 1))
SELECT (SELECT max(s_suppkey) FROM supplier) + c_custkey + 1 AS contact_rid, firm AS firm_name, c_name AS contact_person,
       '9' || c_custkey AS mobile, 'street ' || c_custkey AS address, 'V' || c_custkey AS vendor_code,
       3 AS group_rid, 1 AS status, 907 AS created_user_rid, '[]' AS data_json FROM kept""",
    "material_cascade": f"""
WITH {MATERIALS}
SELECT t + seq AS mm_rid, name, cat AS code, 'size ' || p_size AS description,
       CAST(coalesce(known_unit, t + unit_by) AS BIGINT) AS uom_group_rid,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS hsn_code,
       CAST(coalesce(known_cat, tc + cat_by) AS BIGINT) AS mc_rid,
       CAST(CASE WHEN makes_cat THEN t + seq WHEN known_sub IS NOT NULL THEN known_sub WHEN sub_by < seq THEN t + sub_by END AS BIGINT) AS msc_rid,
       CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS serial_flag,
       CAST(coalesce(known_unit, t + unit_by) AS BIGINT) AS default_uom_rid
FROM marked LEFT JOIN makers USING (sub), top""",
    "material_units": f"""
WITH {MATERIALS}
SELECT t + seq AS ug_rid, uom AS group_name, t + seq AS uom_rid, cat AS unit_name FROM marked, top WHERE makes_unit""",
    "material_categories": f"""
WITH {MATERIALS}
SELECT tc + seq AS mc_rid, cat AS category, t + seq AS msc_rid, sub AS sub_category FROM marked, top WHERE makes_cat""",
    "material_partner_ids": f"""
WITH {MATERIALS}
SELECT t + seq AS mat_rid, 'V' || p_size AS smcbox_oemid, p_type AS smcbox_sapid FROM marked, top""",
    "json_rejects": """
SELECT lang, count(*) AS n_rows, count(*) FILTER (json_valid(text)) AS n_valid,
       count(*) FILTER (text IS NOT NULL AND NOT json_valid(text)) AS n_rejected, count(*) FILTER (text LIKE '{%') AS n_looks
FROM documents GROUP BY lang""",
    "survey_rejects": f"""
WITH {SURVEYS}
SELECT id AS responselogid, 'N' || node AS distcode,
  '{{"propertiesBean":[{{"categorypropertyallocationid":"57","value":'
  || CASE WHEN plain THEN '"' || meter || '"' ELSE '"{{\\"meter_Id\\":\\"' || meter || '\\"}}"' END
  || '}},{{"categorypropertyallocationid":' || CASE WHEN oldmeter IS NULL THEN '""' ELSE '354' END
  || ',"value":"{{\\"value\\":\\"OLD' || node || '\\"}}"}},{{"categorypropertyallocationid":"68","value":{{"seal_number":"'
  || seal || '","seen":true}}}},{{"categorypropertyallocationid":941,"value":"' || cable
  || '"}},{{"categorypropertyallocationid":"674","value":"' || barcode || '"}}' AS response
FROM surveys WHERE bad""",
    "audit_text": """
SELECT 'nation' || n_nationkey || '/' || n_name || '/' || r_name AS fntext FROM nation LEFT JOIN region ON n_nationkey = r_regionkey""",
    "receipt_audit": f"""
WITH {STOCK_EVENTS}
SELECT 'receipt' || docno || '/1/' || day || '/r/w/' || CASE WHEN slot < 5 THEN '1' ELSE '2' END || '/d/mat' || (slot % 5)
  || '/' || (slot % 5) || '/EA/new/' || q || '/' || CASE WHEN low THEN lower(u) ELSE u END || '/'
  || CASE WHEN k % 7 <> 0 THEN '***' END || '/' || CASE WHEN kind = 'R' THEN 'serialized' ELSE 'non-serialized' END AS fntext
FROM ev WHERE kind IN ('R', 'BR')""",
    "raw_landing": "SELECT html AS details, 'page pull' AS activity_type, true AS is_dated FROM pages",
    "outbox_defaults": f"""
SELECT CAST(user_id AS INTEGER) AS contractorid, CASE WHEN {K} >= 10 THEN {K} % 10 END AS roleid, 102 AS type_id,
       false AS status_created, false AS inserted, CAST(NULL AS VARCHAR) AS request FROM events""",
    "lookup_lowest_id": """
SELECT l_partkey AS p_partkey, l.low AS lowest_partkey, count(*) AS n
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN (SELECT p_name, p_brand, min(p_partkey) AS low FROM part GROUP BY ALL) l USING (p_name, p_brand)
GROUP BY ALL""",
    "concat_skip_null": """
SELECT c_custkey, concat(c_name, n_name) AS skipped, c_name || ' ' || n_name AS joined
FROM customer LEFT JOIN nation ON c_custkey = n_nationkey""",
    "date_of_text": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders",
    "decimal_qty": "SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,4))) AS DECIMAL(18,4)) AS qty FROM lineitem GROUP BY l_partkey",
    "distinct_typed": "SELECT DISTINCT l_partkey, l_returnflag AS flag, l_linestatus AS line FROM lineitem",
    "not_in_nulls": """
SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality NOT IN (-1, 0)""",
    "latest_row": """
SELECT user_id, event_type, value, props FROM events WHERE event_type IN ('signup', 'purchase')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
}

ORACLES["install_wanted"] = ORACLES["install_push"].replace(
    "AND NOT plain\n", "AND NOT plain AND id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')\n"
)
ORACLES["install_returned"] = f"""
SELECT '' AS url, 106 AS codepart, * EXCLUDE (responselogid, distnid, distributionnodecode, description, type_id)
FROM ({ORACLES["install_push"]})"""
ORACLES["stock_movements_split"] = ORACLES["stock_movements"]
ORACLES["api_landing"] = """
SELECT text AS details, 'serialized' AS type, 'CRV' AS wh_activity, false AS status, true AS is_dated FROM conversations"""
