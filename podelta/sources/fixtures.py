"""Stand-in input views built from the driver tables.

Each view only reshapes driver rows into the schema a job expects (see
FIXTURES.md); none of them does a job's work.  The SQL text is portable:
Spark registers it as temp views, and the DuckDB oracle uses the very same
text as a ``WITH`` chain, so both sides read identical inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from podelta.config import LINE_FIELDS, SHIPMENT_DATES, TRACKED_DANGLING, TRACKED_MAP
from podelta.session import pinned
from podelta.sources.tables import register_tables

AS_OF = "1998-06-15"

_STATUS_CASE = """CASE CAST((l_orderkey + l_linenumber) % 10 AS INT)
         WHEN 0 THEN '02. Supplier Confirmation Pending' WHEN 1 THEN '03. PI Upload Pending' WHEN 2 THEN '08. PRD Pending'
         WHEN 3 THEN '09. Under Production' WHEN 4 THEN '10. PRD Confirmation Pending' WHEN 5 THEN '14. Sign-Off'
         WHEN 6 THEN '17. QC Schedule Pending' WHEN 7 THEN '20. Pre Pickup Check'
         WHEN 8 THEN '27. BL Payment Pending - Arrived' ELSE '99. Done' END"""

_SUB_STATUS_CASE = """CASE CAST((l_orderkey + l_linenumber) % 10 AS INT)
         WHEN 0 THEN '02. Supplier Confirmation Pending' WHEN 1 THEN '03. PI Upload Pending' WHEN 2 THEN '08. PRD Pending'
         WHEN 3 THEN '09a. Production Delayed' WHEN 4 THEN '10. PRD Confirmation Pending' WHEN 5 THEN '14a. AVA Email Not Sent'
         WHEN 6 THEN '17. QC Schedule Pending' WHEN 7 THEN '20a. QC Release Missing'
         WHEN 8 THEN '27a. Approved' ELSE '99. Done' END"""

# Columns of the tracked list that the order lines have under the same name, and what fills the key.
_REAL = ("sm", "current_status", "sub_status", "days_bucket", "final_team", "final_poc", "document_number", "item", "batch_id", "cm",
         "compliance_status", "invoice_number", "inb", "name")


def _wide_value(source: str, kind: str, at: int) -> str:
    """What fills a column of the wide stand-ins: real where there is one, else by rule, with NULLs, blanks and large numbers."""
    if source in ("rollup_id", "order_line_id"):
        return "line_key"
    if source in _REAL:
        return source
    if source == "pending_value":
        return "pending_value * 1000000"
    if kind == "whole":
        return f"CASE WHEN (k + {at}) % 29 = 0 THEN NULL ELSE CAST(quantity + {at} AS DOUBLE) END"
    if kind == "float":
        return f"pending_value / {at + 7}"
    if kind == "date":
        return f"CASE WHEN (k + {at}) % 19 = 0 THEN NULL ELSE CAST(first_prd AS STRING) END"
    return f"CASE CAST((k + {at}) % 23 AS INT) WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'nan' ELSE 'Value ' || CAST((k + {at}) % 5 AS STRING) END"


def _wide_held(source: str, kind: str, at: int) -> str:
    value = _wide_value(source, kind, at)
    if kind in ("whole", "float"):
        return f"CASE WHEN (k + {at}) % 17 = 0 THEN {value} + 1 ELSE {value} END"
    return f"CASE CAST((k + {at}) % 31 AS INT) WHEN 0 THEN 'Earlier' WHEN 1 THEN NULL WHEN 2 THEN ' ' || {value} || ' ' ELSE {value} END"


_WIDE_FROM = """FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k, ROW_NUMBER() OVER (PARTITION BY line_key ORDER BY ord) AS rn
      FROM order_lines) t WHERE rn = 1"""
_WIDE_SOURCES = {source: (kind, at) for at, (_, source, kind) in enumerate(TRACKED_MAP) if source not in TRACKED_DANGLING}

_DOCUMENT_COLUMNS = {"document_number": "document_number", "item": "item", "name": "name", "order_line_id": "line_key", "cm": "cm", "sm": "sm",
                     "current_status": "current_status", "sub_status": "sub_status", "final_poc": "final_poc", "days_bucket": "days_bucket"}


def _document_value(name: str, kind, at: int) -> str:
    """JSON text of one field: real where there is one, else by rule, with NULLs, bad and too long values."""
    if name in _DOCUMENT_COLUMNS:
        return f"""COALESCE('"' || {_DOCUMENT_COLUMNS[name]} || '"', 'null')"""
    n = f"CAST((k + {at}) % 13 AS INT)"
    if kind == "whole":
        return (f"""CASE {n} WHEN 0 THEN '"abc"' WHEN 1 THEN 'null' WHEN 2 THEN '"12.5"' WHEN 3 THEN '"5d"' """
                f"""WHEN 4 THEN '"9999999999999999999"' ELSE CAST(quantity + {at} AS STRING) END""")
    if kind == "float":
        return f"""CASE {n} WHEN 0 THEN '"1e3"' WHEN 1 THEN 'null' WHEN 2 THEN '"1_0"' ELSE CAST(quantity + {at} AS STRING) || '.25' END"""
    if kind == "date":
        return f"""CASE {n} WHEN 0 THEN '"soon"' WHEN 1 THEN 'null' WHEN 2 THEN '"1998-02-30"' ELSE '"' || CAST(first_prd AS STRING) || '"' END"""
    return f"""CASE {n} WHEN 0 THEN 'null' WHEN 1 THEN '""' WHEN 2 THEN '" padded text {at} "' ELSE '"Text ' || CAST(k % 40000 AS STRING) || '"' END"""


def _day(at: int, fmt: str) -> str:
    """A date as text: the order's year, another month and day per column."""
    year, month, day = "SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4)", f"'{at % 12 + 1:02}'", f"'{at * 2 + 1:02}'"
    return f"{day} || '.' || {month} || '.' || {year}" if fmt.startswith("dd") else f"{year} || '-' || {month} || '-' || {day}"


# name -> (sql, dependencies).  Order is a valid build order.
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_lines": (f"""
SELECT 'PO' || CAST(l_orderkey AS STRING) AS document_number,
       'P' || CAST(l_partkey AS STRING) AS item,
       CAST(l_linenumber AS STRING) || '.0' AS line_id_raw,
       CAST(l_linenumber AS STRING) AS line_id,
       'PO' || CAST(l_orderkey AS STRING) || 'P' || CAST(l_partkey AS STRING) || CAST(l_linenumber AS STRING) AS line_key,
       CAST(l_suppkey AS STRING) || ' ' || s_name AS name,
       p_brand AS brand,
       CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE 'B' || CAST(l_orderkey % 500 AS STRING) END AS batch_id,
       CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE 'INB' || CAST(l_orderkey AS STRING) END AS inb,
       CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS prd,
       CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_shipdate AS DATE) ELSE CAST(o_orderdate AS DATE) END AS first_prd,
       CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE 'INV' || CAST(l_orderkey AS STRING) END AS invoice_number,
       {_STATUS_CASE} AS current_status,
       {_SUB_STATUS_CASE} AS sub_status,
       CASE CAST(l_partkey % 4 AS INT) WHEN 0 THEN 'Blocked' WHEN 1 THEN ' ' WHEN 2 THEN 'Approved' ELSE NULL END AS compliance_status,
       CASE CAST(l_partkey % 3 AS INT) WHEN 0 THEN '1 | Awaiting Release' WHEN 1 THEN '2 | Not Applicable' ELSE NULL END AS qc_status,
       CASE WHEN l_partkey % 5 = 0 THEN CAST(l_shipdate AS DATE) ELSE NULL END AS qc_date,
       CASE WHEN l_linenumber % 2 = 1 THEN 'Yes' ELSE 'No' END AS im_signoff,
       CAST(l_quantity AS BIGINT) AS quantity,
       l_extendedprice AS pending_value,
       'User' || CAST(l_suppkey % 20 AS STRING) AS final_poc,
       'User' || CAST(l_orderkey % 20 AS STRING) AS sm,
       'User' || CAST(l_partkey % 20 AS STRING) AS cm,
       CASE CAST(l_partkey % 3 AS INT) WHEN 0 THEN '0-7' WHEN 1 THEN '8-30' ELSE '30+' END AS days_bucket,
       'Team ' || CAST(l_suppkey % 4 AS STRING) AS final_team,
       CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS BIGINT) AS ord
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
""", ()),
    "order_line_snapshots": ("""
SELECT *, TIMESTAMP '1998-06-15 06:00:00' AS snapshot_ts FROM order_lines
UNION ALL
SELECT *, TIMESTAMP '1998-06-14 06:00:00' AS snapshot_ts FROM order_lines WHERE ord > 1
""", ("order_lines",)),
    # What the lines were at the run before: some batches are new since, some have other documents, quantities and owners changed.
    "previous_lines": ("""
SELECT CASE WHEN k % 500 % 13 = 0 THEN 'X' || document_number ELSE document_number END AS document_number, item, line_id_raw, line_id,
       CASE WHEN k % 500 % 13 = 0 THEN 'X' || line_key ELSE line_key END AS line_key, name, brand, batch_id, inb, prd, first_prd,
       invoice_number, current_status, sub_status, compliance_status, qc_status, qc_date, im_signoff,
       CASE WHEN k % 6 = 0 THEN quantity + 1 ELSE quantity END AS quantity, pending_value,
       CASE WHEN k % 5 = 0 THEN 'User1' ELSE final_poc END AS final_poc, sm, ord
FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k FROM order_lines) t WHERE k % 10 <> 0
""", ("order_lines",)),
    "desired_list": ("""
SELECT line_key AS title, current_status, sub_status, CAST(quantity AS STRING) AS quantity, pending_value, qc_status, final_poc, sm
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY line_key ORDER BY ord) AS rn FROM order_lines) t WHERE rn = 1
""", ("order_lines",)),
    "existing_list": ("""
SELECT CASE WHEN k % 13 = 0 THEN 'OLD' || line_key ELSE line_key END AS title,
       k * 100 + ord AS list_id,
       CASE WHEN k % 6 = 0 THEN '01. Earlier' ELSE current_status END AS current_status,
       CASE WHEN k % 8 = 0 THEN NULL ELSE ' ' || sub_status || ' ' END AS sub_status,
       CAST(quantity AS STRING) || '.0' AS quantity,
       pending_value,
       CASE WHEN qc_status IS NULL THEN NULL ELSE '{"Value":"' || qc_status || '"}' END AS qc_status,
       CASE WHEN k % 5 = 0 THEN 'User1' ELSE final_poc END AS final_poc,
       sm,
       CASE CAST(k % 3 AS INT) WHEN 0 THEN '101; 103' WHEN 1 THEN '102,104' ELSE NULL END AS ids_with_access
FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k,
             ROW_NUMBER() OVER (PARTITION BY line_key ORDER BY ord) AS rn FROM order_lines) t
WHERE rn = 1 AND k % 10 <> 0
""", ("order_lines",)),
    "vendors": ("""
SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name, LOWER(s_name) || '@example.com' AS email,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'cm' || CAST(s_suppkey % 20 AS STRING) || '@example.com' END AS cm_email,
       'sm' || CAST(s_suppkey % 9 AS STRING) || '@example.com' AS sm_email
FROM supplier WHERE s_suppkey % 4 <> 0
UNION ALL
SELECT CAST(s_suppkey AS STRING), s_name, 'zz-second@example.com', 'zz-cm@example.com', NULL FROM supplier WHERE s_suppkey % 5 = 0
""", ()),
    "sent_ledger": ("""
SELECT DISTINCT line_key, document_number, item, line_id, '1998-06-01' AS date_sent, 'No' AS resend
FROM order_lines WHERE CAST(SUBSTR(document_number, 3) AS BIGINT) % 4 = 0
""", ("order_lines",)),
    "shipment_header": (f"""
SELECT 'INB' || CAST(o_orderkey AS STRING) AS shipment_number,
       'C' || CAST(o_custkey AS STRING) AS container,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS actual_arrival_date,
       SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2) || '.' || SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2)
         || '.' || SUBSTR(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) AS telex_release_date,
       o_orderpriority AS forwarder,
       {", ".join(f"""CASE CAST((o_orderkey + {at}) % 11 AS INT) WHEN 0 THEN 'soon' WHEN 1 THEN NULL WHEN 2 THEN '1998-02-30'
         ELSE {_day(at, fmt)} END AS {c}""" for at, (c, fmt) in enumerate(SHIPMENT_DATES) if at > 1)},
       'Method ' || CAST(o_orderkey % 3 AS STRING) AS shipment_method, 'Port ' || CAST(o_custkey % 7 AS STRING) AS port_of_departure,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'Port ' || CAST(o_custkey % 9 AS STRING) END AS port_of_arrival,
       CASE WHEN o_orderkey % 4 = 0 THEN 'held, see note' ELSE NULL END AS ff_remarks
FROM orders
""", ()),
    "shipment_lines": ("""
SELECT inb AS shipment_number, line_key AS po_line_unique_key FROM order_lines WHERE inb IS NOT NULL
""", ("order_lines",)),
    "batch_lines": ("""
SELECT DISTINCT line_key AS po_line_key, batch_id FROM order_lines WHERE batch_id IS NOT NULL
""", ("order_lines",)),
    "invoice_map": ("""
SELECT line_key AS po_line_unique_key, invoice_number AS document_number FROM order_lines WHERE invoice_number IS NOT NULL
""", ("order_lines",)),
    "packing_log": ("""
SELECT CAST(o_custkey AS STRING) || '#PO' || CAST(o_orderkey AS STRING) AS vendor_id_po_number,
       'B' || CAST(o_orderkey % 500 AS STRING) || '#PL' || CAST(o_orderkey AS STRING) AS shipment_batch_id_pl_id,
       REPLACE(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '.') AS created_date,
       CASE WHEN o_orderstatus = 'F' THEN 'uploaded' ELSE 'pending' END AS telex_status
FROM orders
""", ()),
    "confirmations": ("""
SELECT document_number AS po_number, item, line_id,
       CASE WHEN current_status = '99. Done' THEN 'Closed' WHEN ord = 5 THEN NULL ELSE 'Open' END AS final_status,
       CASE WHEN ord = 2 THEN 'internal_flow' ELSE NULL END AS memo, first_prd AS confirmation_date
FROM order_lines
""", ("order_lines",)),
    "line_attributes": ("""
SELECT document_number, item, line_id, brand AS currency, name AS deliver_to_location,
       SUBSTR(CAST(first_prd AS STRING), 9, 2) || '.' || SUBSTR(CAST(first_prd AS STRING), 6, 2) || '.' || SUBSTR(CAST(first_prd AS STRING), 1, 4)
         || ' 08:30' AS date_created
FROM order_lines
""", ("order_lines",)),
    # --- additions beyond FIXTURES.md part B (documented there) ---
    "planned_pickup": ("""
SELECT batch_id, MAX(first_prd) AS batch_spd FROM order_lines GROUP BY batch_id
""", ("order_lines",)),
    "po_line_snapshots": ("""
SELECT document_number, item, line_id, quantity,
       CASE WHEN ord % 3 = 0 AND snapshot_ts > TIMESTAMP '1998-06-14 12:00:00' THEN quantity ELSE 0 END AS received,
       snapshot_ts
FROM order_line_snapshots
""", ("order_line_snapshots",)),
    "deny_list": ("""
SELECT DISTINCT document_number FROM order_lines WHERE CAST(SUBSTR(document_number, 3) AS BIGINT) % 17 = 0
""", ("order_lines",)),
    "held_inspections": ("""
SELECT CASE WHEN k % 13 = 0 THEN 'OLD' || line_key ELSE line_key END AS title, k * 100 + ord AS list_id,
       CASE WHEN qc_status IS NULL THEN NULL WHEN k % 7 = 0 THEN '{"Value":"Pending"}'
            ELSE '{"Value":"' || SUBSTR(qc_status, 5) || '"}' END AS qi_result,
       CAST(qc_date AS STRING) AS qi_date, CASE WHEN k % 9 = 0 THEN 'soon' ELSE CAST(prd AS STRING) END AS prd, batch_id,
       item AS item_key, line_id, brand, compliance_status, SUBSTR(name, 1, INSTR(name, ' ') - 1) AS vendor_id,
       SUBSTR(name, INSTR(name, ' ') + 1) AS vendor_name,
       CASE WHEN k % 6 = 0 THEN '01. Earlier' ELSE current_status END AS current_status, sub_status, days_bucket, final_team,
       CASE WHEN k % 5 = 0 THEN 'User1' ELSE final_poc END AS final_poc, cm, sm, '' AS name, document_number,
       CAST(NULL AS STRING) AS item, '' AS subset, 'No' AS sent_already, CAST(prd AS STRING) AS email_scheduled_for,
       LOWER(SUBSTR(name, INSTR(name, ' ') + 1)) || '@example.com' AS vendor_email, 'sm1@example.com' AS sm_email,
       CAST(NULL AS STRING) AS ids_with_access,
       CASE CAST((k * 100 + ord) % 7 AS INT) WHEN 0 THEN '{''Value'': ''Yes'', ''Id'': 1}' WHEN 1 THEN '{''Value'': ''No'', ''Id'': 2}'
         WHEN 2 THEN 'Yes' ELSE NULL END AS send_early
FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k,
             ROW_NUMBER() OVER (PARTITION BY line_key ORDER BY ord) AS rn FROM order_lines) t
WHERE rn = 1 AND k % 10 <> 0
""", ("order_lines",)),
    "tracked_rows": (f"""
SELECT {", ".join(f"{_wide_value(c, kind, at)} AS {c}" for c, (kind, at) in _WIDE_SOURCES.items())}
{_WIDE_FROM}
""", ("order_lines",)),
    "held_tracked": (f"""
SELECT CASE WHEN k % 13 = 0 THEN 'OLD' || line_key ELSE line_key END AS title, k * 100 + ord AS list_id,
       {", ".join(f"{_wide_held(c, kind, at)} AS {f}" for at, (f, c, kind) in enumerate(TRACKED_MAP) if f != "title")},
       CASE CAST(k % 3 AS INT) WHEN 0 THEN '101; 103' WHEN 1 THEN '102,104' ELSE NULL END AS ids_with_access
{_WIDE_FROM} AND k % 10 <> 0
""", ("order_lines",)),
    "line_documents": (f"""
SELECT line_key, ord, '{{' || {" || ',' || ".join(f"""'"{key}":' || {_document_value(name, kind, at)}""" for at, (key, kind, name) in enumerate(LINE_FIELDS))}
       || '}}' AS rdata, snapshot_ts
FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k FROM order_line_snapshots) t
""", ("order_line_snapshots",)),
    # Quantities as an extract delivers them: text, with blanks of both kinds and NULLs.
    "raw_quantities": ("""
SELECT line_key, ord,
       CASE CAST(k % 7 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE CAST(quantity AS STRING) END AS quantity,
       CASE CAST(k % 5 AS INT) WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE CAST(quantity AS STRING) || '.5' END AS quantity_received,
       CASE CAST((k + ord) % 6 AS INT) WHEN 0 THEN '' WHEN 1 THEN '0' ELSE CAST(quantity + ord AS STRING) || '.0' END AS quantity_on_shipments
FROM (SELECT *, CAST(SUBSTR(document_number, 3) AS BIGINT) AS k FROM order_lines) t
""", ("order_lines",)),
    "delivery_results": ("""
SELECT CAST(o_orderkey % 997 AS BIGINT) AS batch_no, CAST(o_orderkey AS BIGINT) AS attempt,
       CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'timeout' WHEN 1 THEN NULL WHEN 2 THEN 'error' ELSE 'ok' END AS status,
       CASE CAST(o_orderkey % 7 AS INT) WHEN 2 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END AS success,
       CAST(o_orderkey % 31 AS BIGINT) AS rows_read, CAST(o_orderkey % 29 AS BIGINT) AS rows_processed
FROM orders
""", ()),
    "qi_list": ("""
SELECT title,
       CASE CAST(list_id % 7 AS INT) WHEN 0 THEN '{''Value'': ''Yes'', ''Id'': 1}' WHEN 1 THEN '{''Value'': ''No'', ''Id'': 2}'
         WHEN 2 THEN 'Yes' ELSE NULL END AS send_early
FROM existing_list
""", ("existing_list",)),
}


# Spark joins the orders last and hashes them, so the lines are shuffled by order once, for that join and the row number alike, and
# sorted once.  The joins are inner ones, so their order does not matter to the rows; DuckDB reads the text above.
_LINE_JOINS = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"
_ORDERS_LAST = "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"


def spark_text(name: str) -> str:
    """SQL that Spark registers for a stand-in; the rows are those of ``FIXTURES``."""
    text = FIXTURES[name][0].strip()
    if _LINE_JOINS not in text:
        return text
    return text.replace(_LINE_JOINS, _ORDERS_LAST).replace("SELECT", "SELECT /*+ SHUFFLE_HASH(orders) */", 1)


# In a session the joins and both numbers of the lines are built once and kept (``session.pinned``) as the tables' own columns; the
# order lines are a projection of them, so that views that read the lines several times share one shuffle.
LINE_CORE, FIRST_LINES = "line_core", "first_order_lines"
# Views of a few columns without a number read the tables themselves, pruned.
PLAIN_LINES, PLAIN_VIEWS = "plain_order_lines", ("shipment_lines", "batch_lines")
_POSITION = re.compile(r"CAST\(ROW_NUMBER\(\) OVER \(.*?\) AS BIGINT\) AS ord", re.DOTALL)
_FIRST_OF_KEY = re.compile(r"ROW_NUMBER\(\) OVER \(PARTITION BY line_key ORDER BY ord\) AS rn(\s+FROM) order_lines\b")


def core_text() -> str:
    """The joined lines with their position, and whether each is the first of its line key.

    A line key starts with its order's number, so lines of one key lie in one order and are numbered without another shuffle.
    """
    position = _POSITION.search(FIXTURES["order_lines"][0]).group()
    return f"""
SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, CAST(l_partkey AS STRING) || CAST(l_linenumber AS STRING) ORDER BY ord) = 1 AS first_of_key
FROM (SELECT /*+ SHUFFLE_HASH(orders) */ l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, s_name, p_brand,
             o_orderdate, {position}
      {_ORDERS_LAST}) t"""


def lines_text() -> str:
    """The order lines over the kept ones."""
    text = FIXTURES["order_lines"][0].strip()
    return _POSITION.sub("ord", text).replace(_LINE_JOINS, f"FROM {LINE_CORE}")


def first_lines_text() -> str:
    """The first line of each line key; lines without a number have the key NULL in every order, and one of them stands for all."""
    return f"""{lines_text()} WHERE first_of_key AND (l_linenumber IS NOT NULL
  OR l_orderkey = (SELECT MIN(STRUCT(ord, l_orderkey)).l_orderkey FROM {LINE_CORE} WHERE l_linenumber IS NULL))"""


def kept_text(name: str) -> str:
    """SQL of a stand-in over the kept lines; the rows are those of ``FIXTURES``."""
    if name in PLAIN_VIEWS:
        return FIXTURES[name][0].strip().replace("FROM order_lines", f"FROM {PLAIN_LINES}")
    return lines_text() if name == "order_lines" else _FIRST_OF_KEY.sub(rf"1 AS rn\1 {FIRST_LINES}", FIXTURES[name][0].strip())


def closure(names) -> list[str]:
    """Fixture names needed for ``names``, in build order."""
    needed: set[str] = set()

    def visit(n: str) -> None:
        if n in needed:
            return
        for d in FIXTURES[n][1]:
            visit(d)
        needed.add(n)

    for n in names:
        visit(n)
    return [n for n in FIXTURES if n in needed]


def cte_chain(names) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for the DuckDB oracle."""
    parts = [f"{n} AS ({FIXTURES[n][0].strip()})" for n in closure(names)]
    return "WITH " + ",\n".join(parts)


def register_fixtures(spark: SparkSession, sf_dir: str, names=None, cache: bool = False) -> None:
    """Register the driver tables and the stand-in views in the session.

    Views already registered for the same ``sf_dir`` are reused, so a
    session running many queries builds (and, with ``cache``, keeps) each
    stand-in input once.

    ``cache=True`` keeps each view in memory once built, as a stand-in for
    the materialised source tables a production run reads; the bench uses
    it so timings measure the jobs, not the fixture SQL.
    """
    conf_key = "podelta.fixtures.dir"
    same_dir = spark.conf.get(conf_key, "") == sf_dir
    if not same_dir:
        register_tables(spark, sf_dir)
        spark.conf.set(conf_key, sf_dir)
        spark.conf.set("podelta.fixtures.views", "")
    done = set(filter(None, spark.conf.get("podelta.fixtures.views", "").split(",")))
    names = list(names or FIXTURES)
    numbered = "order_lines" in closure(n for n in names if n not in PLAIN_VIEWS)
    for n in closure(names):
        if n in done:
            continue
        if n == "order_lines":
            spark.sql(spark_text(n)).createOrReplaceTempView(PLAIN_LINES)
            if not numbered:
                continue
            pinned(spark.sql(core_text())).createOrReplaceTempView(LINE_CORE)
            spark.sql(first_lines_text()).createOrReplaceTempView(FIRST_LINES)
        df = spark.sql(kept_text(n))
        if cache:
            df = df.cache()
        df.createOrReplaceTempView(n)
        done.add(n)
    spark.conf.set("podelta.fixtures.views", ",".join(sorted(done)))
