"""Independent DuckDB SQL for every catalogued query.

Written by hand from the operator semantics, not generated from the Spark
code.  Each string is ``WITH <stand-in views> <query>`` over the driver's
pre-registered tables.
"""

from __future__ import annotations

from podelta.config import INSPECTION_MAP, LINE_FIELDS, LAST_LABEL, NOT_BLANK, SHIPMENT_DATES, TRACKED_DANGLING, TRACKED_MAP, TRACKER_RULES
from podelta.sources.fixtures import cte_chain

ORACLE: dict[str, str] = {}


def sql(name: str, needs: tuple[str, ...], body: str, extra: str = "") -> None:
    ctes = [cte_chain(needs)[len("WITH "):]] if needs else []
    if extra:
        ctes.append(extra.strip())
    prefix = ("WITH " + ",\n".join(ctes) + "\n") if ctes else ""
    ORACLE[name] = prefix + body.strip()


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _cond_sql(cond) -> str:
    col = cond.column
    if tuple(cond.values) == (NOT_BLANK,):
        return f"({col} IS NOT NULL AND trim(CAST({col} AS VARCHAR)) <> '')"
    texts = [str(v).strip() for v in cond.values if v is not None]
    parts = []
    if texts:
        parts.append(f"trim(CAST({col} AS VARCHAR)) IN ({', '.join(_q(t) for t in texts)})")
    if any(v is None for v in cond.values):
        parts.append(f"{col} IS NULL")
    return "(" + " OR ".join(parts) + ")"


def _tracker_sql() -> str:
    cases = []
    ordered = [r for r in TRACKER_RULES if r.name != LAST_LABEL] + [r for r in TRACKER_RULES if r.name == LAST_LABEL]
    for r in ordered:
        cond = " AND ".join(_cond_sql(c) for c in r.conditions)
        cases.append(f"CASE WHEN {cond} THEN {_q(r.name)} END")
    return "concat_ws(', ', " + ", ".join(cases) + ")"


def _labelled(source: str = "order_lines") -> str:
    return f"""labelled AS (
  SELECT *, {_tracker_sql()} AS tracker FROM {source}
)"""


LABELLED = _labelled()

sql("tracker_labels", ("order_lines",), """
SELECT document_number, ord, line_key, tracker FROM labelled WHERE tracker <> ''
""", extra=LABELLED)

_NOTES = ", ".join(f"'' AS sm_{t}_{k}" for t in ("g2", "g4", "pickup", "spd", "tlx", "bp", "pp", "cprd", "prd")
                   for k in ("status", "blocker", "comments"))
sql("order_lines_tracked", ("order_lines",), f"""
SELECT document_number, ord, line_key, tracker, coalesce(quantity, 0) AS quantity, {_NOTES},
       '' AS update_type, '' AS initial_access, '' AS final_access, '' AS final_access_email, '' AS poc_changed
FROM labelled WHERE tracker <> ''
""", extra=LABELLED)

sql("quantities_filled", ("raw_quantities",), "SELECT line_key, ord, " + ", ".join(
    f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 0 ELSE CAST({c} AS DOUBLE) END AS {c}"
    for c in ("quantity", "quantity_received", "quantity_on_shipments")) + " FROM raw_quantities")

sql("tracker_counts", ("order_lines",), """
SELECT t AS tracker, COUNT(*) AS lines
FROM (SELECT unnest(string_split(tracker, ', ')) AS t FROM labelled WHERE tracker <> '') s
GROUP BY t
""", extra=LABELLED)



# --- keys, dedupe, alignment -------------------------------------------------
sql("line_keys", ("order_lines",), """
SELECT document_number, ord,
       split_part(name, ' ', 1) AS vendor_id,
       CASE WHEN strpos(name, ' ') > 0 THEN substr(name, strpos(name, ' ') + 1) END AS vendor_name,
       CASE WHEN line_id_raw IS NULL THEN 'nan' WHEN line_id_raw = '' THEN '0'
            ELSE regexp_replace(line_id_raw, '\\.0$', '') END AS line_id,
       document_number || item || CASE WHEN line_id_raw IS NULL THEN 'nan' WHEN line_id_raw = '' THEN '0'
            ELSE regexp_replace(line_id_raw, '\\.0$', '') END AS order_line_id,
       document_number || item || split_part(name, ' ', 1) AS vendor_line_id,
       CASE WHEN sub_status IN ('17. QC Schedule Pending', '20a. QC Release Missing') THEN 'otif' ELSE '' END AS subset
FROM order_lines
""")

sql("dedupe_first", ("order_lines",), """
SELECT line_key, document_number, ord, item, current_status, prd
FROM (SELECT *, row_number() OVER (PARTITION BY line_key ORDER BY ord NULLS FIRST) AS rn FROM order_lines) t
WHERE rn = 1
""")

sql("align_schema", ("order_lines",), """
SELECT line_key AS title, current_status, sub_status, quantity, pending_value, qc_status,
       CAST(NULL AS VARCHAR) AS poc_primary, final_poc, sm, CAST(NULL AS VARCHAR) AS fob_date,
       CAST(NULL AS VARCHAR) AS list_id
FROM order_lines
""")


# --- change set ----------------------------------------------------------------
def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_PYF = r"^[+-]?((\d(_?\d)*)?\.\d(_?\d)*|\d(_?\d)*\.?)([eE][+-]?\d(_?\d)*)?$|^[+-]?(?i:inf|infinity)$"


def _canon_s(x: str) -> str:
    s = _strip(x)
    num = f"TRY_CAST(replace({s}, '_', '') AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL OR {s} = '' THEN NULL "
            f"WHEN regexp_matches({s}, '^[+-]?(?i:nan)$') THEN 'NAN' "
            f"WHEN regexp_matches({s}, '{_PYF}') AND {num} IS NOT NULL THEN 'N:' || CAST({num} + 0.0 AS VARCHAR) "
            f"ELSE 'S:' || {s} END)")


def _canon_d(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL ELSE 'N:' || CAST({x} + 0.0 AS VARCHAR) END)"


_ALL_FIELDS = ("current_status", "sub_status", "quantity", "pending_value", "qc_status", "final_poc", "sm")
_UID = "CASE {x} " + " ".join(f"WHEN 'User{i}' THEN '{100 + i}'" for i in range(20)) + " END"
_ADMINS = "['101', '119']"
_OWNERS = ("final_poc", "sm")


def _uid(x: str) -> str:
    return "(" + _UID.format(x=x) + ")"


def _blank(x: str) -> str:
    return f"({x} IS NULL OR {_strip(x)} = '')"


class ListSql:
    """Change set between two lists of the same columns, as CTEs.  ``numbers`` are compared as doubles, ``floats`` of them rounded."""

    def __init__(self, fields, floats=(), numbers=(), dropdowns=(), unchecked=(), old="existing_list", new="desired_list"):
        self.fields, self.floats, self.numbers, self.dropdowns = fields, floats, (*floats, *numbers), dropdowns
        self.checked = [f for f in fields if f not in unchecked]
        self.old, self.new = old, new

    def canon(self, f: str, x: str) -> str:
        return _canon_d(x) if f in self.numbers else _canon_s(x)

    def fmt(self, f: str, x: str) -> str:
        return f"round({x}, 3)" if f in self.floats else x

    def clean(self, f: str, x: str) -> str:
        if f in self.numbers:
            return x
        return f"coalesce(CASE WHEN {x} NOT IN ('nan', 'NaN', 'NAN') THEN {x} END, '')"

    def decoded(self, f: str) -> str:
        if f not in self.dropdowns:
            return f"{self.typed(f, 'E')} AS od_{f}"
        return (f"CASE WHEN json_valid(E.{f}) AND starts_with(ltrim(E.{f}), '{{') AND list_contains(json_keys(E.{f}), 'Value') "
                f"THEN E.{f} ->> '$.Value' ELSE E.{f} END AS od_{f}")

    def typed(self, f: str, side: str) -> str:
        return f"CAST({side}.{f} AS DOUBLE)" if f in self.numbers else f"{side}.{f}"

    def changes(self) -> str:
        every = self.fields
        return f"""
E AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY list_id NULLS FIRST) AS rn
                                  FROM {self.old} WHERE title IS NOT NULL) t WHERE rn = 1),
N AS (SELECT * FROM {self.new} WHERE title IS NOT NULL),
J AS (
  SELECT coalesce(E.title, N.title) AS title, E.title IS NOT NULL AS in_old, N.title IS NOT NULL AS in_new,
         E.list_id AS item_id, E.ids_with_access AS access_old,
         {", ".join(f"{self.typed(f, 'E')} AS o_{f}, {self.typed(f, 'N')} AS n_{f}" for f in every)},
         {", ".join(self.decoded(f) for f in every)}
  FROM E FULL OUTER JOIN N ON E.title = N.title
),
C AS (
  SELECT *, {", ".join(f"NOT ({self.canon(f, self.fmt(f, 'od_' + f))} IS NOT DISTINCT FROM {self.canon(f, self.fmt(f, 'n_' + f))}) AS ch_{f}"
                        for f in every)}
  FROM J
),
A AS (
  SELECT *, CASE WHEN in_new AND NOT in_old THEN 'add' WHEN in_old AND NOT in_new THEN 'delete'
                 WHEN {" OR ".join(f"ch_{f}" for f in self.checked)} THEN 'update' ELSE '' END AS pre
  FROM C
),
V AS (
  SELECT *, {", ".join(f"CASE pre WHEN 'add' THEN {self.fmt(f, 'n_' + f)} WHEN 'update' THEN CASE WHEN ch_{f} THEN {self.fmt(f, 'n_' + f)} END "
                        f"WHEN 'delete' THEN {self.fmt(f, 'o_' + f)} END AS v_{f}" for f in every)}
  FROM A
)"""

    def no_access(self) -> str:
        kept = " OR ".join(f"(v_{f} IS NOT NULL AND NOT isnan(v_{f}))" if f in self.numbers
                           else f"(v_{f} IS NOT NULL AND {_strip('v_' + f)} NOT IN ('', 'nan', 'NaN', 'NAN'))" for f in self.checked)
        return self.changes() + f""",
F AS (SELECT *, CASE WHEN pre = 'update' AND NOT ({kept}) THEN '' ELSE pre END AS action FROM V),
CS AS (
  SELECT title, CAST(item_id AS BIGINT) AS list_id, {", ".join(f"{self.clean(f, 'v_' + f)} AS {f}" for f in self.fields)},
         action, array_to_string(list_sort(list_distinct({_ADMINS})), '; ') AS add_user_ids,
         '' AS remove_user_ids, '' AS ids_with_access
  FROM F WHERE action <> ''
)"""

    def access(self) -> str:
        grants = ", ".join(f"CASE WHEN NOT {_blank('n_' + f)} THEN {_uid('n_' + f)} END" for f in _OWNERS)
        revokes = ", ".join(
            f"CASE WHEN NOT ({_canon_s('od_' + f)} IS NOT DISTINCT FROM {_canon_s('n_' + f)}) AND NOT {_blank('o_' + f)} "
            f"THEN {_uid('o_' + f)} END" for f in _OWNERS)
        have = ("list_filter(list_transform(string_split_regex(coalesce(access_old, ''), '[,;]'), lambda t: trim(t)), "
                "lambda t: t <> '')")
        return self.changes() + f""",
X AS (SELECT *, list_filter([{grants}], lambda x: x IS NOT NULL) AS add_l,
                list_filter([{revokes}], lambda x: x IS NOT NULL) AS rem_l,
                {have} AS have
      FROM V),
Y AS (SELECT *,
        CASE WHEN in_old AND in_new
               THEN list_sort(list_distinct(list_filter(list_concat(add_l, {_ADMINS}), lambda x: NOT list_contains(have, x))))
             WHEN pre = 'add' THEN {_ADMINS}
             ELSE CAST([] AS VARCHAR[]) END AS addp,
        CASE WHEN in_old AND in_new THEN list_sort(list_distinct(list_filter(rem_l, lambda x: list_contains(have, x))))
             ELSE CAST([] AS VARCHAR[]) END AS remp
      FROM X),
Z AS (SELECT *, CASE WHEN pre = 'update' AND len(addp) = 0 AND len(remp) = 0
                          AND NOT ({" OR ".join(f"v_{f} IS NOT NULL" for f in self.checked)}) THEN '' ELSE pre END AS action
      FROM Y),
R AS (SELECT *, {", ".join(f"coalesce(n_{f}, {self.clean(f, 'v_' + f)}) AS r_{f}" for f in _OWNERS)}
      FROM Z WHERE action <> '')"""

    def access_rows(self) -> str:
        owner_ids = ("list_filter(list_transform(list_filter(list_transform(list_concat("
                     + ", ".join(f"string_split_regex(coalesce(r_{f}, ''), '[,;]')" for f in _OWNERS)
                     + "), lambda t: trim(t)), lambda t: t <> ''), lambda t: " + _uid("t") + "), lambda x: x IS NOT NULL)")
        return f"""SELECT title, CAST(item_id AS BIGINT) AS list_id,
       {", ".join((f"r_{f} AS {f}" if f in _OWNERS else f"{self.clean(f, 'v_' + f)} AS {f}") for f in self.fields)},
       action,
       array_to_string(list_sort(list_distinct(list_concat(addp, {owner_ids}, {_ADMINS}))), '; ') AS add_user_ids,
       array_to_string(remp, '; ') AS remove_user_ids,
       array_to_string(addp, '; ') AS ids_with_access
FROM R"""


_LISTS = ListSql(_ALL_FIELDS, floats=("pending_value",), dropdowns=("qc_status",))
CHANGE_CTES, INSPECTION_CTES, TRACKER_CTES = _LISTS.changes(), _LISTS.no_access(), _LISTS.access()
_LIST_VIEWS = ("existing_list", "desired_list")

sql("field_diff", _LIST_VIEWS, f"""
SELECT title, concat_ws(',', {", ".join(f"CASE WHEN ch_{f} THEN '{f}' END" for f in _ALL_FIELDS)}) AS changed_fields,
       CAST({" + ".join(f"CAST(ch_{f} AS INT)" for f in _ALL_FIELDS)} AS BIGINT) AS n_changed
FROM C WHERE in_old AND in_new AND ({" OR ".join(f"ch_{f}" for f in _ALL_FIELDS)})
""", extra=CHANGE_CTES)

sql("change_actions", _LIST_VIEWS, """
SELECT title, CASE WHEN pre = '' THEN 'none' ELSE pre END AS action FROM A
""", extra=CHANGE_CTES)

sql("change_set", _LIST_VIEWS, "SELECT * FROM CS", extra=INSPECTION_CTES)
sql("action_summary", _LIST_VIEWS, "SELECT action, COUNT(*) AS rows FROM CS GROUP BY action", extra=INSPECTION_CTES)

sql("access_delta", _LIST_VIEWS, """
SELECT title, action, array_to_string(addp, '; ') AS add_user_ids, array_to_string(remp, '; ') AS remove_user_ids
FROM Z WHERE action <> ''
""", extra=TRACKER_CTES)

sql("access_final", _LIST_VIEWS, _LISTS.access_rows(), extra=TRACKER_CTES)


# --- warehouse views ------------------------------------------------------------
sql("document_projection", (), """
SELECT event_id, event_type, TRY_CAST(props ->> '$.k' AS INTEGER) AS k, props ->> '$.k' AS k_text,
       TRY_CAST(props ->> '$.K' AS INTEGER) AS k_upper, props ->> '$.missing' AS missing
FROM events
""")

_NUMBER = "CASE WHEN regexp_matches(trim({x}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST(trim({x}) AS {t}) END"


def _field_sql(kind, x: str) -> str:
    if kind == "date":
        return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"
    if kind in ("whole", "float"):
        return _NUMBER.format(x=x, t="DECIMAL(18,0)" if kind == "whole" else "DOUBLE")
    return f"substr({x}, 1, {kind})"


_PATHS = ", ".join("'$.\"" + key + "\"'" for key, _, _ in LINE_FIELDS)
sql("line_projection", ("line_documents",), f"""
SELECT line_key AS document_key, ord, {", ".join(f"{_field_sql(kind, f'f[{at}]')} AS {name}" for at, (_, kind, name) in enumerate(LINE_FIELDS, 1))}
FROM (SELECT line_key, ord, json_extract_string(rdata, [{_PATHS}]) AS f FROM line_documents
      QUALIFY dense_rank() OVER (ORDER BY snapshot_ts DESC) = 1)
""")

sql("latest_snapshot", ("order_line_snapshots",), """
SELECT document_number, ord, line_key, snapshot_ts FROM order_line_snapshots
QUALIFY dense_rank() OVER (ORDER BY snapshot_ts DESC) = 1
""")

sql("batch_planned_date", ("planned_pickup",), """
SELECT DISTINCT batch_id, batch_spd AS spd FROM planned_pickup WHERE batch_spd IS NOT NULL
""")

sql("line_attributes", ("line_attributes",), """
SELECT DISTINCT document_number || item || line_id AS rollup_id, currency, deliver_to_location
FROM line_attributes
WHERE CAST(try_strptime(date_created, '%d.%m.%Y %H:%M') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-15'
""")

BATCH_TELEX = """batch_telex AS (
  SELECT split_part(shipment_batch_id_pl_id, '#', 1) AS batch_id,
         MAX(CAST(try_strptime(created_date, '%Y.%m.%d') AS DATE)) AS batch_telex_date
  FROM packing_log WHERE telex_status = 'uploaded' GROUP BY 1
)"""

sql("batch_release_date", ("packing_log",), "SELECT batch_id, batch_telex_date FROM batch_telex", extra=BATCH_TELEX)

sql("invoice_list", ("invoice_map",), """
SELECT po_line_unique_key, listagg(document_number, ', ' ORDER BY document_number) AS invoice_numbers
FROM invoice_map GROUP BY po_line_unique_key
""")

_STRP = {"dd.MM.yyyy": "%d.%m.%Y", "yyyy-MM-dd": "%Y-%m-%d"}
SHIP_DATES = BATCH_TELEX + """,
released AS (
  SELECT l.shipment_number, MAX(t.batch_telex_date) AS day
  FROM batch_telex t JOIN batch_lines b USING (batch_id) JOIN shipment_lines l ON l.po_line_unique_key = b.po_line_key
  GROUP BY ALL
),
ship_dates AS (
  SELECT shipment_number, MAX(r.day) AS telex_release_date_supplier,
         """ + ", ".join(f"MAX(CAST(try_strptime({c}, '{_STRP[fmt]}') AS DATE)) AS {c}" for c, fmt in SHIPMENT_DATES) + """
  FROM shipment_header LEFT JOIN released r USING (shipment_number)
  WHERE shipment_number IN (SELECT shipment_number FROM shipment_lines)
  GROUP BY ALL
)"""
_SHIP = ("shipment_header", "shipment_lines", "batch_lines", "packing_log")

sql("shipment_dates", _SHIP, "SELECT * FROM ship_dates", extra=SHIP_DATES)

SHIP_OVERVIEW = SHIP_DATES + """,
ship_overview AS (
  SELECT h.shipment_number AS inb, h.container AS container_number, d.telex_release_date_supplier,
         d.telex_release_date AS telex_release_date_ffwp, d.actual_arrival_date, d.actual_cargo_pick_up_date AS actual_cargo_pickup_date,
         d.actual_shipping_date, d.actual_cargo_pick_up_date AS actual_pickup_date, d.gate_in, d.expected_shipping_date,
         d.expected_arrival_date, d.actual_delivery_date, d.cargo_ready_date, d.inb_receiving_date, h.shipment_method,
         h.port_of_departure, h.port_of_arrival, h.ff_remarks, h.expected_delivery_date, h.customs_clearance_date, h.forwarder AS ffw
  FROM shipment_header h LEFT JOIN ship_dates d ON h.shipment_number = d.shipment_number
)"""

sql("shipment_overview", _SHIP, "SELECT * FROM ship_overview", extra=SHIP_OVERVIEW)

sql("open_confirmed", ("confirmations", "po_line_snapshots"), """
SELECT DISTINCT c.po_number || c.item || c.line_id AS order_line_id, c.confirmation_date
FROM confirmations c SEMI JOIN undelivered u ON u.document_number = c.po_number AND u.line_id = c.line_id
WHERE coalesce(c.memo, '') <> 'internal_flow' AND c.final_status NOT IN ('Closed', 'Legacy Closed', 'Fully Billed')
""", extra="""newest AS (
  SELECT document_number, line_id, MAX(snapshot_ts) AS at FROM po_line_snapshots GROUP BY ALL
),
undelivered AS (
  SELECT DISTINCT s.document_number, s.line_id FROM po_line_snapshots s JOIN newest USING (document_number, line_id)
  WHERE s.snapshot_ts = newest.at AND s.quantity > s.received
)""")



# --- enrichment and roll-up --------------------------------------------------------
_ENRICH_NEEDS = ("order_lines", "line_attributes", "shipment_header", "shipment_lines", "batch_lines", "packing_log",
                 "planned_pickup")

sql("line_enriched", _ENRICH_NEEDS, """
SELECT t.document_number, t.ord, t.line_key, t.tracker, a.deliver_to_location, s.container_number,
       s.actual_arrival_date, s.actual_shipping_date, s.actual_pickup_date, s.gate_in, s.expected_shipping_date, s.actual_delivery_date,
       s.ffw, s.telex_release_date_supplier, s.telex_release_date_ffwp, s.expected_arrival_date, s.expected_delivery_date, p.spd
FROM labelled t
LEFT JOIN (SELECT rollup_id, deliver_to_location FROM (
             SELECT *, row_number() OVER (PARTITION BY rollup_id ORDER BY deliver_to_location, currency) AS rn
             FROM (SELECT DISTINCT document_number || item || line_id AS rollup_id, currency, deliver_to_location
                   FROM line_attributes
                   WHERE CAST(try_strptime(date_created, '%d.%m.%Y %H:%M') AS DATE)
                         BETWEEN DATE '1996-01-01' AND DATE '1998-06-15') x) y WHERE rn = 1) a
  ON t.line_key = a.rollup_id
LEFT JOIN ship_overview s ON t.inb = s.inb
LEFT JOIN (SELECT DISTINCT batch_id, batch_spd AS spd FROM planned_pickup WHERE batch_spd IS NOT NULL) p
  ON t.batch_id = p.batch_id
WHERE t.tracker <> ''
""", extra=LABELLED + ",\n" + SHIP_OVERVIEW)

ROLLUP_CTES = LABELLED + """,
TF AS (SELECT *, regexp_matches(tracker, 'G4|TLX|BP|SPD') AS bs, regexp_matches(tracker, 'PP') AS ds
       FROM labelled WHERE tracker <> ''),
CNT AS (SELECT document_number, COUNT(line_key) AS line_count FROM TF GROUP BY document_number),
FC AS (SELECT TF.*, CNT.line_count FROM TF LEFT JOIN CNT ON TF.document_number = CNT.document_number),
BL AS (SELECT batch_id, batch_id || ' - ' || array_to_string(list_sort(list_distinct(list(coalesce(document_number, 'nan')))), ',')
                 || ' - ' || coalesce(CAST(MAX(line_count) AS VARCHAR), 'nan') AS batch_label
       FROM FC WHERE bs AND batch_id IS NOT NULL GROUP BY batch_id),
DL AS (SELECT document_number, document_number || ' - ' || CAST(MAX(line_count) AS VARCHAR) AS doc_label
       FROM FC WHERE ds AND document_number IS NOT NULL GROUP BY document_number),
RL AS (SELECT FC.*, coalesce(BL.batch_label, DL.doc_label, FC.line_key) AS id_col
       FROM FC LEFT JOIN BL ON FC.batch_id = BL.batch_id LEFT JOIN DL ON FC.document_number = DL.document_number)"""

sql("rollup_labels", ("order_lines",), "SELECT document_number, ord, line_key, id_col FROM RL", extra=ROLLUP_CTES)


def _set(c: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list(coalesce(CAST({c} AS VARCHAR), 'nan')))), ',')"


def _collapse_sql(group: str, where: str) -> str:
    doc = "document_number" if group == "document_number" else _set("document_number")
    batch = "CAST(NULL AS VARCHAR)" if group == "document_number" else "batch_id"
    return f"""
SELECT first(id_col ORDER BY document_number, ord) FILTER (WHERE id_col IS NOT NULL) AS rollup_id,
       {_set('line_key')} AS order_line_id, {batch} AS batch_id, {doc} AS document_number,
       first(tracker ORDER BY document_number, ord) FILTER (WHERE tracker IS NOT NULL) AS tracker,
       string_agg(coalesce(item, 'nan'), ',' ORDER BY document_number, ord) AS item,
       CAST(coalesce(SUM(quantity), 0) AS BIGINT) AS quantity,
       round(coalesce(SUM(pending_value), 0), 2) AS pending_value,
       {_set('current_status')} AS current_status, {_set('sub_status')} AS sub_status
FROM RL WHERE {where} AND {group} IS NOT NULL GROUP BY {group}"""


COLLAPSE_CTES = ROLLUP_CTES + f""",
CB AS ({_collapse_sql('batch_id', 'bs')}),
CD AS ({_collapse_sql('document_number', 'ds')})"""

sql("rollup_batch", ("order_lines",), "SELECT * FROM CB", extra=COLLAPSE_CTES)
sql("rollup_document", ("order_lines",), "SELECT * FROM CD", extra=COLLAPSE_CTES)
sql("rollup_dropped", ("order_lines",),
    "SELECT COUNT(*) AS dropped_lines FROM TF WHERE bs AND batch_id IS NULL AND NOT ds", extra=ROLLUP_CTES)
sql("rollup_all", ("order_lines",), """
SELECT rollup_id, split_part(order_line_id, ',', 1) AS order_line_id, batch_id, document_number, tracker, item, quantity,
       pending_value, current_status, sub_status
FROM (SELECT line_key AS rollup_id, line_key AS order_line_id, batch_id, document_number, tracker, item, quantity,
             round(pending_value, 2) AS pending_value, current_status, sub_status
      FROM RL WHERE NOT (bs OR ds)
      UNION ALL SELECT * FROM CB
      UNION ALL SELECT * FROM CD) u
""", extra=COLLAPSE_CTES)


def _wide_rollup() -> tuple[str, str]:
    """All fields of the documents, rolled up by batch, by document, and untouched: tables and query."""
    fields = [name for _, _, name in LINE_FIELDS if name not in ("document_number", "batch_id", "order_line_id")]
    sums = [c for c in fields if c in ("quantity", "quantity_received", "quantity_on_shipments", "pending_units", "pending_value",
                                       "per_unit_amount", "internal_id", "line_id")]
    lists = [c for c in fields if c in ("item", "asin_number", "market_place")]
    sets = [c for c in fields if c not in sums + lists]
    in_order = "ORDER BY document_number, ord"

    def grouped(by: str, flag: str) -> str:
        doc, batch = (by, "NULL") if by == "document_number" else (_set("document_number"), by)
        values = [f"CAST(coalesce(SUM({c}), 0) AS DOUBLE) AS {c}" for c in sums]
        values += [f"string_agg(coalesce({c}, 'nan'), ',' {in_order}) AS {c}" for c in lists] + [f"{_set(c)} AS {c}" for c in sets]
        return f"""
SELECT first(id_col {in_order}) FILTER (WHERE id_col IS NOT NULL) AS rollup_id, split_part(MIN(line_key), ',', 1) AS order_line_id,
       {batch} AS batch_id, {doc} AS document_number, first(tracker {in_order}) FILTER (WHERE tracker IS NOT NULL) AS tracker,
       {", ".join(values)}
FROM WIDE WHERE {flag} AND {by} IS NOT NULL GROUP BY {by}"""

    own = [f"CAST({c} AS DOUBLE) AS {c}" for c in sums] + [f"CAST({c} AS VARCHAR) AS {c}" for c in lists + sets]
    tables = f"""
FIELDS AS ({ORACLE["line_projection"]}),
WIDE AS MATERIALIZED (SELECT RL.document_number, RL.ord, RL.line_key, RL.batch_id, RL.tracker, RL.bs, RL.ds, RL.id_col,
                             {", ".join(f"FIELDS.{c}" for c in fields)}
                      FROM RL JOIN FIELDS ON RL.line_key = FIELDS.document_key AND RL.ord = FIELDS.ord)"""
    return tables, f"""
SELECT line_key AS rollup_id, split_part(line_key, ',', 1) AS order_line_id, batch_id, document_number, tracker, {", ".join(own)}
FROM WIDE WHERE NOT (bs OR ds)
UNION ALL {grouped("batch_id", "bs")}
UNION ALL {grouped("document_number", "ds")}"""


_WIDE_TABLES, _WIDE_QUERY = _wide_rollup()
sql("rollup_wide", ("order_lines",), _WIDE_QUERY, extra=ROLLUP_CTES + "," + _WIDE_TABLES)


# Roll-up rows by id: every line once per row that it belongs to, and per id once.
_MEMBERS = """
DR AS (SELECT document_number AS dr_doc, first(id_col ORDER BY document_number, ord) AS dr_id FROM RL
       WHERE ds AND document_number IS NOT NULL GROUP BY document_number),
M AS (
  SELECT 'batch' AS scope, batch_id AS grp, id_col AS rid, batch_id AS b, RL.* FROM RL WHERE bs AND batch_id IS NOT NULL
  UNION ALL SELECT 'document', document_number, dr_id, NULL, RL.* FROM RL JOIN DR ON document_number = dr_doc WHERE ds
  UNION ALL SELECT 'line', line_key, line_key, batch_id, RL.* FROM RL WHERE NOT (bs OR ds)),
ROWS_OF AS (SELECT rid, scope, CASE WHEN scope = 'line' THEN line_key || '#' || document_number || '#' || ord ELSE grp END AS one,
                   COUNT(*) AS n FROM M GROUP BY ALL),
COLLIDE AS (SELECT rid AS rollup_id, CAST(COUNT(*) AS BIGINT) AS rows, array_to_string(list_sort(list_distinct(list(scope))), ',') AS scopes,
                   CAST(SUM(n) AS BIGINT) AS lines
            FROM ROWS_OF GROUP BY rid HAVING COUNT(*) > 1),
ONCE AS (SELECT * FROM M QUALIFY row_number() OVER (PARTITION BY rid, document_number, ord, line_key, item
                                                    ORDER BY scope) = 1),
MERGED AS (
  SELECT rid AS rollup_id, split_part(""" + _set("line_key") + """, ',', 1) AS order_line_id,
         first(b ORDER BY document_number, ord) FILTER (WHERE b IS NOT NULL) AS batch_id, """ + _set("document_number") + """ AS document_number,
         first(tracker ORDER BY document_number, ord) FILTER (WHERE tracker IS NOT NULL) AS tracker,
         string_agg(coalesce(item, 'nan'), ',' ORDER BY document_number, ord) AS item,
         CAST(coalesce(SUM(quantity), 0) AS BIGINT) AS quantity, round(coalesce(SUM(pending_value), 0), 2) AS pending_value,
         """ + ", ".join(f"{_set(c)} AS {c}" for c in ("current_status", "sub_status", "final_poc", "sm")) + """
  FROM ONCE GROUP BY rid)"""


def _merged(source: str) -> str:
    return _labelled(source) + ROLLUP_CTES[len(LABELLED):] + "," + _MEMBERS


def _nested(source: str, body: str) -> str:
    """One roll-up as a subquery, so that two of them do not share names."""
    return f"(WITH {_merged(source)} {body})"


sql("rollup_collisions", ("order_lines",), "SELECT * FROM COLLIDE", extra=_merged("order_lines"))
sql("rollup_merged", ("order_lines",), "SELECT * FROM MERGED", extra=_merged("order_lines"))

_ROLLUP_LIST = ListSql(("order_line_id", "batch_id", "document_number", "tracker", "item", "quantity", "pending_value", "current_status",
                        "sub_status", "final_poc", "sm"), floats=("pending_value",), numbers=("quantity",), unchecked=("order_line_id",),
                       old="held", new="wanted")
SYNC_CTES = f"""wanted AS MATERIALIZED {_nested("order_lines", "SELECT rollup_id AS title, * EXCLUDE (rollup_id) FROM MERGED")},
held AS MATERIALIZED (
  SELECT *, CASE list_id % 3 WHEN 0 THEN '101; 103' WHEN 1 THEN '102,104' END AS ids_with_access
  FROM (SELECT *, CAST('0x' || substr(md5(title), 1, 12) AS BIGINT) AS list_id
        FROM {_nested("previous_lines", "SELECT rollup_id AS title, * EXCLUDE (rollup_id) FROM MERGED")} p) q),"""
# --- inspection flow ---------------------------------------------------------------
_NORM = ("CASE WHEN line_id_raw IS NULL THEN 'nan' WHEN line_id_raw = '' THEN '0' "
         "ELSE regexp_replace(line_id_raw, '\\.0$', '') END")
_NEAR = "date_diff('day', DATE '1998-06-15', prd)"
_INTID = "coalesce(CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS BIGINT), 0)"

INSPECTION_BASE = f"""
IL AS (SELECT * REPLACE ({_NORM} AS line_id), split_part(name, ' ', 1) AS vendor_id,
              document_number || item || {_NORM} AS order_line_id
       FROM order_lines),
ES AS (SELECT order_line_id, CAST(MIN(prd) - INTERVAL 10 DAY AS DATE) AS email_scheduled_for
       FROM IL GROUP BY order_line_id
       HAVING bool_or(coalesce({_NEAR} BETWEEN -90 AND 90, false)) AND MIN(prd) IS NOT NULL),
SL AS (SELECT x.* EXCLUDE (rn), ES.email_scheduled_for
       FROM (SELECT *, row_number() OVER (PARTITION BY order_line_id ORDER BY ord) AS rn
             FROM IL WHERE order_line_id IN (SELECT order_line_id FROM ES)) x
       JOIN ES ON x.order_line_id = ES.order_line_id WHERE rn = 1),
V1 AS (SELECT vid, name AS vendor_table_name, email AS vendor_email, cm_email, sm_email
       FROM (SELECT *, {_INTID.format(x='id')} AS vid,
                    row_number() OVER (PARTITION BY {_INTID.format(x='id')} ORDER BY email, name) AS rn
             FROM vendors) v WHERE rn = 1),
SLV AS (SELECT SL.*, {_INTID.format(x='SL.vendor_id')} AS vendor_id_num, V1.vendor_table_name, V1.vendor_email, V1.cm_email, V1.sm_email
        FROM SL LEFT JOIN V1 ON {_INTID.format(x='SL.vendor_id')} = V1.vid)"""

sql("email_schedule", ("order_lines",), "SELECT * FROM ES", extra=INSPECTION_BASE.split(",\nSL AS")[0])

sql("vendor_join", ("order_lines", "vendors"), """
SELECT order_line_id, vendor_id_num AS vendor_id,
       CASE WHEN strpos(name, ' ') > 0 THEN substr(name, strpos(name, ' ') + 1) END AS vendor_name, vendor_email
FROM SLV
""", extra=INSPECTION_BASE)

sql("sent_flag", ("order_lines", "sent_ledger"), """
SELECT order_line_id,
       CASE WHEN order_line_id IN (SELECT line_key FROM sent_ledger WHERE line_key IS NOT NULL) THEN 'Yes' ELSE 'No' END
         AS sent_already
FROM ES
""", extra=INSPECTION_BASE.split(",\nSL AS")[0])

_INSPECTION_ROWS = """
SELECT order_line_id, batch_id, document_number,
       CASE WHEN order_line_id IN (SELECT line_key FROM sent_ledger WHERE line_key IS NOT NULL) THEN 'Yes' ELSE 'No' END
         AS sent_already,
       strftime(email_scheduled_for, '%Y-%m-%d') AS email_scheduled_for, '' AS send_early,
       strftime(prd, '%Y-%m-%d') AS prd, item AS item_key, line_id, brand,
       CAST(vendor_id_num AS VARCHAR) AS vendor_id,
       CASE WHEN strpos(name, ' ') > 0 THEN substr(name, strpos(name, ' ') + 1) END AS vendor_name,
       vendor_email, cm_email, sm_email, '' AS list_id, compliance_status,
       regexp_replace(qc_status, '^\\d+\\s*\\|?\\s*', '') AS quality_control_status,
       strftime(qc_date, '%Y-%m-%d') AS quality_control_date,
       current_status, sub_status, days_bucket, final_team, final_poc, cm, sm, '' AS name,
       CASE WHEN sub_status IN ('17. QC Schedule Pending', '20a. QC Release Missing') THEN 'otif' ELSE '' END AS subset,
       order_line_id || CAST(vendor_id_num AS VARCHAR) AS key
FROM SLV"""
sql("inspection_list", ("order_lines", "vendors", "sent_ledger"), _INSPECTION_ROWS, extra=INSPECTION_BASE)


def _checks(key: str, src: str, where: str = "TRUE") -> str:
    return f"""SELECT {key} FROM {src} WHERE {where} GROUP BY {key}
       HAVING bool_or(coalesce(im_signoff = 'Yes', false))
          AND bool_or(coalesce({_NEAR} BETWEEN 0 AND 10, false))
          AND bool_and(coalesce(contains(lower(qc_status), 'awaiting release'), false))
          AND bool_and(qc_date IS NULL)"""


_SQ = "\\{.*?'Value'\\s*:\\s*'([^']*)'\\s*[,}]"
_DQ = '\\{.*?"Value"\\s*:\\s*"([^"]*)"\\s*[,}]'
_EARLY = (f"CASE WHEN regexp_matches(send_early, '^\\s*{_SQ.replace(chr(39), chr(39) * 2)}') "
          f"THEN regexp_extract(send_early, '^\\s*{_SQ.replace(chr(39), chr(39) * 2)}', 1) "
          f"WHEN regexp_matches(send_early, '^\\s*{_DQ.replace(chr(39), chr(39) * 2)}') "
          f"THEN regexp_extract(send_early, '^\\s*{_DQ.replace(chr(39), chr(39) * 2)}', 1) ELSE send_early END")

BOOKING_CTES = INSPECTION_BASE.split(",\nES AS")[0] + f""",
BASE AS (SELECT * FROM IL b
         WHERE NOT EXISTS (SELECT 1 FROM deny_list d WHERE d.document_number = b.document_number)
           AND NOT coalesce(contains(lower(qc_status), 'not applicable'), false)),
CHK AS ({_checks('order_line_id', 'BASE')}),
EARLY AS (SELECT title FROM qi_list WHERE {_EARLY} = 'Yes'),
ELIG AS (SELECT order_line_id, document_number, item, line_id, vendor_id, brand, DATE '1998-06-15' AS date_sent,
                'No' AS resend
         FROM BASE WHERE order_line_id IN (SELECT order_line_id FROM CHK UNION SELECT title FROM EARLY)),
SUB AS (SELECT * FROM BASE WHERE document_number IN (SELECT document_number FROM sent_ledger WHERE resend = 'No')),
RDOCS AS ({_checks('document_number', 'SUB', 'prd IS DISTINCT FROM first_prd')}),
RES AS (SELECT order_line_id, document_number, item, line_id, vendor_id, brand, DATE '1998-06-15' AS date_sent,
               'Yes' AS resend
        FROM SUB WHERE document_number IN (SELECT document_number FROM RDOCS)),
NEWL AS (SELECT * FROM (SELECT * FROM ELIG UNION ALL SELECT * FROM RES) c
         WHERE NOT EXISTS (SELECT 1 FROM sent_ledger l
                           WHERE concat_ws('|', coalesce(l.document_number, 'nan'), coalesce(l.item, 'nan'),
                                           coalesce(l.line_id, 'nan'), coalesce(l.resend, 'nan'))
                               = concat_ws('|', coalesce(c.document_number, 'nan'), coalesce(c.item, 'nan'),
                                           coalesce(c.line_id, 'nan'), coalesce(c.resend, 'nan'))))"""
_BOOK = ("order_lines", "deny_list", "qi_list", "sent_ledger")

sql("booking_eligible", _BOOK, "SELECT * FROM ELIG", extra=BOOKING_CTES)
sql("resend_lines", _BOOK, "SELECT * FROM RES", extra=BOOKING_CTES)
sql("new_booking_lines", _BOOK, "SELECT * FROM NEWL", extra=BOOKING_CTES)
sql("booking_forms", _BOOK,
    "SELECT DISTINCT document_number, item, concat_ws(' - ', document_number, item) AS sheet FROM NEWL",
    extra=BOOKING_CTES)
sql("ledger_next", _BOOK, """
SELECT line_key AS order_line_id, document_number, item, line_id, CAST(try_strptime(date_sent, '%Y-%m-%d') AS DATE) AS date_sent,
       resend FROM sent_ledger
UNION ALL
SELECT order_line_id, document_number, item, line_id, date_sent, resend FROM NEWL
""", extra=BOOKING_CTES)

_V1 = "V1 AS (" + INSPECTION_BASE.split("V1 AS (")[1].split(",\nSLV AS")[0]
_LOG = f"""
SELECT f.document_number, '/inspection/attachments/' || f.document_number || '_QI_Booking_Form.xlsx' AS directory,
       {_INTID.format(x='f.vendor_id')} AS vendor_id, f.brand, V1.vendor_table_name AS vendor_name, V1.vendor_email,
       V1.cm_email, V1.sm_email
FROM (SELECT *, row_number() OVER (PARTITION BY document_number
                                   ORDER BY CAST(resend = 'Yes' AS INT),
                                            CASE WHEN resend = 'Yes' THEN document_number ELSE order_line_id END,
                                            CASE WHEN resend = 'Yes' THEN line_id ELSE '' END,
                                            order_line_id, item, line_id, vendor_id, brand) AS rn
      FROM NEWL) f
LEFT JOIN V1 ON {_INTID.format(x='f.vendor_id')} = V1.vid
WHERE rn = 1
"""
sql("booking_log", _BOOK + ("vendors",), _LOG, extra=BOOKING_CTES + ",\n" + _V1)


# --- outbox ---------------------------------------------------------------------------
def _pl_part(c: str, numbers) -> str:
    if c in numbers:
        return (f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) "
                f"THEN '\"{c}\":' || to_json(left(CAST({c} AS VARCHAR), 2000)) END")
    s = _strip(c)
    return (f"CASE WHEN NOT ({c} IS NULL OR lower({s}) IN ('', 'nan', 'none', 'null')) "
            f"AND NOT (starts_with({s}, '{{') AND ends_with({s}, '}}')) "
            f"THEN '\"{c}\":' || to_json(left({s}, 2000)) END")


def _payload(fields, numbers, around=("title", "ids_with_access")) -> str:
    columns = (*around[:1], *fields, *around[1:])
    return "'{' || concat_ws(',', " + ", ".join(_pl_part(c, numbers) for c in columns) + ") || '}'"


_IDS = "list_filter(list_transform(string_split(coalesce({c}, ''), ';'), lambda t: trim(t)), lambda t: t <> '')"
_REQ_T = "STRUCT(kind VARCHAR, principal VARCHAR, payload VARCHAR)"


def _access_reqs(g: str, r: str) -> str:
    return (f"list_concat(CASE WHEN len({g}) > 0 THEN [{{'kind': 'break_inheritance', 'principal': NULL, 'payload': NULL}}::{_REQ_T}]"
            f" ELSE CAST([] AS {_REQ_T}[]) END, "
            f"list_transform({g}, lambda u: {{'kind': 'grant', 'principal': u, 'payload': NULL}}::{_REQ_T}), "
            f"list_transform({r}, lambda u: {{'kind': 'revoke', 'principal': u, 'payload': NULL}}::{_REQ_T}))")


def _outbox(lists: ListSql) -> str:
    return lists.access() + f""",
AF AS ({lists.access_rows()}),
OB AS (SELECT title,
              CASE WHEN list_id IS NULL THEN '' ELSE trim(CAST(list_id AS VARCHAR)) END AS item_id,
              lower(trim(action)) AS action,
              {_IDS.format(c='add_user_ids')} AS grants, {_IDS.format(c='remove_user_ids')} AS revokes,
              {_payload(lists.fields, lists.numbers)} AS payload,
              row_number() OVER (ORDER BY CAST(action = 'delete' AS INT), title) AS row_no
       FROM AF),
RQ AS (SELECT *, (row_no - 1) // 30 AS chunk_no FROM OB)"""


OUTBOX_CTES = _outbox(_LISTS)

sql("outbox_payload", ("existing_list", "desired_list"), "SELECT title, action, payload FROM OB", extra=OUTBOX_CTES)

_REQUESTS = f"""
SELECT batch_no, chunk_no, row_no, CAST(i - 1 AS BIGINT) AS seq, reqs[i].kind AS kind, title, item_id,
       reqs[i].principal AS principal, reqs[i].payload AS payload
FROM (SELECT chunk_no * 3 + CASE WHEN action = 'add' THEN 0 ELSE 2 END + 1 AS batch_no, chunk_no, row_no, title,
             item_id,
             CASE WHEN action = 'add' THEN [{{'kind': 'create', 'principal': NULL, 'payload': payload}}::{_REQ_T}]
                  WHEN action = 'update' AND item_id <> ''
                    THEN list_concat([{{'kind': 'update', 'principal': NULL, 'payload': payload}}::{_REQ_T}],
                                     {_access_reqs('grants', 'revokes')})
                  WHEN action = 'delete' AND item_id <> ''
                    THEN [{{'kind': 'delete', 'principal': NULL, 'payload': NULL}}::{_REQ_T}]
                  ELSE CAST([] AS {_REQ_T}[]) END AS reqs
      FROM RQ) q, unnest(range(1, len(reqs) + 1)) AS t(i)"""
sql("outbox_requests", ("existing_list", "desired_list"), _REQUESTS, extra=OUTBOX_CTES)

sql("outbox_summary", ("existing_list", "desired_list"), """
SELECT chunk_no * 3 + CASE WHEN action = 'add' THEN 0 ELSE 2 END + 1 AS batch_no,
       COUNT(*) AS rows_read,
       COUNT(*) FILTER (WHERE action = 'add' OR item_id <> '') AS rows_processed,
       CAST(SUM(CASE WHEN action = 'add' THEN 1 WHEN item_id = '' THEN 0 WHEN action = 'delete' THEN 1
                     ELSE 1 + CASE WHEN len(grants) > 0 THEN 1 + len(grants) ELSE 0 END + len(revokes) END) AS BIGINT)
         AS requests
FROM RQ WHERE action IN ('add', 'update', 'delete')
GROUP BY 1
""", extra=OUTBOX_CTES)

sql("permission_requests", ("existing_list", "desired_list"), f"""
SELECT chunk_no * 3 + 2 AS batch_no, chunk_no, row_no, CAST(i - 1 AS BIGINT) AS seq, reqs[i].kind AS kind, title,
       item_id, reqs[i].principal AS principal
FROM (SELECT p.chunk_no, p.row_no, p.title, p.new_item_id AS item_id, {_access_reqs('p.grants', 'p.revokes')} AS reqs
      FROM PR p) q, unnest(range(1, len(reqs) + 1)) AS t(i)
""", extra=OUTBOX_CTES + """,
NEED AS (SELECT *, row_number() OVER (PARTITION BY chunk_no ORDER BY row_no) AS position
         FROM RQ WHERE action = 'add' AND (len(grants) > 0 OR len(revokes) > 0)),
LASTP AS (SELECT chunk_no, MAX(position) AS last_pos FROM NEED GROUP BY chunk_no),
RET AS (SELECT n.chunk_no, n.position, 1000000 + n.row_no AS item_id
        FROM NEED n JOIN LASTP l ON n.chunk_no = l.chunk_no
        WHERE NOT (n.chunk_no % 4 = 3 AND n.position = l.last_pos)),
OKC AS (SELECT a.chunk_no FROM (SELECT chunk_no, COUNT(*) AS c FROM NEED GROUP BY chunk_no) a
        JOIN (SELECT chunk_no, COUNT(*) AS c FROM RET GROUP BY chunk_no) b ON a.chunk_no = b.chunk_no WHERE a.c = b.c),
PR AS (SELECT n.*, CAST(r.item_id AS VARCHAR) AS new_item_id
       FROM NEED n JOIN RET r ON n.chunk_no = r.chunk_no AND n.position = r.position
       WHERE n.chunk_no IN (SELECT chunk_no FROM OKC))""")


# --- end-to-end jobs ----------------------------------------------------------------------
_SYNC = ("order_lines", "previous_lines")
_SYNC_OUT = SYNC_CTES + _outbox(_ROLLUP_LIST)
sql("tracked_sync", _SYNC, _REQUESTS, extra=_SYNC_OUT)
sql("tracked_sync_changes", _SYNC, "SELECT * FROM AF", extra=_SYNC_OUT)
sql("tracked_sync_report", _SYNC, f"""
SELECT 'change_set' AS output, action AS detail, COUNT(*) AS rows FROM AF GROUP BY action
UNION ALL SELECT 'requests', kind, COUNT(*) FROM ({_REQUESTS}) r GROUP BY kind
UNION ALL SELECT 'batches', '', COUNT(DISTINCT chunk_no * 3 + CASE WHEN action = 'add' THEN 0 ELSE 2 END) FROM RQ
UNION ALL SELECT 'collisions', '', COUNT(*) FROM {_nested("order_lines", "SELECT * FROM COLLIDE")} c
UNION ALL SELECT 'dropped', '', COUNT(*) FROM {_nested("order_lines", "SELECT * FROM TF WHERE bs AND batch_id IS NULL AND NOT ds")} d
""", extra=_SYNC_OUT)

_INSPECTION_WIDE = ListSql(("qi_result", "qi_date", "prd", "batch_id", "item_key", "line_id", "brand", "compliance_status", "vendor_id",
                            "vendor_name", "current_status", "sub_status", "days_bucket", "final_team", "final_poc", "cm", "sm", "name",
                            "document_number", "item", "subset", "sent_already", "email_scheduled_for", "vendor_email", "sm_email"),
                           dropdowns=("qi_result",), old="held_inspections", new="wanted")
_QI = ("order_lines", "vendors", "sent_ledger", "deny_list", "held_inspections")
# The list calls two columns by other names, and no inspection column is called item.
_QI_OUT = INSPECTION_BASE.strip() + f""",
wanted AS (SELECT order_line_id AS title, quality_control_status AS qi_result, quality_control_date AS qi_date,
                  CAST(NULL AS VARCHAR) AS item, * EXCLUDE (order_line_id, quality_control_status, quality_control_date)
           FROM ({_INSPECTION_ROWS}) i),""" + _INSPECTION_WIDE.no_access()
_QI_BOOKINGS = ",\nBASE AS" + BOOKING_CTES.split("BASE AS", 1)[1].replace("FROM qi_list", "FROM held_inspections")
sql("inspection_sync", _QI, "SELECT * FROM CS", extra=_QI_OUT)
sql("inspection_sync_report", _QI, f"""
SELECT 'change_set' AS output, action AS detail, COUNT(*) AS rows FROM CS GROUP BY action
UNION ALL SELECT 'new_lines', '', COUNT(*) FROM NEWL
UNION ALL SELECT 'ledger', '', (SELECT COUNT(*) FROM sent_ledger) + (SELECT COUNT(*) FROM NEWL)
UNION ALL SELECT 'log', '', COUNT(*) FROM ({_LOG}) l
UNION ALL SELECT 'forms', '', COUNT(*) FROM (SELECT DISTINCT document_number, item FROM NEWL) f
""", extra=_QI_OUT + _QI_BOOKINGS)


# --- lists of many fields -----------------------------------------------------------------
_KINDS = {f: kind for f, _, kind in TRACKED_MAP}
_LAST = {source: f for f, source, _ in TRACKED_MAP}
_TRACKED_WIDE = ListSql(tuple(f for f in _KINDS if f != "title"), floats=tuple(f for f, k in _KINDS.items() if k == "float"),
                        numbers=tuple(f for f, k in _KINDS.items() if k == "whole"), unchecked=("order_line_id",), old="held_tracked",
                        new="wanted")
_WIDE_IN = "wanted AS (SELECT " + ", ".join(
    f"{'NULL' if s in TRACKED_DANGLING or _LAST[s] != f else s} AS {f}" for f, s, _ in TRACKED_MAP) + " FROM tracked_rows),"


def _names(lists: ListSql) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN in_old AND in_new AND ch_{f} THEN '{f}' END" for f in lists.checked) + ")"


sql("tracked_wide_diff", ("tracked_rows", "held_tracked"), f"""
SELECT title, {_names(_TRACKED_WIDE)} AS changed_fields,
       CAST({" + ".join(f"CAST(ch_{f} AS INT)" for f in _TRACKED_WIDE.checked)} AS BIGINT) AS n_changed
FROM C WHERE in_old AND in_new AND ({" OR ".join(f"ch_{f}" for f in _TRACKED_WIDE.checked)})
""", extra=_WIDE_IN + _TRACKED_WIDE.changes())
sql("tracked_wide_changes", ("tracked_rows", "held_tracked"), f"""
SELECT title, list_id, action, {_names(_TRACKED_WIDE)} AS changed_fields,
       {_payload(_TRACKED_WIDE.fields, _TRACKED_WIDE.numbers, ())} AS payload, add_user_ids, remove_user_ids, ids_with_access
FROM AF JOIN (SELECT title, in_old, in_new, {", ".join(f"ch_{f}" for f in _TRACKED_WIDE.checked)} FROM A) USING (title)
""", extra=_WIDE_IN + _TRACKED_WIDE.access() + f", AF AS ({_TRACKED_WIDE.access_rows()})")
sql("inspection_wide_changes", _QI, f"""
SELECT title, list_id, action, {_names(_INSPECTION_WIDE)} AS changed_fields,
       {_payload(_INSPECTION_WIDE.fields, (), ())} AS payload, add_user_ids, remove_user_ids, ids_with_access
FROM CS JOIN (SELECT title, in_old, in_new, {", ".join(f"ch_{f}" for f in _INSPECTION_WIDE.checked)} FROM A) USING (title)
""", extra=_QI_OUT)


def _map_rows(name: str, mapping) -> str:
    return ", ".join(f"('{name}', '{m[0]}', '{m[1]}', {at})" for at, m in enumerate(mapping))


def _filled(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS list, col, n FROM (UNPIVOT (SELECT COUNT(COLUMNS('(.*)')) AS '\\1' FROM {source})
  ON COLUMNS(*) INTO NAME col VALUE n)"""


ORACLE["map_report"] = cte_chain(("order_lines", "vendors", "sent_ledger", "tracked_rows")) + f""",
{INSPECTION_BASE.strip()},
maps(list, field, source, pos) AS (VALUES {_map_rows("tracked", TRACKED_MAP)}, {_map_rows("inspection", INSPECTION_MAP)}),
listed AS ({_INSPECTION_ROWS}),
cols AS ({_filled("tracked", "tracked_rows")} UNION ALL {_filled("inspection", "listed")}),
claims AS (SELECT *, max(pos) OVER (PARTITION BY list, source) AS last FROM maps)
SELECT m.list, m.field, m.source, pos < last AS overridden, own.n IS NULL AS dangling,
       coalesce(CASE WHEN pos = last THEN own.n END,
                CASE WHEN NOT EXISTS (SELECT 1 FROM claims c WHERE c.list = m.list AND c.source = m.field AND c.pos = c.last AND c.field <> m.field)
                     THEN same.n END, 0) AS filled
FROM claims m
LEFT JOIN cols own ON own.list = m.list AND own.col = m.source
LEFT JOIN cols same ON same.list = m.list AND same.col = m.field"""

sql("delivery_outcomes", ("delivery_results",), """
SELECT batch_no, COUNT(*) AS attempts, COUNT(*) FILTER (success AND NOT late) AS successful, COUNT(*) FILTER (late) AS timed_out,
       COUNT(*) FILTER (NOT success AND NOT late) AS failed, COUNT(*) FILTER (success IS NULL AND NOT late) AS unanswered,
       bool_or(coalesce(success, false) OR late) AS delivered, arg_max(rows_read, attempt) AS rows_read,
       arg_max(rows_processed, attempt) AS rows_processed
FROM (SELECT *, coalesce(status = 'timeout', false) AS late FROM delivery_results) r GROUP BY batch_no
""")
