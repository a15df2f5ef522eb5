"""Query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Each entry registers the stand-in input views for ``sf_dir`` and runs one
operator (or a chain ending in it) over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podelta.config import (INSPECTION_LIST, INSPECTION_SUBSET_LABEL, INSPECTION_SUBSET_STATUSES, INSPECTION_MAP, INSPECTION_WIDE, LINE_FIELDS, LINE_SHIPMENT_COLUMNS,
                            ROLLUP_LIST, ROLLUP_LISTS, ROLLUP_SUMS, TRACKED_MAP, TRACKED_WIDE, TRACKER_LIST)
from podelta.functions import exprs as X
from podelta.operators import changeset, inspection, lookups, outbox, rollup, rules, views, widelist
from podelta.plans import sync
from podelta.sources.fixtures import AS_OF, register_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, needs: tuple[str, ...]):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str, _fn=fn, _needs=needs) -> DataFrame:
            register_fixtures(spark, sf_dir, _needs)
            return _fn(spark)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return wrap


def T(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# --- rules ------------------------------------------------------------------
@query("tracker_labels", ("order_lines",))
def tracker_labels(spark):
    """Tracker labels of every open line; unlabelled lines dropped."""
    lines = T(spark, "order_lines")
    return rules.label_lines(lines).select("document_number", "ord", "line_key", "tracker")


@query("order_lines_tracked", ("order_lines",))
def order_lines_tracked(spark):
    """Labelled lines with zero-filled quantity and the empty note / audit columns."""
    lines = rules.label_lines(T(spark, "order_lines")).select("document_number", "ord", "line_key", "tracker",
                                                             "quantity")
    return rules.tracked_line_frame(lines)


QUANTITIES = ("quantity", "quantity_received", "quantity_on_shipments")


@query("quantities_filled", ("raw_quantities",))
def quantities_filled(spark):
    """The three quantity columns of every line, blank text and NULL as 0."""
    rows = rules.tracked_line_frame(T(spark, "raw_quantities"), QUANTITIES)
    return rows.select("line_key", "ord", *QUANTITIES)


@query("tracker_counts", ("order_lines",))
def tracker_counts(spark):
    """How many open lines sit in each tracker."""
    return rules.tracker_counts(rules.label_lines(T(spark, "order_lines")))


# --- keys, dedupe, alignment -----------------------------------------------


def line_key_columns(df: DataFrame) -> DataFrame:
    """P1, P2, P4, P5, P6 on order lines."""
    line_id = X.normalize_line_id("line_id_raw")
    vendor_id = X.first_token("name")
    return df.select(
        "document_number", "ord",
        vendor_id.alias("vendor_id"),
        X.after_first_token("name").alias("vendor_name"),
        line_id.alias("line_id"),
        X.concat_key("document_number", "item", line_id).alias("order_line_id"),
        X.concat_key("document_number", "item", vendor_id).alias("vendor_line_id"),
        X.membership_label("sub_status", INSPECTION_SUBSET_STATUSES, INSPECTION_SUBSET_LABEL).alias("subset"),
    )


@query("line_keys", ("order_lines",))
def line_keys(spark):
    """Vendor id / name, normalised line id and composite keys of each line."""
    return line_key_columns(T(spark, "order_lines"))


@query("dedupe_first", ("order_lines",))
def dedupe_first(spark):
    """First line (by position in its document) per line key."""
    lines = T(spark, "order_lines").select("line_key", "document_number", "ord", "item", "current_status", "prd")
    return lookups.keep_first(lines, ["line_key"], ["ord"])


ALIGN_MAPPING = (
    ("title", "line_key"), ("current_status", "current_status"), ("sub_status", "sub_status"),
    ("quantity", "quantity"), ("pending_value", "pending_value"), ("qc_status", "qc_status"),
    ("poc_primary", "final_poc"), ("final_poc", "final_poc"), ("sm", "sm"), ("fob_date", "fob date"),
)


@query("align_schema", ("order_lines",))
def align_schema(spark):
    """Order lines renamed / completed to the list's field set (later target wins)."""
    return lookups.align_schema(T(spark, "order_lines"), ALIGN_MAPPING, extra=("list_id",))


# --- change set -------------------------------------------------------------
LISTS = ("existing_list", "desired_list")


@query("field_diff", LISTS)
def field_diff(spark):
    """Checked fields that differ between the list and the desired rows."""
    return changeset.field_diff(T(spark, "existing_list"), T(spark, "desired_list"), INSPECTION_LIST)


@query("change_actions", LISTS)
def change_actions(spark):
    """Add / delete / update per key before empty updates are cancelled."""
    return changeset.change_actions(T(spark, "existing_list"), T(spark, "desired_list"), INSPECTION_LIST)


@query("change_set", LISTS)
def change_set(spark):
    """Full change set, list without item-level access (inspection list)."""
    return changeset.change_set(T(spark, "existing_list"), T(spark, "desired_list"), INSPECTION_LIST)


@query("action_summary", LISTS)
def action_summary(spark):
    """Rows per action of the inspection change set."""
    return changeset.action_summary(
        changeset.change_set(T(spark, "existing_list"), T(spark, "desired_list"), INSPECTION_LIST))


@query("access_delta", LISTS)
def access_delta(spark):
    """Effective grants / revokes per kept row (tracker list, item-level access)."""
    return changeset.access_delta(T(spark, "existing_list"), T(spark, "desired_list"), TRACKER_LIST)


@query("access_final", LISTS)
def access_final(spark):
    """C1 + X4: tracker-list change set with final grants."""
    return changeset.change_set(T(spark, "existing_list"), T(spark, "desired_list"), TRACKER_LIST)


# --- warehouse views ----------------------------------------------------------

ATTRIBUTES_SINCE = "1996-01-01"
EXCLUDED_MEMO = "internal_flow"
EVENT_FIELDS = (("$.k", "int", "k"), ("$.k", "string", "k_text"), ("$.K", "int", "k_upper"),
                ("$.missing", "string", "missing"))


@query("document_projection", ())
def document_projection(spark):
    """Typed, case-sensitive fields read out of the events' JSON documents."""
    ev = spark.table("events")
    return views.document_projection(ev, "props", EVENT_FIELDS, keep=("event_id", "event_type"))


@query("line_projection", ("line_documents",))
def line_projection(spark):
    """The 74 typed fields of every order-line document of the newest snapshot."""
    newest = views.latest_snapshot(T(spark, "line_documents"), "snapshot_ts")
    return views.line_projection(newest, "rdata", LINE_FIELDS, keep=("line_key", "ord")).withColumnRenamed("line_key", "document_key")


@query("latest_snapshot", ("order_line_snapshots",))
def latest_snapshot(spark):
    """Every line of the newest snapshot."""
    snaps = T(spark, "order_line_snapshots").select("document_number", "ord", "line_key", "snapshot_ts")
    # Wall-clock output, independent of the session time zone.
    return views.latest_snapshot(snaps, "snapshot_ts").withColumn("snapshot_ts", F.col("snapshot_ts").cast("timestamp_ntz"))


@query("batch_planned_date", ("planned_pickup",))
def batch_planned_date(spark):
    """Distinct batch planned pickup dates."""
    return views.planned_dates(T(spark, "planned_pickup"))


@query("line_attributes", ("line_attributes",))
def line_attributes(spark):
    """Distinct line attributes created inside the date window."""
    return views.line_attribute_rows(T(spark, "line_attributes"), ATTRIBUTES_SINCE, AS_OF)


@query("batch_release_date", ("packing_log",))
def batch_release_date(spark):
    """Latest uploaded packing-list date per batch."""
    return views.batch_release_dates(T(spark, "packing_log"))


@query("invoice_list", ("invoice_map",))
def invoice_list(spark):
    """Invoice numbers per PO line."""
    return views.invoice_lists(T(spark, "invoice_map"))


SHIPMENT_INPUTS = ("shipment_header", "shipment_lines", "batch_lines", "packing_log")


@query("shipment_dates", SHIPMENT_INPUTS)
def shipment_dates(spark):
    """Newest dates per shipment over lines and batches."""
    return views.shipment_dates(T(spark, "shipment_header"), T(spark, "shipment_lines"),
                                T(spark, "batch_lines"), T(spark, "packing_log"))


def _overview(spark):
    dates = views.shipment_dates(T(spark, "shipment_header"), T(spark, "shipment_lines"),
                                 T(spark, "batch_lines"), T(spark, "packing_log"))
    return views.shipment_overview(T(spark, "shipment_header"), dates)


@query("shipment_overview", SHIPMENT_INPUTS)
def shipment_overview(spark):
    """Every shipment header with its newest dates."""
    return _overview(spark)


@query("open_confirmed", ("confirmations", "po_line_snapshots"))
def open_confirmed(spark):
    """Confirmed lines still open on the newest PO snapshot."""
    return views.open_confirmed(T(spark, "confirmations"), T(spark, "po_line_snapshots"), EXCLUDED_MEMO)


# --- enrichment and roll-up ---------------------------------------------------

LINE_COLUMNS = ("document_number", "ord", "line_key", "batch_id", "item", "quantity", "pending_value",
                "current_status", "sub_status", "inb", "tracker")


def tracked_lines(spark) -> DataFrame:
    """Labelled open lines with the columns the roll-up reads."""
    return rules.label_lines(T(spark, "order_lines")).select(*LINE_COLUMNS)


@query("line_enriched", ("order_lines", "line_attributes") + SHIPMENT_INPUTS + ("planned_pickup",))
def line_enriched(spark):
    """Tracked lines with delivery location, shipment fields and planned pickup date."""
    lines = tracked_lines(spark)
    attrs = views.line_attribute_rows(T(spark, "line_attributes"), ATTRIBUTES_SINCE, AS_OF)
    out = lookups.first_match_lookup(lines, attrs, "line_key", "rollup_id", ["deliver_to_location"],
                                     order=["deliver_to_location", "currency"])
    ship = _overview(spark)
    out = lookups.unique_lookup(out, ship, "inb", "inb", LINE_SHIPMENT_COLUMNS)
    out = lookups.unique_lookup(out, views.planned_dates(T(spark, "planned_pickup")), "batch_id", "batch_id", ["spd"])
    return out.select("document_number", "ord", "line_key", "tracker", "deliver_to_location", *LINE_SHIPMENT_COLUMNS, "spd")


@query("rollup_labels", ("order_lines",))
def rollup_labels(spark):
    """Roll-up id of every tracked line."""
    return rollup.label_rows(sync.pinned(tracked_lines(spark))).select("document_number", "ord", "line_key", "id_col")


ROLLUP_ORDER = ("document_number", "ord")


def _label_keys(spark) -> tuple[DataFrame, DataFrame]:
    """Tracked lines with keys of their roll-up ids, and the long ids."""
    return rollup.label_keys(sync.pinned(tracked_lines(spark)), once=sync.pinned)


def _collapsed(rows: DataFrame, scope: str) -> DataFrame:
    if scope == "batch":
        coll = rollup.collapse(rows.where("batch_scope"), "batch_id", ROLLUP_ORDER,
                               sum_cols=("quantity", "pending_value"), first_cols=("tracker", "id_col"),
                               ordered_cols=("item",),
                               set_cols=("document_number", "line_key", "current_status", "sub_status"))
    else:
        coll = rollup.collapse(rows.where("document_scope"), "document_number", ROLLUP_ORDER,
                               sum_cols=("quantity", "pending_value"), first_cols=("tracker", "id_col"),
                               ordered_cols=("item",), set_cols=("line_key", "current_status", "sub_status"))
        coll = coll.withColumn("batch_id", F.lit(None).cast("string"))
    return coll.select(F.col("id_col").alias("rollup_id"), F.col("line_key").alias("order_line_id"), "batch_id",
                       "document_number", "tracker", "item", "quantity",
                       F.round("pending_value", 2).alias("pending_value"), "current_status", "sub_status")


@query("rollup_batch", ("order_lines",))
def rollup_batch(spark):
    """Batch-scope lines collapsed to one row per batch."""
    rows, texts = _label_keys(spark)
    return rollup.with_ids(_collapsed(rows, "batch"), texts, "rollup_id")


@query("rollup_document", ("order_lines",))
def rollup_document(spark):
    """Document-scope lines collapsed to one row per document."""
    rows, texts = _label_keys(spark)
    return rollup.with_ids(_collapsed(rows, "document"), texts, "rollup_id")


@query("rollup_dropped", ("order_lines",))
def rollup_dropped(spark):
    """Count of tracked lines the roll-up loses (batch scope without a batch id)."""
    return rollup.dropped_lines(rollup.scope_flags(tracked_lines(spark)))


@query("rollup_all", ("order_lines",))
def rollup_all(spark):
    """Untouched lines + batch rows + document rows, first key of each list."""
    # The labelled lines feed three branches; write them once (shared checkpoint
    # folder) instead of re-deriving labels and roll-up ids per branch.
    rows, texts = _label_keys(spark)
    rows = sync.pinned(rows)
    rest = rows.where(~(F.col("batch_scope") | F.col("document_scope"))).select(
        F.col("line_key").alias("rollup_id"), F.col("line_key").alias("order_line_id"), "batch_id", "document_number",
        "tracker", "item", "quantity", F.round("pending_value", 2).alias("pending_value"),
        "current_status", "sub_status")
    collapsed = _collapsed(rows, "batch").unionByName(_collapsed(rows, "document"))
    allrows = rest.unionByName(rollup.with_ids(collapsed, texts, "rollup_id"))
    return allrows.withColumn("order_line_id", F.split_part(F.col("order_line_id"), F.lit(","), F.lit(1)))


@query("rollup_wide", ("order_lines", "line_documents"))
def rollup_wide(spark):
    """W1, U5-U8, A4-A7 over all typed fields of the documents: 8 sums, 3 ordered lists, a distinct list of every other."""
    labels, texts = _label_keys(spark)
    labels = labels.select(
        "document_number", "ord", "line_key", "batch_id", "tracker", "batch_scope", "document_scope", "id_col")
    fields = [name for _, _, name in LINE_FIELDS if name not in ("document_number", "batch_id", "order_line_id")]
    documents = views.line_projection(views.latest_snapshot(T(spark, "line_documents"), "snapshot_ts"), "rdata",
                                      [f for f in LINE_FIELDS if f[2] in fields], keep=("line_key", "ord"))
    rows = sync.pinned(labels.join(documents, ["line_key", "ord"]))
    sets = [f for f in fields if f not in ROLLUP_SUMS + ROLLUP_LISTS]
    out = rollup.full_rows(rows, ROLLUP_ORDER, ROLLUP_SUMS, ROLLUP_LISTS, sets, texts=texts)
    whole = [c for c in ROLLUP_SUMS if c not in ("pending_value", "per_unit_amount")]
    return out.withColumns({c: F.col(c).cast("decimal(38,0)").cast("double") for c in whole})


@query("rollup_collisions", ("order_lines",))
def rollup_collisions(spark):
    """Ids that several roll-up rows share (a line in both scopes, documents under one batch label, repeated line keys)."""
    rows, texts = sync.labelled_rows(T(spark, "order_lines"))
    return rollup.with_ids(rollup.collisions(sync.members_of(rows)), texts, "rollup_id")


@query("rollup_merged", ("order_lines",))
def rollup_merged(spark):
    """U5-U8 with one row per id: rows that share an id are collapsed anew from their distinct lines."""
    rows, texts = sync.labelled_rows(T(spark, "order_lines"))
    return sync.merged_rows(sync.pinned(sync.members_of(rows)), texts)


def held_rollup_list(spark) -> DataFrame:
    """The held list as the run before left it: its roll-up, with the ids and readers that the list gave its items."""
    rows = sync.desired_list(T(spark, "previous_lines"), ROLLUP_LIST)
    item = F.conv(F.substring(F.md5(F.col("title").cast("binary")), 1, 12), 16, 10).cast("bigint")
    return rows.withColumn("list_id", item).withColumn(
        "ids_with_access", F.when(F.col("list_id") % 3 == 0, "101; 103").when(F.col("list_id") % 3 == 1, "102,104"))


def _tracked_sync(spark) -> dict[str, DataFrame]:
    return sync.tracked_sync(T(spark, "order_lines"), held_rollup_list(spark), ROLLUP_LIST)


SYNC_INPUTS = ("order_lines", "previous_lines")


@query("tracked_sync", SYNC_INPUTS)
def tracked_sync(spark):
    """C1/U8 end to end: numbered requests that bring the held list to the merged roll-up of today's lines."""
    return _tracked_sync(spark)["requests"]


@query("tracked_sync_changes", SYNC_INPUTS)
def tracked_sync_changes(spark):
    """C1/U8 end to end: the change set behind those requests."""
    return _tracked_sync(spark)["change_set"]


@query("tracked_sync_report", SYNC_INPUTS)
def tracked_sync_report(spark):
    """Rows of every output of the tracked-lines job."""
    return sync.report(_tracked_sync(spark))


# --- inspection flow ------------------------------------------------------------

ATTACHMENT_BASE = "/inspection/attachments/"


def _ilines(spark) -> DataFrame:
    return inspection.inspection_lines(T(spark, "order_lines"))


@query("email_schedule", ("order_lines",))
def email_schedule(spark):
    """A1: e-mail date per line key with a prd near the as-of date."""
    return inspection.email_schedule(_ilines(spark), AS_OF)


@query("vendor_join", ("order_lines", "vendors"))
def vendor_join(spark):
    """Vendor contact of every scheduled line key."""
    rows = inspection.vendor_join(inspection.scheduled_lines(_ilines(spark), AS_OF, columns=("vendor_id", "name")), T(spark, "vendors"))
    return rows.select("order_line_id", F.col("vendor_id_num").alias("vendor_id"),
                       X.after_first_token("name").alias("vendor_name"), "vendor_email")


@query("sent_flag", ("order_lines", "sent_ledger"))
def sent_flag(spark):
    """Whether each scheduled key was already sent."""
    sched = inspection.email_schedule(_ilines(spark), AS_OF)
    return lookups.membership_flag(sched, T(spark, "sent_ledger"), "order_line_id", "line_key",
                                   "sent_already").select("order_line_id", "sent_already")


@query("inspection_list", ("order_lines", "vendors", "sent_ledger"))
def inspection_list(spark):
    """Q1: the inspection list rows to publish."""
    return inspection.inspection_list(_ilines(spark), T(spark, "vendors"), T(spark, "sent_ledger"), AS_OF,
                                      INSPECTION_SUBSET_STATUSES, INSPECTION_SUBSET_LABEL)


BOOKING_INPUTS = ("order_lines", "deny_list", "qi_list", "sent_ledger")


def _base(spark) -> DataFrame:
    return inspection.booking_base(_ilines(spark), T(spark, "deny_list"))


def _new_lines(spark) -> DataFrame:
    base = _base(spark)
    cands = inspection.booking_eligible(base, T(spark, "qi_list"), AS_OF).unionByName(
        inspection.resend_lines(base, T(spark, "sent_ledger"), AS_OF))
    return inspection.new_booking_lines(cands, T(spark, "sent_ledger"))


@query("booking_eligible", BOOKING_INPUTS)
def booking_eligible(spark):
    """Q2, Q3, A2: lines of keys ready for an inspection booking (or sent early)."""
    return inspection.booking_eligible(_base(spark), T(spark, "qi_list"), AS_OF)


@query("resend_lines", BOOKING_INPUTS)
def resend_lines(spark):
    """Q4, A3: lines of already-sent documents to send again after a prd change."""
    return inspection.resend_lines(_base(spark), T(spark, "sent_ledger"), AS_OF)


@query("new_booking_lines", BOOKING_INPUTS)
def new_booking_lines(spark):
    """Q5: candidate lines not yet in the sent ledger."""
    return _new_lines(spark)


@query("booking_log", BOOKING_INPUTS + ("vendors",))
def booking_log(spark):
    """Q6: one log row per document with the form path and vendor contact."""
    return inspection.booking_log(_new_lines(spark), T(spark, "vendors"), ATTACHMENT_BASE)


@query("booking_forms", BOOKING_INPUTS)
def booking_forms(spark):
    """Form sheets to prepare, one per (document, item)."""
    return inspection.booking_forms(_new_lines(spark))


@query("ledger_next", BOOKING_INPUTS)
def ledger_next(spark):
    """Q7: sent ledger after this run."""
    return inspection.ledger_next(T(spark, "sent_ledger"), _new_lines(spark))


def _inspection_sync(spark) -> dict[str, DataFrame]:
    return sync.inspection_sync(T(spark, "order_lines"), T(spark, "vendors"), T(spark, "sent_ledger"), T(spark, "deny_list"),
                                T(spark, "held_inspections"), INSPECTION_WIDE, AS_OF, ATTACHMENT_BASE)


INSPECTION_SYNC_INPUTS = ("order_lines", "vendors", "sent_ledger", "deny_list", "held_inspections")


@query("inspection_sync", INSPECTION_SYNC_INPUTS)
def inspection_sync(spark):
    """Q1 and C1 end to end: the change set of the inspection list over its 26 fields."""
    return _inspection_sync(spark)["change_set"]


@query("inspection_sync_report", INSPECTION_SYNC_INPUTS)
def inspection_sync_report(spark):
    """Rows of every output of the inspection job: change set, new booking lines, ledger, send log, forms."""
    return sync.report(_inspection_sync(spark))


# --- lists of many fields --------------------------------------------------------
WIDE_INPUTS = ("tracked_rows", "held_tracked")


def _tracked_wide(spark) -> widelist.WideChangeSet:
    wanted = lookups.align_schema(T(spark, "tracked_rows"), [(f, source) for f, source, _ in TRACKED_MAP])
    return widelist.WideChangeSet(T(spark, "held_tracked"), wanted, TRACKED_WIDE)


def _inspection_rows(spark) -> DataFrame:
    return inspection.inspection_list(_ilines(spark), T(spark, "vendors"), T(spark, "sent_ledger"), AS_OF, INSPECTION_SUBSET_STATUSES,
                                      INSPECTION_SUBSET_LABEL)


@query("tracked_wide_diff", WIDE_INPUTS)
def tracked_wide_diff(spark):
    """C3 over the tracked list's 80 fields."""
    return _tracked_wide(spark).diff()


@query("tracked_wide_changes", WIDE_INPUTS)
def tracked_wide_changes(spark):
    """C1, X1-X4, P22 over the tracked list's 80 fields."""
    return _tracked_wide(spark).result()


@query("inspection_wide_changes", ("order_lines", "vendors", "sent_ledger", "held_inspections"))
def inspection_wide_changes(spark):
    """C1, P22 over the inspection list's 26 fields, field by field."""
    wanted = lookups.align_schema(_inspection_rows(spark), INSPECTION_MAP)
    return widelist.WideChangeSet(T(spark, "held_inspections").drop("send_early"), wanted, INSPECTION_WIDE).result()


@query("map_report", ("order_lines", "vendors", "sent_ledger", "tracked_rows"))
def map_report(spark):
    """Both column maps against the frames they read: overridden and dangling sources, and rows that each field fills."""
    out = None
    for name, mapping, df in (("tracked", [(f, s) for f, s, _ in TRACKED_MAP], T(spark, "tracked_rows")),
                              ("inspection", list(INSPECTION_MAP), _inspection_rows(spark))):
        part = widelist.map_report(name, mapping, df, lookups.align_schema(df, mapping))
        out = part if out is None else out.unionByName(part)
    return out


# --- outbox ---------------------------------------------------------------------

RESERVED_EXTRA = ("list_id", "add_user_ids", "remove_user_ids")


def _tracker_changes(spark) -> DataFrame:
    return changeset.change_set(T(spark, "existing_list"), T(spark, "desired_list"), TRACKER_LIST)


def _outbox_rows(spark) -> DataFrame:
    return outbox.outbox_rows(_tracker_changes(spark))


@query("outbox_payload", LISTS)
def outbox_payload(spark):
    """The JSON body each change-set row would send."""
    ch = _tracker_changes(spark)
    return ch.select("title", "action", outbox.payload(ch, RESERVED_EXTRA).alias("payload"))


@query("outbox_requests", LISTS)
def outbox_requests(spark):
    """Numbered create / update / access / delete requests."""
    return outbox.outbox_requests(_outbox_rows(spark), outbox.payloads(_tracker_changes(spark), reserved_extra=RESERVED_EXTRA))


def returned_ids_standin(rows: DataFrame) -> DataFrame:
    """Stand-in for the ids a create batch returns: one per add needing access,
    except that every fourth chunk returns one id too few (exercises C15)."""
    need = rows.where((F.col("action") == "add") & ((F.size("grants") > 0) | (F.size("revokes") > 0)))
    ranked = need.select("chunk_no", "row_no").withColumn(
        "position", F.row_number().over(Window.partitionBy("chunk_no").orderBy("row_no")))
    last = ranked.groupBy("chunk_no").agg(F.max("position").alias("__last"))
    short = ranked.join(last, "chunk_no").where(~((F.col("chunk_no") % 4 == 3) & (F.col("position") == F.col("__last"))))
    return short.select("chunk_no", "position", (F.lit(1000000) + F.col("row_no")).alias("item_id"))


@query("permission_requests", LISTS)
def permission_requests(spark):
    """Access requests for created rows, paired with returned ids."""
    rows = _outbox_rows(spark)
    return outbox.permission_requests(rows, returned_ids_standin(rows))


@query("outbox_summary", LISTS)
def outbox_summary(spark):
    """A10: rows read / processed and requests per batch."""
    return outbox.outbox_summary(_outbox_rows(spark))


@query("delivery_outcomes", ("delivery_results",))
def delivery_outcomes(spark):
    """A10: attempts and outcomes of every delivered batch, time-outs apart."""
    return outbox.delivery_outcomes(T(spark, "delivery_results"))
