"""The two end-to-end jobs: each derives all its outputs from frames that are written once.

``tracked_sync`` labels the open lines, rolls them up, compares the result with the held list and numbers the requests.
``inspection_sync`` schedules inspections, books new lines and compares the inspection list with the held one.  Both return named
outputs; ``write_outputs`` stores them with the sinks of ``sources.io``.  Held lists, ledgers and contacts are inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podelta.config import INSPECTION_SUBSET_LABEL, INSPECTION_SUBSET_STATUSES, ListSpec
from podelta.operators import changeset, inspection, lookups, outbox, rollup, rules
from podelta.session import pinned
from podelta.sources import io

LINE_COLUMNS = ("document_number", "ord", "line_key", "batch_id", "item", "quantity", "pending_value", "current_status", "sub_status",
                "final_poc", "sm", "tracker")
ORDER = ("document_number", "ord")
RESERVED = ("list_id", "add_user_ids", "remove_user_ids")


def labelled_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tracked lines with scope flags and keys of their labels, and the long labels; the lines are read and labelled once."""
    return rollup.label_keys(pinned(rules.label_lines(lines).select(*LINE_COLUMNS)), once=pinned)


def members_of(rows: DataFrame) -> DataFrame:
    """Memberships by key of the roll-up id."""
    return rollup.memberships(rows, line_id=rollup.compact)


def merged_rows(members: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """The roll-up with one row per id, as the tracked list shows it; ``texts`` are the ids of ``members`` by key."""
    rows = rollup.merged(members, ORDER, sum_cols=("quantity", "pending_value"), first_cols=("tracker",), ordered_cols=("item",),
                         set_cols=("document_number", "line_key", "current_status", "sub_status", "final_poc", "sm"))
    rows = rows.select("rollup_id", F.split_part("line_key", F.lit(","), F.lit(1)).alias("order_line_id"), "batch_id", "document_number",
                       "tracker", "item", "quantity", F.round("pending_value", 2).alias("pending_value"), "current_status", "sub_status",
                       "final_poc", "sm")
    return rows if texts is None else rollup.with_ids(rows, texts, "rollup_id")


def desired_list(lines: DataFrame, spec: ListSpec) -> DataFrame:
    rows, texts = labelled_rows(lines)
    return lookups.align_schema(merged_rows(pinned(members_of(rows)), texts), [(f.name, f.source or f.name) for f in spec.fields])


def tracked_sync(lines: DataFrame, held: DataFrame, spec: ListSpec) -> dict[str, DataFrame]:
    """change_set, requests, batches, collisions and dropped lines of one run."""
    rows, texts = labelled_rows(lines)
    rows = pinned(rows)
    members = pinned(members_of(rows))
    desired = lookups.align_schema(merged_rows(members, texts), [(f.name, f.source or f.name) for f in spec.fields])
    changes = pinned(changeset.change_set(held, desired, spec))
    numbered = outbox.outbox_rows(changes, key=spec.key, item_id=spec.item_id)
    bodies = outbox.payloads(changes, spec.key, spec.item_id, RESERVED)
    return {"change_set": changes, "requests": outbox.outbox_requests(numbered, bodies), "batches": outbox.outbox_summary(numbered),
            "collisions": rollup.with_ids(rollup.collisions(members), texts, "rollup_id"), "dropped": rollup.dropped_lines(rows)}


def inspection_sync(lines: DataFrame, vendors: DataFrame, ledger: DataFrame, deny: DataFrame, held: DataFrame, spec: ListSpec,
                    as_of: str, attachments: str) -> dict[str, DataFrame]:
    """change_set, new booking lines, next ledger, send log and forms of one run; both branches read the same normalised lines."""
    normal = inspection.inspection_lines(lines)
    listed = inspection.inspection_list(normal, vendors, ledger, as_of, INSPECTION_SUBSET_STATUSES, INSPECTION_SUBSET_LABEL)
    desired = lookups.align_schema(listed, [(f.name, f.source or f.name) for f in spec.fields])
    base = inspection.booking_base(normal, deny)
    candidates = inspection.booking_eligible(base, held, as_of).unionByName(inspection.resend_lines(base, ledger, as_of))
    new = pinned(inspection.new_booking_lines(candidates, ledger))
    return {"change_set": changeset.change_set(held.drop("send_early"), desired, spec), "new_lines": new,
            "ledger": inspection.ledger_next(ledger, new), "log": inspection.booking_log(new, vendors, attachments),
            "forms": inspection.booking_forms(new)}


def report(outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows of each output; change sets by action, requests by kind, and the count that ``dropped`` holds."""
    parts = []
    for name, df in outputs.items():
        by = {"change_set": F.col("action"), "requests": F.col("kind")}.get(name, F.lit(""))
        rows = F.coalesce(F.sum("dropped_lines"), F.lit(0)) if name == "dropped" else F.count(F.lit(1))
        counted = df.select("dropped_lines") if name == "dropped" else df
        parts.append(counted.groupBy(F.lit(name).alias("output"), by.alias("detail")).agg(rows.alias("rows")))
    return reduce(DataFrame.unionByName, parts)


def write_outputs(outputs: dict[str, DataFrame], path: str, run_id: str) -> bool:
    """Every output below ``path`` as one run: the ledger and the outbox grow, the others show the last run.

    The run is committed by its last write, so a run that died on the way is written anew by the same ``run_id`` and a
    committed one is not repeated; returns whether anything was written.
    """
    spark = next(iter(outputs.values())).sparkSession
    if io.is_committed(spark, path, run_id):
        return False
    for name, df in outputs.items():
        if name == "requests":
            io.write_outbox(df, f"{path}/{name}", run_id)
        elif name == "new_lines":
            io.append_ledger(df, f"{path}/sent", run_id)
            io.write_table(df, f"{path}/{name}")
        else:
            io.write_table(df, f"{path}/{name}")
    io.commit(spark, path, run_id)
    return True
