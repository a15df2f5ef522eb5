"""Unit tests: one small hand-made frame per rule of the semantics notes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from podelta.config import NOT_BLANK, Condition, FieldSpec, ListSpec, Rule
from podelta.functions import exprs as X
from podelta.operators import changeset, inspection, lookups, outbox, rollup, rules, views


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# --- value equivalence (P14) --------------------------------------------------
EQUIV = [
    ("5.0", "5", True), ("1e3", "1000", True), ("1_000", "1000", True), (" abc ", "abc", True),
    ("nan", "nan", True), ("nan", None, False), ("nan", "abc", False), ("", None, True), (" ", None, True),
    ("5", "5.1", False), ("inf", "Infinity", True), ("5d", "5", False), ("abc", "ABC", False),
    (None, "x", False), ("0.10", ".1", True), ("-0", "0", True),
]


def test_equivalence_truth_table(spark):
    df = spark.createDataFrame([Row(a=a, b=b) for a, b, _ in EQUIV], "a string, b string")
    got = [r[0] for r in df.select(X.equivalent("a", "b").alias("e")).collect()]
    assert got == [e for _, _, e in EQUIV]


def test_numeric_column_equivalence(spark):
    df = spark.createDataFrame([(5.0, "5"), (float("nan"), None), (2.5, "2.50"), (1.0, "x")], "a double, b string")
    got = [r[0] for r in df.select(X.canon("a", "double").eqNullSafe(X.canon("b")).alias("e")).collect()]
    assert got == [True, True, True, False]


# --- small scalar operators ---------------------------------------------------------
def test_scalar_helpers(spark):
    df = spark.createDataFrame([("12 Acme Co", "3.0", '{"Value": "A"}', "{'Value': 'Yes', 'Id': 1}", " 8; 12,8 ;"),
                                ("Solo", "", "plain", "Yes", None),
                                (None, None, '{"Other": 1}', "{'Value': 'No'}", "")],
                               "name string, line string, dd string, lit string, ids string")
    out = df.select(X.first_token("name").alias("t1"), X.after_first_token("name").alias("t2"),
                    X.normalize_line_id("line").alias("ln"), X.dropdown_value("dd").alias("dd"),
                    X.literal_dict_value("lit").alias("lit"), X.render_id_list(X.parse_id_list("ids")).alias("ids"),
                    X.int_or_zero("name").alias("iz"))
    assert _rows(out, "t1", "t2", "ln", "dd", "lit", "ids", "iz") == [
        ("12", "Acme Co", "3", "A", "Yes", "8; 12", 0),
        ("Solo", None, "0", "plain", "Yes", "", 0),
        (None, None, "nan", '{"Other": 1}', "No", "", 0),
    ]


def test_blank_and_nan_cleanup(spark):
    df = spark.createDataFrame([(None,), (" ",), ("NaN",), ("None",), ("x",), (" nan ",)], "v string")
    out = df.select(X.is_blank("v").alias("b"), X.nan_to_empty("v").alias("c"))
    assert _rows(out, "b", "c") == [(True, ""), (True, " "), (True, ""), (True, "None"), (False, "x"), (True, " nan ")]


def test_int_or_zero(spark):
    df = spark.createDataFrame([("5",), ("5.7",), ("x",), (None,), ("1_0",), ("nan",)], "v string")
    assert [r[0] for r in df.select(X.int_or_zero("v")).collect()] == [5, 5, 0, 0, 10, 0]


# --- rules (R1-R4) -------------------------------------------------------------------
def test_rule_semantics(spark):
    rs = (
        Rule("A", (Condition("s", ("x", " y ")),)),
        Rule("N", (Condition("s", ("x",)), Condition("d", (None,)))),
        Rule("B", (Condition("s", ("y",)),)),
        Rule("NB", (Condition("t", (NOT_BLANK,)),)),
        Rule("Z", (Condition("missing", ("x",)),)),
        Rule("C", (Condition("t", (0, " ")),)),
    )
    df = spark.createDataFrame([(" x ", None, "0"), ("y", dt.date(2020, 1, 1), " "), ("q", None, None)],
                               "s string, d date, t string")
    got = _rows(rules.label_lines(df, rs, keep_unlabelled=True).orderBy("s"), "s", "tracker")
    assert got == [(" x ", "A, N, NB, C"), ("q", ""), ("y", "A, B, C")]


def test_bp_moves_last(spark):
    df = spark.createDataFrame([("17. QC Schedule Pending", "17. QC Schedule Pending", None, None, None)],
                               "current_status string, sub_status string, invoice_number string, prd date, "
                               "compliance_status string")
    assert rules.label_lines(df).first()["tracker"] == "SPD, QC, BP"


# --- keep first / lookups --------------------------------------------------------------
def test_keep_first_is_deterministic_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 5, "n1"), (None, 3, "n2")], "k string, o int, v string")
    assert set(_rows(lookups.keep_first(df, ["k"], ["o"]), "k", "v")) == {(None, "n2"), ("k", "a")}


def test_unique_lookup_raises_on_duplicates(spark):
    left = spark.createDataFrame([("a",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    joined = lookups.unique_lookup(left, right, "k", "k", ["v"])  # no job yet
    with pytest.raises(Exception, match="lookup key k repeats: a"):
        joined.collect()
    assert _rows(lookups.unique_lookup(left, right.where("v = 1"), "k", "k", ["v"]), "k", "v") == [("a", 1)]
    assert lookups.unique_lookup(left, right, "k", "k", ["v"], on_duplicate="first", order=["v"]).first()["v"] == 1


def test_align_schema_last_target_wins(spark):
    df = spark.createDataFrame([("t", "p")], "key string, owner string")
    out = lookups.align_schema(df, [("title", "key"), ("first_owner", "owner"), ("owner", "owner"), ("gone", "nope")])
    assert out.columns == ["title", "first_owner", "owner", "gone"]
    assert tuple(out.first()) == ("t", None, "p", None)


def test_anti_keeps_null_keys(spark):
    left = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert set(_rows(lookups.anti(left, right, "k"), "k")) == {(None,), ("b",)}


# --- views -----------------------------------------------------------------------------------
def test_latest_snapshot_ties_and_nulls(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, t1), (2, t2), (3, t2), (4, None)], "id int, ts timestamp")
    assert sorted(r[0] for r in views.latest_snapshot(df, "ts").collect()) == [2, 3]
    assert [r[0] for r in views.latest_snapshot(df, "ts", nulls_first=True).collect()] == [4]


def test_newest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)], "k string, ts int, id int")
    assert sorted(r["id"] for r in views.newest_per_key(df, ["k"], "ts").collect()) == [2, 3, 4]


def test_document_projection_case_sensitive(spark):
    df = spark.createDataFrame([('{"k": 5, "K": 6, "s": "x"}',), ("not json",)], "props string")
    out = views.document_projection(df, "props", [("$.k", "int", "k"), ("$.K", "int", "K2"), ("$.s", "int", "bad")])
    assert [tuple(r) for r in out.collect()] == [(5, 6, None), (None, None, None)]


# --- roll-up ---------------------------------------------------------------------------------
def test_rollup_labels_and_lost_rows(spark):
    rows = [("D1", 1, "k1", "B1", "G4"), ("D1", 2, "k2", None, "G4"), ("D2", 1, "k3", "B1", "Supp Confirm"),
            ("D3", 1, "k4", None, "PP"), ("D3", 2, "k5", None, "QC")]
    df = spark.createDataFrame(rows, "document_number string, ord int, line_key string, batch_id string, tracker string")
    got = dict(_rows(rollup.label_rows(df), "line_key", "id_col"))
    assert got == {"k1": "B1 - D1 - 2", "k2": "k2", "k3": "B1 - D1 - 2", "k4": "D3 - 2", "k5": "D3 - 2"}


def test_collapse_first_ordered_and_sets(spark):
    rows = [("B", "D2", 1, "i3", None, 2, "x"), ("B", "D1", 2, "i2", "t2", None, "y"), ("B", "D1", 1, "i1", None, 1, None)]
    df = spark.createDataFrame(rows, "g string, document_number string, ord int, item string, tracker string, q long, s string")
    out = rollup.collapse(df, "g", ("document_number", "ord"), sum_cols=("q",), first_cols=("tracker",),
                          ordered_cols=("item",), set_cols=("s",)).first()
    assert (out["q"], out["tracker"], out["item"], out["s"]) == (3, "t2", "i1,i2,i3", "nan,x,y")


# --- change set ------------------------------------------------------------------------------
SPEC = ListSpec(fields=(FieldSpec("title", update_check=False), FieldSpec("status"),
                        FieldSpec("qty", format_float=True), FieldSpec("pick", dropdown=True),
                        FieldSpec("owner")),
                item_level_access=True, identity_columns=("owner",), refill_columns=("owner",),
                admin_ids=(9,), user_ids={"u1": 1, "u2": 2, "u3": 3})


def _lists(spark):
    existing = spark.createDataFrame([
        ("same", 10, "A", 1.0, '{"Value": "p"}', "u1", "1; 9"),
        ("changed", 11, "A", 1.0, None, "u1", "1"),
        ("blanked", 12, "A", 1.0, None, "u1", "1; 9"),
        ("gone", 13, "A", 1.0, '{"Value": "p"}', "u2", None),
        ("dup", 15, "A", 1.0, None, "u1", None), ("dup", 14, "Z", 1.0, None, "u1", None),
    ], "title string, list_id long, status string, qty double, pick string, owner string, ids_with_access string")
    desired = spark.createDataFrame([
        ("same", "A ", 1.0004, "p", "u1"), ("changed", "B", 1.0, None, "u2"), ("blanked", "", 1.0, None, "u1"),
        ("new", "N", 2.0, "p", "u3"), ("dup", "Z", 1.0, None, "u1"),
    ], "title string, status string, qty double, pick string, owner string")
    return existing, desired


def test_change_set_tracker_mode(spark):
    existing, desired = _lists(spark)
    out = {r["title"]: r for r in changeset.change_set(existing, desired, SPEC).collect()}
    assert set(out) == {"changed", "new", "gone", "blanked"}
    assert out["new"]["action"] == "add" and out["new"]["list_id"] is None and out["new"]["ids_with_access"] == "9"
    assert out["gone"]["action"] == "delete" and out["gone"]["pick"] == '{"Value": "p"}'
    ch = out["changed"]
    assert (ch["action"], ch["status"], ch["owner"], ch["list_id"]) == ("update", "B", "u2", 11)
    # grant desired owner, revoke old owner; existing access {1} removed from grants
    assert (ch["ids_with_access"], ch["remove_user_ids"], ch["add_user_ids"]) == ("2; 9", "1", "2; 9")
    # emptied field: changed but kept blank; the update survives only through access changes
    assert out["blanked"]["status"] == "" and out["blanked"]["ids_with_access"] == ""


def test_change_set_inspection_mode_cancels_empty_updates(spark):
    existing, desired = _lists(spark)
    spec = ListSpec(fields=SPEC.fields, item_level_access=False, admin_ids=(9, 1))
    out = {r["title"]: r for r in changeset.change_set(existing, desired, spec).collect()}
    assert set(out) == {"changed", "new", "gone"}
    assert out["changed"]["add_user_ids"] == "1; 9" and out["changed"]["ids_with_access"] == ""


def test_change_set_of_identical_lists_has_no_updates(spark):
    existing, _ = _lists(spark)
    same = existing.drop("list_id", "ids_with_access")
    fields = tuple(FieldSpec(f.name, update_check=f.update_check, format_float=f.format_float) for f in SPEC.fields)
    spec = ListSpec(fields=fields, item_level_access=False)
    assert changeset.change_set(existing.where("title <> 'dup'"), same.where("title <> 'dup'"), spec).count() == 0


def test_field_diff_and_actions(spark):
    existing, desired = _lists(spark)
    diff = dict(_rows(changeset.field_diff(existing, desired, SPEC), "title", "changed_fields"))
    assert diff == {"changed": "status,owner", "blanked": "status"}
    acts = dict(_rows(changeset.change_actions(existing, desired, SPEC), "title", "action"))
    assert acts == {"same": "none", "changed": "update", "blanked": "update", "gone": "delete", "new": "add", "dup": "none"}


def test_access_delta_disjoint_from_existing(spark):
    existing, desired = _lists(spark)
    delta = changeset.access_delta(existing, desired, SPEC)
    have = {r["title"]: set(filter(None, (r["ids_with_access"] or "").replace(",", ";").replace(" ", "").split(";")))
            for r in existing.collect()}
    for r in delta.collect():
        grants = set(filter(None, r["add_user_ids"].split("; ")))
        revokes = set(filter(None, r["remove_user_ids"].split("; ")))
        if r["action"] in ("update",):
            assert not grants & have[r["title"]]
            assert revokes <= have[r["title"]]


# --- inspection ---------------------------------------------------------------------------
def test_booking_checks(spark):
    as_of = "2024-01-10"
    rows = [("k1", "Yes", dt.date(2024, 1, 15), "1 | Awaiting Release", None),
            ("k1", "No", None, "awaiting release", None),
            ("k2", "Yes", dt.date(2024, 1, 15), None, None),
            ("k3", "Yes", dt.date(2024, 1, 30), "Awaiting Release", None)]
    df = spark.createDataFrame(rows, "k string, im_signoff string, prd date, qc_status string, qc_date date")
    assert [r[0] for r in inspection.booking_checks(df, "k", as_of).collect()] == ["k1"]


def test_email_schedule(spark):
    rows = [("k1", dt.date(2024, 3, 1)), ("k1", dt.date(2023, 1, 1)), ("k2", dt.date(2025, 1, 1)), ("k3", None)]
    df = spark.createDataFrame(rows, "order_line_id string, prd date")
    got = _rows(inspection.email_schedule(df, "2024-01-10"), "order_line_id", "email_scheduled_for")
    assert got == [("k1", dt.date(2022, 12, 22))]


# --- outbox -------------------------------------------------------------------------------------
def test_payload_rules(spark):
    df = spark.createDataFrame([("t", "  v ", "nan", "{x}", "x" * 2100, 1, "a")],
                               "title string, a string, b string, c string, d string, ID int, action string")
    p = df.select(outbox.payload(df)).first()[0]
    assert p == '{"title":"t","a":"v","d":"' + "x" * 2000 + '"}'
    assert outbox.is_reserved("Editor") and outbox.is_reserved("x#Claims") and not outbox.is_reserved("title")


def test_number_rows_is_global_and_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = outbox.number_rows(df, ["k"], partitions=7).orderBy("k").select("k", "row_no").collect()
    assert [r["row_no"] for r in got] == list(range(1, 1001))
    assert [r["k"] for r in got] == list(range(1000))


def test_outbox_requests_and_permissions(spark):
    changes = spark.createDataFrame([
        ("a", None, "add", "9", ""), ("u", 5, "update", "1; 2", "3"), ("d", 6, "delete", "1", ""),
        ("x", None, "update", "1", ""),
    ], "title string, list_id long, action string, add_user_ids string, remove_user_ids string")
    rows = outbox.outbox_rows(changes, chunk_size=2)
    reqs = _rows(outbox.outbox_requests(rows, outbox.payloads(changes)).orderBy("batch_no", "row_no", "seq"), "batch_no", "kind", "title", "principal")
    assert reqs == [(1, "create", "a", None), (3, "update", "u", None), (3, "break_inheritance", "u", None),
                    (3, "grant", "u", "1"), (3, "grant", "u", "2"), (3, "revoke", "u", "3"), (6, "delete", "d", None)]
    returned = spark.createDataFrame([(0, 1, 77)], "chunk_no long, position int, item_id long")
    perms = _rows(outbox.permission_requests(rows, returned).orderBy("seq"), "batch_no", "kind", "item_id", "principal")
    assert perms == [(2, "break_inheritance", "77", None), (2, "grant", "77", "9")]
    short = spark.createDataFrame([], "chunk_no long, position int, item_id long")
    assert outbox.permission_requests(rows, short).count() == 0


def test_delivery_summary(spark):
    res = spark.createDataFrame([(1, "ok", True), (2, "timeout", True), (3, None, False)],
                                "batch_no int, status string, success boolean")
    assert tuple(outbox.delivery_summary(res).first()) == (3, 1, 1, 1, 0)



def test_number_rows_with_imbalanced_partitions(spark):
    # one large and several tiny input partitions make the range partitioner re-sample
    big = spark.range(0, 30000, numPartitions=1)
    small = spark.range(30000, 30016, numPartitions=8)
    df = big.union(small).select(((F.col("id") * 7919) % 30016).alias("k"))
    out = outbox.number_rows(df, ["k"], partitions=8)
    assert out.where(F.col("row_no") != F.col("k") + 1).count() == 0
    assert out.count() == 30016


def test_collapse_hot_group_in_pieces(spark):
    # one group holding every row, split into many pieces (chunk_rows=7)
    n = 2000
    data = [("G", f"D{i % 13:02d}", i // 13, f"i{i}", (i * 31) % 97, f"s{i % 5}", None if i % 13 < 3 else f"f{i}")
            for i in range(n)]
    df = spark.createDataFrame(data, "g string, document_number string, ord int, item string, q int, s string, "
                                     "f string")
    out = rollup.collapse(df, "g", ("document_number", "ord"), sum_cols=("q",), first_cols=("f",),
                          ordered_cols=("item",), set_cols=("s",), chunk_rows=7)
    row = out.first()
    ordered = sorted(data, key=lambda r: (r[1], r[2]))
    assert row["item"] == ",".join(r[3] for r in ordered)
    assert row["q"] == sum(r[4] for r in data)
    assert row["s"] == ",".join(sorted({r[5] for r in data}))
    assert row["f"] == next(r[6] for r in ordered if r[6] is not None)


def test_invoice_lists_repeats_and_nulls(spark):
    df = spark.createDataFrame([("L1", "b"), ("L1", "a"), ("L1", "b"), ("L2", None), ("L3", "x"), ("L3", None)],
                               "po_line_unique_key string, document_number string")
    got = dict(_rows(views.invoice_lists(df), "po_line_unique_key", "invoice_numbers"))
    assert got == {"L1": "a, b, b", "L2": None, "L3": "x"}


# --- faults found by review ---------------------------------------------------
def test_labels_follow_the_lines_that_are_read(spark, tmp_path):
    path = str(tmp_path / "lines")
    schema = "line_key string, current_status string"
    spark.createDataFrame([("k1", "x")], schema).write.parquet(path)
    labelled = rules.label_lines(spark.read.schema(schema).parquet(path), keep_unlabelled=True)
    spark.createDataFrame([("k2", "02. Supplier Confirmation Pending")], schema).write.mode("append").parquet(path)
    again = rules.label_lines(spark.read.schema(schema).parquet(path), keep_unlabelled=True)
    assert {r.line_key for r in again.collect()} == {"k1", "k2"} and "checkpoint" not in str(labelled._jdf.queryExecution())


def test_repeated_desired_keys(spark):
    from podelta.config import TRACKER_LIST
    from podelta.operators.changeset import ChangeSet
    spec = TRACKER_LIST
    field = next(f.name for f in spec.fields if f.name != spec.key)
    old = spark.createDataFrame([("a", 1, "1")], f"{spec.key} string, {spec.item_id} int, {field} string")
    new = spark.createDataFrame([("a", "3"), ("a", "2")], f"{spec.key} string, {field} string")
    with pytest.raises(Exception, match="occurs more than once"):
        ChangeSet(old, new, spec).joined.collect()
    assert ChangeSet(old, new, spec, "first", (field,)).joined.count() == 1
    with pytest.raises(ValueError):
        ChangeSet(old, new, spec, "first")


def test_number_texts(spark):
    from podelta.functions import exprs
    df = spark.createDataFrame([(12345678.5, "12.5"), (0.0005, " "), (5.0, "5d"), (-1e7, "1_000"), (1e-9, None), (0.25, "7")], "d double, t string")
    got = [tuple(r) for r in df.select(exprs.float_text("d"), exprs.blank_to_zero("t", "double")).collect()]
    assert got == [("12345678.5", 12.5), ("0.0005", 0.0), ("5.0", None), ("-10000000.0", None), ("1.0E-9", 0.0), ("0.25", 7.0)]


def test_bad_date_text_counts_as_none(spark):
    from podelta.operators import inspection
    df = spark.createDataFrame([("a", "2020-01-10"), ("a", "soon"), ("b", "soon")], "order_line_id string, prd string")
    got = inspection.email_schedule(df, "2020-01-01").collect()
    assert [(r[0], str(r[1])) for r in got] == [("a", "2019-12-31")]


def test_full_rows_of_any_width(spark):
    """Batch, document and untouched rows share columns: sums, ordered lists with repeats, distinct lists with nan, first key."""
    rows = spark.createDataFrame(
        [("D1", 1, "k2", "b1", "T", True, False, "b1 - D1 - 2", 1.5, "i", "x"), ("D1", 2, "k1", "b1", "T", True, False, "b1 - D1 - 2", None, "i", None),
         ("D2", 1, "k3", None, "P", False, True, "D2 - 1", None, None, "y"), ("D3", 1, "k4,z", None, "Q", False, False, "k4,z", None, "j", None)],
        "document_number string, ord long, line_key string, batch_id string, tracker string, batch_scope boolean, document_scope boolean, "
        "id_col string, amount double, item string, note string")
    got = rollup.full_rows(rows, ("document_number", "ord"), ("amount",), ("item",), ("note",)).orderBy("rollup_id").collect()
    assert [tuple(r) for r in got] == [
        ("D2 - 1", "k3", None, "D2", "P", 0.0, "nan", "y"), ("b1 - D1 - 2", "k1", "b1", "D1", "T", 1.5, "i,i", "nan,x"),
        ("k4,z", "k4", None, "D3", "Q", None, "j", None)]
