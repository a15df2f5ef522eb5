"""The end-to-end jobs, the merged roll-up, and lists of many fields."""

from __future__ import annotations

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from podelta.config import CHUNK_SIZE, INSPECTION_WIDE, ROLLUP_LIST, TRACKED_MAP, TRACKED_WIDE, FieldSpec, ListSpec
from podelta.operators import changeset, lookups, rollup, widelist
from podelta.plans import catalog, sync
from podelta.sources import io
from podelta.sources.fixtures import register_fixtures

SF = "/root/testdata/sf0.001"
LINES = ("document_number string, ord long, line_key string, batch_id string, item string, quantity long, pending_value double, "
         "current_status string, sub_status string, final_poc string, sm string, tracker string")


def lines(spark, rows):
    """(document, ord, key, batch, tracker)"""
    return spark.createDataFrame([(d, o, k, b, f"i{o}", 10, 1.5, "cs", "ss", "User1", "User2", t) for d, o, k, b, t in rows], LINES)


def members(spark, rows):
    return rollup.memberships(rollup.label_rows(lines(spark, rows)))


def test_a_line_in_both_scopes_counts_once(spark):
    # Its first line is in batch scope, so the document row takes the batch row's id.
    at = members(spark, [("D1", 1, "a", "B1", "BP, PP"), ("D1", 2, "b", "B1", "PP"), ("D2", 1, "c", "B1", "TLX"), ("D3", 1, "d", None, "PRD")])
    (c,) = rollup.collisions(at).collect()
    assert (c.rollup_id, c.rows, c.scopes, c.lines) == ("B1 - D1,D2 - 2", 2, "batch,document", 4)
    got = {r.rollup_id: r for r in sync.merged_rows(at).collect()}
    assert got.keys() == {"B1 - D1,D2 - 2", "d"}
    both = got["B1 - D1,D2 - 2"]
    assert (both.quantity, both.item, both.batch_id, both.document_number) == (30, "i1,i2,i1", "B1", "D1,D2")
    assert (got["d"].quantity, got["d"].batch_id, got["d"].document_number) == (10, None, "D3")


def test_repeated_line_keys_and_lost_lines(spark):
    at = members(spark, [("D1", 1, "a", None, "PRD"), ("D1", 2, "a", None, "PRD"), ("D2", 1, "x", None, "BP")])
    (c,) = rollup.collisions(at).collect()
    assert (c.rollup_id, c.rows, c.scopes) == ("a", 2, "line")
    assert [(r.rollup_id, r.quantity) for r in sync.merged_rows(at).collect()] == [("a", 20)]


def test_missing_documents_are_named_in_labels(spark):
    got = {r.line_key: r.id_col for r in rollup.label_rows(lines(spark, [
        ("D2", 1, "a", "b1", "BP"), (None, 1, "b", "b1", "BP"), (None, 2, "c", "b2", "BP")])).collect()}
    assert got == {"a": "b1 - D2,nan - 1", "b": "b1 - D2,nan - 1", "c": "b2 - nan - nan"}


def test_a_hot_batch_collapses_to_the_same_row(spark):
    """A third of all lines in one batch: pieces of a group add up to what a whole group gives."""
    rows = [(f"D{n % 40:02}", n, f"k{n}", "B0" if n % 3 == 0 else f"B{n % 50}", "BP" if n % 2 else "BP, PP") for n in range(900)]
    at = members(spark, rows)
    whole = {tuple(r) for r in sync.merged_rows(at).collect()}
    cut = rollup.merged(at, sync.ORDER, ("quantity", "pending_value"), ("tracker",), ("item",),
                        ("document_number", "line_key", "current_status", "sub_status", "final_poc", "sm"), chunk_rows=7)
    assert {(r.rollup_id, r.quantity, r.item, r.document_number) for r in cut.collect()} == {(r[0], r[6], r[5], r[3]) for r in whole}


def test_sync_is_a_fixed_point(spark):
    """Against the list that it would publish, a run finds nothing to do."""
    register_fixtures(spark, SF, ("order_lines",))
    held = sync.desired_list(spark.table("order_lines"), ROLLUP_LIST).withColumn("list_id", F.xxhash64("title")).withColumn(
        "ids_with_access", F.lit("; ".join(str(100 + i) for i in range(20))))
    assert sync.tracked_sync(spark.table("order_lines"), held, ROLLUP_LIST)["change_set"].count() == 0


def test_outputs_are_written(spark, tmp_path):
    register_fixtures(spark, SF, catalog.SYNC_INPUTS)
    out = sync.tracked_sync(spark.table("order_lines"), catalog.held_rollup_list(spark), ROLLUP_LIST)
    assert sync.write_outputs(out, str(tmp_path), "r1") and not sync.write_outputs(out, str(tmp_path), "r1")
    for name in ("change_set", "batches", "collisions", "dropped"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == out[name].count()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out["requests"].schema)
    requests = io.read_outbox(spark, f"{tmp_path}/requests", schema)
    assert requests.count() == out["requests"].count()
    sizes = requests.groupBy("chunk_no").agg(F.count_distinct("row_no").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == CHUNK_SIZE


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """The wide stand-ins as tables, as a job reads them."""
    register_fixtures(spark, SF, ("tracked_rows", "held_tracked"))
    at = tmp_path_factory.mktemp("wide")
    out = []
    for name in ("held_tracked", "tracked_rows"):
        spark.table(name).write.parquet(f"{at}/{name}")
        out.append(spark.read.parquet(f"{at}/{name}"))
    return out[0], lookups.align_schema(out[1], [(f, s) for f, s, _ in TRACKED_MAP])


def test_wide_code_compiles_and_moves_each_list_once(spark, wide):
    settings = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = widelist.WideChangeSet(*wide, TRACKED_WIDE).result()
        assert df.count() > 0  # a generated method over 64 KB would fail here
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


@pytest.mark.parametrize("spec", [TRACKED_WIDE, dataclasses.replace(TRACKED_WIDE, item_level_access=False, refill_columns=())])
def test_wide_form_agrees_with_the_column_form(spark, wide, spec):
    columns = {r.title: r for r in changeset.change_set(*wide, spec).collect()}
    for r in widelist.WideChangeSet(*wide, spec).result().collect():
        want = columns.pop(r.title)
        assert (r.list_id, r.action, r.add_user_ids, r.remove_user_ids, r.ids_with_access) == (
            want.list_id, want.action, want.add_user_ids, want.remove_user_ids, want.ids_with_access)
        payload = json.loads(r.payload)
        for f in spec.fields:
            value = want[f.name]
            if f.name == "title" or isinstance(value, float):
                continue
            blank = value is None or value.strip().lower() in ("", "nan", "none", "null")
            assert payload.get(f.name) == (None if blank else value.strip()), (r.title, f.name)
    assert not columns


def test_wide_form_edge_cases(spark):
    spec = ListSpec(fields=(FieldSpec("title"), FieldSpec("a"), FieldSpec("n", format_float=True), FieldSpec("d", dropdown=True)))
    old = spark.createDataFrame([("k1", 1, "5.0", 1.00049, '{"Value":"x"}'), ("k2", 2, "gone", None, None), ("k2", 9, "later", None, None),
                                 ("k3", 3, "same", None, "y"), (None, 4, "no key", None, None)],
                                "title string, list_id long, a string, n double, d string")
    new = spark.createDataFrame([("k1", "5", 1.0001, "x"), ("k3", None, None, "y"), ("k4", "nan", float("nan"), "{z}")],
                                "title string, a string, n double, d string")
    got = {r.title: r for r in widelist.WideChangeSet(old, new, spec).result().collect()}
    # k1 is equal after rounding and decoding; k3 only loses a value, which is no update; the first held k2 goes.
    assert {k: (r.action, r.list_id, r.payload) for k, r in got.items()} == {"k2": ("delete", 2, '{"a":"gone"}'), "k4": ("add", None, "{}")}
    with pytest.raises(Exception, match="desired key occurs more than once: k4"):
        widelist.WideChangeSet(old, new.unionAll(new.where("title = 'k4'")), spec).result().collect()
    assert widelist.WideChangeSet(old.limit(0), new.limit(0), spec).result().collect() == []


def test_map_findings():
    got = widelist.map_findings([("a", "x"), ("b", "x"), ("c", "gone"), ("d", "d")], ["x", "d"])
    assert got == [("a", "x", True, False), ("b", "x", False, False), ("c", "gone", False, True), ("d", "d", False, False)]
    assert len(TRACKED_MAP) == 80 and len(INSPECTION_WIDE.fields) == 26


def test_lines_do_not_carry_the_documents_of_their_batch(spark):
    """Rows of the roll-up have keys of bounded length; the ids come back whole, and equal ids of other origin still collide."""
    rows = [(f"PO{i:04}", 1, f"k{i}", "B1", "BP") for i in range(300)]
    (label,) = {r.id_col for r in rollup.label_rows(lines(spark, rows)).collect()}
    assert len(label) > 2000
    df = lines(spark, rows + [("Z", 1, label, None, "PRD"), ("Z", 2, "k" * 70, None, "PRD"), ("Y" * 60, 1, "a", None, "PP"), ("PO0007", 2, "b", "B1", "PP, BP")])
    keyed, texts = rollup.label_keys(df)
    at = sync.members_of(keyed)
    assert max(len(r.rollup_id) for r in at.collect()) == rollup.KEY_CHARS + 1
    whole = rollup.memberships(rollup.label_rows(df))
    assert (sorted(map(tuple, rollup.with_ids(rollup.collisions(at), texts, "rollup_id").collect()))
            == sorted(map(tuple, rollup.collisions(whole).collect())))
    assert sorted(map(tuple, sync.merged_rows(at, texts).collect())) == sorted(map(tuple, sync.merged_rows(whole).collect()))
