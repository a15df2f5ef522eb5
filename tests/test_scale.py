"""What the jobs move, keep and sort."""

import os
import re

from podelta.config import TRACKED_MAP, TRACKED_WIDE
from podelta.operators import inspection, outbox, widelist
from podelta.session import ensure_checkpoint_dir
from podelta.plans import sync
from podelta.sources import fixtures
from podelta.sources.tables import DRIVER_TABLES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pinned_rows_are_columns_on_disk(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, t string")
    kept = sync.pinned(rows)
    assert "FileScan parquet" in _plan(kept) and sorted(kept.collect(), key=str) == sorted(rows.collect(), key=str)
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert any(f.endswith(".zstd.parquet") for _, _, files in os.walk(folder) for f in files)
    numbered = outbox.number_rows(spark.createDataFrame([("b",), ("a",), ("c",)], "t string"), ["t"])
    assert "FileScan parquet" in _plan(numbered) and [(r.t, r.row_no) for r in numbered.orderBy("t").collect()] == [("a", 1), ("b", 2), ("c", 3)]


def test_scheduled_lines_are_read_once(spark):
    lines = spark.createDataFrame(
        [("k1", 2, "1998-06-20", "x"), ("k1", 1, "1999-06-20", "y"), ("k2", 1, "1990-01-01", "z"), ("k3", 1, "soon", "u"), (None, 1, "1998-06-20", "v"),
         ("k4", 1, "1998-06-20", "w"), ("k4", 1, "1998-06-20", "w")], "order_line_id string, ord int, prd string, item string")
    out = inspection.scheduled_lines(lines, "1998-06-15")
    assert sorted((r.order_line_id, r.ord, r.prd, r.item, str(r.email_scheduled_for)) for r in out.collect()) == [
        ("k1", 1, "1999-06-20", "y", "1998-06-10"), ("k4", 1, "1998-06-20", "w", "1998-06-10")]
    assert "Join" not in _plan(out)


def test_wide_fields_are_no_rows(spark):
    names = [f for f, _, _ in TRACKED_MAP if f != "title"]
    held = spark.createDataFrame([("k", 1, *["a"] * len(names))], "title string, list_id long, " + ", ".join(f"`{n}` string" for n in names))
    wanted = held.drop("list_id")
    plan = _plan(widelist.WideChangeSet(held, wanted, TRACKED_WIDE).diff())
    assert "posexplode" not in plan and "collect_list" not in plan
    assert widelist.WideChangeSet(held, wanted, TRACKED_WIDE).diff().collect() == []


def test_lines_are_shuffled_once_for_the_orders_and_their_number(spark, tmp_path):
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     "(1, 7, 3, 2, 5d, 10d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (1, 7, 3, 1, 4d, 20d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
                     "(1, 7, 3, 1, 4d, 20d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (2, 8, 3, 1, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
                     "(null, 7, 3, 1, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (1, 7, 9, 1, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02')"),
        "orders": ("o_orderkey long, o_orderdate timestamp", "(1, timestamp'1997-01-01'), (2, timestamp'1997-01-01'), (2, timestamp'1997-02-01')"),
        "supplier": ("s_suppkey long, s_name string", "(3, 'S')"), "part": ("p_partkey long, p_brand string", "(7, 'B7'), (8, 'B8')")}
    for name, (schema, rows) in tables.items():
        names = ", ".join(c.split()[0] for c in schema.split(", "))
        spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})").to(spark.createDataFrame([], schema).schema).createOrReplaceTempView(name)
    try:
        lines = spark.sql(fixtures.spark_text("order_lines"))
        plan = _plan(lines)
        window = plan[plan.index("Window"):]
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
        # One exchange of lines, one of orders: none between the last join and the window.
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2 and "Exchange" not in window[:window.index("ShuffledHashJoin")]
        assert sorted(map(str, lines.collect())) == sorted(map(str, spark.sql(fixtures.FIXTURES["order_lines"][0]).collect()))
        assert sorted((r.document_number, r.ord) for r in lines.collect()) == [("PO1", 1), ("PO1", 2), ("PO1", 3), ("PO2", 1), ("PO2", 2)]
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        spark.conf.set("podelta.fixtures.dir", "")


def test_lines_are_kept_once_and_first_lines_are_not_numbered_again(spark, tmp_path):
    lines = ("(1, 7, 3, 2, 5d, 10d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (1, 12, 3, 3, 4d, 20d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
             "(1, 1, 3, 23, 4d, 21d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (1, 7, 3, 2, 5d, 10d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
             "(13, 7, 3, 2, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (13, 7, 9, 1, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
             "(13, 8, 3, null, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), (5, 8, 3, null, 2d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02'), "
             "(null, 7, 3, 1, 1d, 1d, 0d, 0d, 'A', 'F', timestamp'1998-01-02')")
    tables = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                           "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp", lines),
              "orders": ("o_orderkey long, o_orderdate timestamp", "(1, timestamp'1997-01-01'), (13, timestamp'1997-01-01'), (5, timestamp'1997-02-01')"),
              "supplier": ("s_suppkey long, s_name string", "(3, 'S')"), "part": ("p_partkey long, p_brand string", "(7, 'B7'), (8, 'B8'), (12, 'C'), (1, 'D')")}
    for name in DRIVER_TABLES:
        schema, rows = tables.get(name, ("x int", "(1)"))
        names = ", ".join(c.split()[0] for c in schema.split(", "))
        out = spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})").to(spark.createDataFrame([], schema).schema)
        out.write.parquet(f"{tmp_path}/{name}.parquet")
    views = ("order_lines", "existing_list", "desired_list", "held_inspections", "tracked_rows", "held_tracked")
    try:
        fixtures.register_fixtures(spark, str(tmp_path), views)
        for name in views:
            kept, plain = spark.table(name), spark.sql(f"{fixtures.cte_chain((name,))} SELECT * FROM {name}")
            assert not re.search("Window|Exchange hashpartitioning|Join", _plan(kept)) and kept.schema.names == plain.schema.names
            key = next(c for c in ("title", "rollup_id", "line_key") if c in kept.columns)
            known = lambda df: sorted(map(str, df.where(f"{key} IS NOT NULL").collect()))
            assert known(kept) == known(plain) and kept.count() == plain.count()
        assert spark.table("order_lines").count() == 7 and spark.table("desired_list").count() == 4
    finally:
        spark.conf.set("podelta.fixtures.dir", "")
