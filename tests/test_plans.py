"""Plan checks: no Python UDF in any query, no cartesian or nested-loop join."""

from __future__ import annotations

import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from podelta.plans.catalog import QUERIES as CATALOG

SF = "/root/testdata/sf0.001"
QUERIES = dict(CATALOG)
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Offsets of row numbers: one row per partition of the numbered rows.
TINY_WINDOW = "__part"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_upstream_and_down(spark, monkeypatch, name):
    """Every plan of a query, also those that end in a checkpoint: no Python, no cartesian join, no window over all rows."""
    plans, real = [], DataFrame.checkpoint

    def seen(df, *args, **options):
        plans.append(_plan(df))
        return real(df, *args, **options)

    monkeypatch.setattr(DataFrame, "checkpoint", seen)
    plans.append(_plan(QUERIES[name](spark, SF)))
    for plan in plans:
        for bad in FORBIDDEN:
            assert bad not in plan, f"{name}: {bad} in plan"
        for order in re.findall(r"windowspecdefinition\((\S+?)#\d+L? (?:ASC|DESC)", plan):
            assert order == TINY_WINDOW, f"{name}: window over all rows by {order}"
        assert "windowspecdefinition(specified" not in plan, f"{name}: window over all rows"


def test_a_label_is_computed_once(spark):
    for name in ("tracker_labels", "rollup_dropped"):
        assert _plan(QUERIES[name](spark, SF)).count("02. Supplier Confirmation Pending) THEN Supp Confirm") <= 1


def test_scans_are_pruned(spark):
    # only the columns a query needs reach the parquet reader
    plan = _plan(QUERIES["document_projection"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in plan
    plan = _plan(QUERIES["shipment_overview"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan
    assert "l_extendedprice" not in plan
