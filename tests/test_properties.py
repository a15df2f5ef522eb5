"""Property tests (hypothesis): the change set, applied to the existing list,
reproduces the desired list on every non-blank checked field.

Exact 'nan' words count as empty on output (P20), so they are left out of
the comparison like blanks."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from podelta.config import FieldSpec, ListSpec
from podelta.operators import changeset, rollup

VALUES = st.sampled_from([None, "", " ", "a", "A ", "b", "5", "5.0", "nan", "1e1", "10"])
KEYS = st.sampled_from([f"k{i}" for i in range(8)])
SPEC = ListSpec(fields=(FieldSpec("title", update_check=False), FieldSpec("f1"), FieldSpec("f2")),
                item_level_access=False)


def _canon(v):
    if v is None or str(v).strip() == "":
        return None
    s = str(v).strip()
    try:
        f = float(s)
    except ValueError:
        return ("S", s)
    return "NAN" if math.isnan(f) else ("N", f)


def _table(draw_rows):
    out = {}
    for k, a, b in draw_rows:
        out.setdefault(k, (a, b))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.lists(st.tuples(KEYS, VALUES, VALUES), max_size=8), new=st.lists(st.tuples(KEYS, VALUES, VALUES), max_size=8))
def test_apply_change_set_reaches_desired(spark, old, new):
    old_t, new_t = _table(old), _table(new)
    existing = spark.createDataFrame([(k, i, a, b) for i, (k, (a, b)) in enumerate(sorted(old_t.items()))],
                                     "title string, list_id long, f1 string, f2 string")
    desired = spark.createDataFrame([(k, a, b) for k, (a, b) in sorted(new_t.items())], "title string, f1 string, f2 string")
    applied = {k: list(v) for k, v in old_t.items()}
    for r in changeset.change_set(existing, desired, SPEC).collect():
        if r["action"] == "add":
            applied[r["title"]] = [r["f1"], r["f2"]]
        elif r["action"] == "delete":
            del applied[r["title"]]
        else:
            for i, f in enumerate(("f1", "f2")):
                if r[f] not in ("", None):
                    applied[r["title"]][i] = r[f]
    assert set(applied) == set(new_t)
    for k, vals in new_t.items():
        for i, v in enumerate(vals):
            if _canon(v) is not None and v not in ("nan", "NaN", "NAN"):
                assert _canon(applied[k][i]) == _canon(v), (k, i, v, applied[k][i])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["B1", "B2", None]), st.integers(0, 50),
                               st.sampled_from(["D1", "D2", "D3"])), min_size=1, max_size=25))
def test_collapse_conserves_quantity(spark, rows):
    data = [(b, d, i, f"i{i}", q) for i, (b, q, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "batch_id string, document_number string, ord int, item string, quantity long")
    out = rollup.collapse(df, "batch_id", ("document_number", "ord"), sum_cols=("quantity",), first_cols=(),
                          ordered_cols=("item",), set_cols=(), chunk_rows=3)
    got = {r["batch_id"]: (r["quantity"], r["item"]) for r in out.collect()}
    for b in {r[0] for r in data if r[0] is not None}:
        mine = sorted((r for r in data if r[0] == b), key=lambda r: (r[1], r[2]))
        assert got[b] == (sum(r[4] for r in mine), ",".join(r[3] for r in mine))
    assert None not in got
