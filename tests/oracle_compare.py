"""Run catalogued Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [c for c in sorted(cols)], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, oracle, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(oracle)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = canon_rows(s_cols, s_rows)
    dc, dr = canon_rows(d_cols, d_rows)
    ok = sc == dc and sr == dr
    detail = ""
    if sc != dc:
        detail = f"cols spark={sc} duck={dc}"
    elif sr != dr:
        ss, ds = set(sr), set(dr)
        detail = (f"rows spark={len(sr)} duck={len(dr)}; only-spark {sorted(ss - ds)[:3]}; "
                  f"only-duck {sorted(ds - ss)[:3]}")
    return ok, len(s_rows), len(d_rows), t1 - t0, t2 - t1, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from podelta.session import get_session
    spark = get_session()
    q, o = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(q)):
        if name not in o:
            df = q[name](spark, sf_dir)
            print(f"{name:24s} NO-ORACLE rows={df.count()}")
            continue
        try:
            ok, ns, nd, ts, td, detail = compare(spark, con, name, q[name], o[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, ns, nd, ts, td, detail = False, -1, -1, 0, 0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} ({ts:.1f}s/{td:.1f}s) {detail}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
