"""Sources and sinks S2-S8 round-trip through a scratch folder."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import random
import tempfile

import pytest

from podelta.config import INSPECTION_LIST
from podelta.sources import io


def test_list_csv_and_id_map(spark):
    work = tempfile.mkdtemp(prefix="podelta-io-")
    with open(os.path.join(work, "list.csv"), "w") as f:
        f.write('title,list_id,current_status,sub_status,quantity,pending_value,qc_status,final_poc,sm\n')
        f.write('T1,7,"02. Pending","multi\nline",5.0,1.5,"{""Value"":""x""}",User1,User2\n')
    df = io.read_list_csv(spark, os.path.join(work, "list.csv"), INSPECTION_LIST)
    row = df.first()
    assert (row["title"], row["list_id"], row["sub_status"], row["qc_status"]) == ("T1", 7, "multi\nline", '{"Value":"x"}')
    with open(os.path.join(work, "map.json"), "w") as f:
        json.dump({"User1": 101, "User2": 102}, f, indent=2)
    m = {r["name"]: r["user_id"] for r in io.read_id_map(spark, os.path.join(work, "map.json")).collect()}
    assert m == {"User1": 101, "User2": 102}


def test_a_large_list_is_read_by_many_tasks(spark):
    """Cells with quotes, commas and line ends across the borders of byte ranges; equal to the one-task reader."""
    rng = random.Random(4)
    work = tempfile.mkdtemp(prefix="podelta-io-")
    names = [f.name for f in io.list_schema(INSPECTION_LIST).fields]
    for part in range(2):
        with open(os.path.join(work, f"{part}.csv"), "w", newline="") as f:
            out = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
            out.writerow(names)
            for i in range(3000):
                cell = "".join(rng.choice(["a", "b", '"', ",", "\n", "\n\n", " ", '""', "é"]) for _ in range(rng.randrange(12))) or "x"
                out.writerow([f"T{part}-{i}", i, "x" + cell + "y", *["z" + rng.choice(["", "\n", '"']) + "z"] * (len(names) - 3)])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        one = spark.read.schema(io.list_schema(INSPECTION_LIST)).option("header", True).option("multiLine", True).option("escape", '"').csv(work)
        want = sorted(map(tuple, one.collect()))
        spark.conf.set(key, "7000b")
        got = io.read_list_csv(spark, work, INSPECTION_LIST)
        assert spark.read.text(work).rdd.getNumPartitions() > 20
        assert sorted(map(tuple, got.collect())) == want and len(want) == 6000
    finally:
        spark.conf.set(key, before)


def test_ledger_missing_then_append(spark):
    work = tempfile.mkdtemp(prefix="podelta-io-")
    path = os.path.join(work, "ledger")
    empty = io.read_ledger(spark, path)
    assert empty.count() == 0 and "resend" in empty.columns
    new = spark.createDataFrame([("K1", "D1", "I1", "1", dt.date(2024, 1, 2), "No")],
                                "order_line_id string, document_number string, item string, line_id string, "
                                "date_sent date, resend string")
    io.append_ledger(new, path, "r1")
    io.append_ledger(new, path, "r1")  # the same run again
    assert io.read_ledger(spark, path).count() == 1
    io.append_ledger(new, path, "r2")
    back = io.read_ledger(spark, path)
    assert back.count() == 2 and back.first()["date_sent"] == "2024-01-02"


def test_a_run_that_dies_before_its_commit_is_replaced(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="podelta-io-"), "ledger")
    new = spark.createDataFrame([("K1", "D1", "I1", "1", dt.date(2024, 1, 2), "No")],
                                "order_line_id string, document_number string, item string, line_id string, date_sent date, resend string")
    real = io.commit

    def die(*_):
        raise RuntimeError("killed")

    io.append_ledger(new, path, "r1")
    monkeypatch.setattr(io, "commit", die)
    with pytest.raises(RuntimeError):
        io.append_ledger(new.unionAll(new), path, "r2")
    assert io.read_ledger(spark, path).count() == 1  # rows are there, but the run is not
    monkeypatch.setattr(io, "commit", real)
    io.append_ledger(new, path, "r2")
    assert io.read_ledger(spark, path).count() == 2


def test_table_and_outbox_sinks(spark):
    work = tempfile.mkdtemp(prefix="podelta-io-")
    schema = "batch_no long, row_no long, seq long, kind string"
    df = spark.createDataFrame([(b, b, 0, "a") for b in range(1, 401)], schema)
    at = os.path.join(work, "outbox")
    assert io.read_outbox(spark, at, schema) is None
    io.write_outbox(df, at, "r1")
    io.write_outbox(df, at, "r1")
    io.write_outbox(df.limit(3), at, "r2")  # earlier requests stay
    assert io.read_outbox(spark, at, schema).count() == 403
    files = [f for _, _, names in os.walk(os.path.join(at, "rows")) for f in names if f.endswith(".parquet")]
    assert len(files) < 40
    io.write_table(df, os.path.join(work, "t"), fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(work, "t")).count() == 400
