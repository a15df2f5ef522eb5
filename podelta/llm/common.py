"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podelta.session import ensure_checkpoint_dir

#: Fixed value: the white space of the word rule, as a regular-expression class.
WORD_SPACE = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Lineage ends there, so a lost executor costs one re-read, and Spark knows the real size of what it reads when it
    picks a join strategy.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``let v = value in body(v)``: ``value`` is computed once per row however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def batches(rows: Callable[..., Iterator[tuple]], schema: pa.Schema, chunk: int = 2048) -> Callable:
    """Function for ``mapInArrow``: ``rows(*values)`` yields result tuples for one input row.

    Results leave in batches of at most ``chunk`` rows, so memory follows one Arrow batch.
    """

    def run(it):
        out: list[tuple] = []
        for batch in it:
            columns = [c.to_pylist() for c in batch.columns]
            for values in zip(*columns):
                out.extend(rows(*values))
                if len(out) >= chunk:
                    yield to_batch(out, schema)
                    out = []
        if out:
            yield to_batch(out, schema)

    return run


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(df: DataFrame, key: str, **fields: pa.DataType) -> pa.Schema:
    """Arrow schema of the key column of ``df`` (under its own type) followed by ``fields``."""
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([pa.field(key, to_arrow_type(df.schema[key].dataType))] + [pa.field(k, t) for k, t in fields.items()])


def spark_schema(schema: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)
