"""S1 source: named tables.

``load_source`` is the one way jobs get a table: a catalogue table when the
name resolves in the session, else a parquet file under a base folder.  A
parquet scan keeps Spark's column pruning and filter pushdown, so callers
should select only what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load_source(spark: SparkSession, name: str, base_dir: str | None = None) -> DataFrame:
    if base_dir is None:
        return spark.table(name)
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, base_dir: str, names=DRIVER_TABLES) -> None:
    """Expose the parquet tables of ``base_dir`` as session views."""
    for name in names:
        load_source(spark, name, base_dir).createOrReplaceTempView(name)
