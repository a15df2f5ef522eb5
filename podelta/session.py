"""Session helpers.

The library never creates its own cluster configuration: jobs take the
active session.  ``get_session`` is a convenience for tests, benches and
local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "podelta") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Plans here are built from many column expressions; skip recording a
        # Python call site for each one (a fixed, data-independent cost).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we read
    it and never override it.  Only a local-mode session without one (tests,
    benches) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running podelta jobs on a cluster")
    path = tempfile.mkdtemp(prefix="podelta-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that several outputs read it instead of deriving it again.

    Compressed Parquet, not ``checkpoint``: that keeps rows as they lie in memory, uncompressed, and every reader reads all columns.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/pinned-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
