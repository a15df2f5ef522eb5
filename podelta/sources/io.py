"""Sources and sinks S2-S8 as plain Spark reads and writes.

Schemas are explicit (no inference pass over the data), reads are lazy, and
every sink is a distributed write: nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from podelta.config import ListSpec

LEDGER_SCHEMA = StructType([
    StructField("line_key", StringType()), StructField("document_number", StringType()),
    StructField("item", StringType()), StructField("line_id", StringType()),
    StructField("date_sent", StringType()), StructField("resend", StringType()),
])
VENDOR_SCHEMA = StructType([StructField("id", StringType()), StructField("name", StringType()),
                            StructField("email", StringType()), StructField("cm_email", StringType()),
                            StructField("sm_email", StringType())])


def list_schema(spec: ListSpec, extra=()) -> StructType:
    """Schema of an exported list: key and fields as text, item id as long."""
    names = [spec.key, spec.item_id] + [f.name for f in spec.fields if f.name != spec.key] + list(extra)
    return StructType([StructField(n, LongType() if n == spec.item_id else StringType()) for n in dict.fromkeys(names)])


# S2 -------------------------------------------------------------------------
def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): the records of CSV files whose quoted cells may span lines, split in parallel.

    A line begins a record if an even number of quotes stands before it in its file.  Each byte range counts the quotes
    and the records it would begin for either parity; a running sum over the ranges, one row each, settles which holds.
    Lines of a record that spans ranges meet by its number.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    here = Window.partitionBy("file", "block").orderBy("at")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", F.coalesce(F.sum(quotes).over(before), F.lit(0)) % 2).withColumn("quotes", quotes)
    ranges = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("parity"), F.count_if(F.col("odd") == 0).alias("even"),
                                                F.count_if(F.col("odd") == 1).alias("uneven"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("open", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("base", F.coalesce(F.sum(F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("uneven"))).over(earlier),
                                                  F.lit(0)))
    begins = F.sum((F.col("odd") == F.col("open")).cast("int")).over(here.rowsBetween(Window.unboundedPreceding, 0))
    numbered = lines.join(ranges.select("file", "block", "open", "base"), ["file", "block"]).withColumn("record", F.col("base") + begins)
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("text"))


def read_list_csv(spark: SparkSession, path: str, spec: ListSpec, extra=()) -> DataFrame:
    """Externally held list exported as CSV with a header (quoted multi-line cells allowed), read by as many tasks as it has ranges."""
    schema = list_schema(spec, extra)
    rows = csv_records(spark, path).where("record > 1")  # the first is the header
    cells = F.from_csv(F.regexp_replace("text", "\r$", ""), F.lit(schema.toDDL()), {"escape": '"'})
    return rows.where("text <> ''").select(cells.alias("c")).select("c.*")


# Runs ------------------------------------------------------------------------
def is_committed(spark: SparkSession, path: str, run_id: str) -> bool:
    return _rows_or_none(spark.read.schema("run string"), f"{path}/_runs/{run_id}") is not None


def commit(spark: SparkSession, path: str, run_id: str) -> None:
    """Mark a run as complete: the single write that makes its rows visible."""
    spark.createDataFrame([(run_id,)], "run string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_runs/{run_id}")


def _rows_or_none(reader, path: str, fmt: str = "parquet") -> DataFrame | None:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return None


def _write_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Rows of one run into a folder of their own, replacing what an earlier try left, then the commit."""
    if not is_committed(rows.sparkSession, path, run_id):
        rows.write.mode("overwrite").parquet(f"{path}/rows/run={run_id}")
        commit(rows.sparkSession, path, run_id)


def _committed_rows(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    """Rows of committed runs; one small row per run is joined, so folders of unfinished runs are left out."""
    runs = _rows_or_none(spark.read.schema("run string").option("recursiveFileLookup", True), f"{path}/_runs")
    if runs is None:
        return None
    full = StructType([*(StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields, StructField("run", StringType())])
    return spark.read.schema(full).parquet(f"{path}/rows").join(runs, "run", "left_semi").drop("run")


# S3 -------------------------------------------------------------------------
def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The sent ledger (all text) of the committed runs; an empty one of the same schema when there is none yet."""
    rows = _committed_rows(spark, path, LEDGER_SCHEMA)
    return spark.createDataFrame([], LEDGER_SCHEMA) if rows is None else rows


def import_ledger_csv(spark: SparkSession, csv: str) -> DataFrame:
    """A ledger kept as CSV with a header, as rows for ``append_ledger`` of a first run."""
    rows = spark.read.schema(LEDGER_SCHEMA).option("header", True).csv(csv)
    return rows.withColumnRenamed("line_key", "order_line_id").withColumn("date_sent", F.col("date_sent").try_cast("date"))


# S4 -------------------------------------------------------------------------
def read_vendor_contacts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(VENDOR_SCHEMA)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


# S5 -------------------------------------------------------------------------
def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{"name": id, ...}`` as rows (name, user_id)."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.explode(F.from_json("value", "map<string,bigint>")).alias("name", "user_id"))
    return parsed


# S6 -------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table (header row for CSV)."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


# S7 -------------------------------------------------------------------------
def append_ledger(new_lines: DataFrame, path: str, run_id: str) -> None:
    """This run's new lines; running again with the same id adds nothing, and a run that died before its commit is replaced."""
    rows = new_lines.select(F.col("order_line_id").alias("line_key"), "document_number", "item", "line_id",
                            F.date_format("date_sent", "yyyy-MM-dd").alias("date_sent"), "resend")
    _write_run(rows, path, run_id)


# S8 -------------------------------------------------------------------------
def write_outbox(requests: DataFrame, path: str, run_id: str) -> None:
    """This run's requests in files of coarse, ordered ranges of batch numbers, so that a batch is found by file statistics.

    Requests of earlier runs, delivered or not, stay.
    """
    _write_run(requests.repartitionByRange("batch_no").sortWithinPartitions("batch_no", "row_no", "seq"), path, run_id)


def read_outbox(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Requests of all committed runs; None before the first."""
    return _committed_rows(spark, path, schema)
