"""Training-data pipeline: quality rules, near-duplicates, personal data, source mixing, piece encoding.

Each stage takes what the one before kept, is written to the shared folder and read again, so a lost executor repeats at most
one stage's tasks.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podelta.llm import mixing, piece_codec, pii, quality_rules, simhash
from podelta.llm.common import read_table, stage
from podelta.llm.queries import model_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-band rules keep."""
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the least doc_id."""
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws towards the sources' target weights, globally shuffled."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every remaining text."""
    pieces = piece_codec.encode(docs, model_path())
    return pieces.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [("quality rules", quality), ("simhash near-dedup", deduplicate), ("pii", redact), ("mixing", mix), ("pieces", encode)]

#: Compression, SimHash and trained trees are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
