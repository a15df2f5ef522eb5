"""Connected components over an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import stage


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least node among u and all its neighbours v."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def _rounds(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    small = _with_least(down)
    return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b, comparable, not null): root is the component's least node.

    Each round is a few hash joins and aggregates with map-side combining and is written to the shared checkpoint folder;
    rounds grow with the logarithm of the component size.  It ends when a round leaves every edge pointing at a root.
    """
    at = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "edges")
    while True:
        parents = at.select("v").distinct()
        # A star forest: one edge per node, and no parent that is itself a child.
        chained = at.join(parents.withColumnRenamed("v", "u"), "u", "left_semi").limit(1).count()
        forked = 0 if chained else at.groupBy("u").count().where("count > 1").limit(1).count()
        if not chained and not forked:
            break
        at = stage(_rounds(at), "edges")
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
