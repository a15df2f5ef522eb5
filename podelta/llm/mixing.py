"""Mixing sources to target weights by Poisson replication (operator 5).

Each row's number of copies is a Poisson draw whose mean is its source's repetition rate, target rows / rows it has.  The
draw inverts the distribution at a uniform number that a hash of seed and row key gives, so it is the same on every run, on
any partitioning, and after the loss of an executor.  Copies are then dealt out by a hash, and ordered by it within each
partition, which is a global shuffle without sampling or a sort of the whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from podelta.llm.common import bind, free_name, stage

SEED = 20
#: Without weights a source is weighted by its row count to this power: 1 keeps the mix, 0 makes all sources equal.
TEMPERATURE = 0.5


def uniform(seed: int, *parts: Column) -> Column:
    """Number in (0, 1): the first 52 bits of an MD5 over seed and parts, plus a half, over 2^52."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_table(mean: Column) -> Column:
    """Array of P(X <= k) for k = 0, 1, ... as far as a uniform number of ``uniform`` can reach."""
    last = F.ceil(mean + 12.0 * F.sqrt(mean) + 30.0).cast("int")
    steps = F.transform(F.sequence(F.lit(1), last), lambda k: F.log(mean / k))
    start = F.array(-mean)
    logs = F.aggregate(steps, start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return bind(logs, lambda a: F.aggregate(
        a, F.array().cast("array<double>"), lambda c, x: F.concat(c, F.array(F.coalesce(F.try_element_at(c, F.lit(-1)), F.lit(0.0)) + F.exp(x)))))


def rates(docs: DataFrame, source: str, weights: dict[str, float] | None = None, total: float | None = None,
          temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate, cdf): repetition rate of each source and the distribution to invert, one row per source.

    ``total`` is the wanted number of rows (default: as many as there are).  With ``weights`` a source that they don't name
    has weight 0 and the named ones share the total; a null source is a source of its own.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        if any(w < 0 or not math.isfinite(w) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        table = F.create_map(*(x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w)))))
        weight = F.coalesce(F.try_element_at(table, F.col("source").cast("string")), F.lit(0.0)) if weights else F.lit(0.0)
    weighted = stage(counts.select("source", "n", weight.alias("w")), "weights")
    all_w = weighted.agg(F.sum("w").alias("w")).scalar()
    wanted = weighted.agg(F.sum("n").cast("double").alias("n")).scalar() if total is None else F.lit(float(total))
    rate = F.when(F.col("w") > 0, wanted * F.col("w") / all_w / F.col("n")).otherwise(0.0)
    rated = weighted.select("source", rate.alias("rate"))
    return rated.select("source", "rate", poisson_table(F.col("rate")).alias("cdf"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
        total: float | None = None, temperature: float = TEMPERATURE, seed: int = SEED, copy: str | None = None) -> DataFrame:
    """Rows of ``docs``, each as often as its draw says, in a globally shuffled order; columns unchanged.

    ``copy`` names an added column with the copy's number from 0 (it replaces a column of that name).  Null keys draw as the
    empty key, repeated rows draw alike, a null source is a source of its own, an empty table gives no rows.
    """
    rate = free_name(docs, "rate")
    table = stage(rates(docs, source, weights, total, temperature).select(F.struct("source", "cdf").alias(rate)), "rates")
    rated = docs.join(table, docs[source].eqNullSafe(F.col(f"{rate}.source")))
    draw = uniform(seed, F.col(f"`{key}`"), F.col(f"`{source}`"))
    times = bind(draw, lambda u: F.size(F.filter(F.col(f"{rate}.cdf"), lambda c: c <= u)))
    counted = rated.withColumn(rate, times).where(F.col(rate) > 0)
    copies = counted.withColumn(rate, F.explode(F.sequence(F.lit(0), F.col(rate) - 1)))
    # All columns take part, so that rows without a key, or of one key, are dealt out as well.
    place = free_name(copies, "place")
    deal = F.xxhash64(F.lit(seed), *(F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType)), F.col(rate))
    dealt = copies.withColumn(place, deal).repartition(place).sortWithinPartitions(place)
    kept = [F.col(f"`{c}`") for c in docs.columns if c != copy]
    return dealt.select(*kept, *([] if copy is None else [F.col(rate).alias(copy)]))
