"""Keyed lookups and keep-first dedupe.

Design notes for scale:

* ``keep_first`` is a ``min(struct(order..., payload...))`` aggregate, not a
  ranked window: it is partially aggregated map-side, so a key holding a
  third of all rows never lands whole in one task.
* Lookups are plain equi-joins without hints.  The sides are data tables
  whose size grows with the input, so the choice between broadcast and
  shuffle is left to Spark's size statistics and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the one with the smallest ``order`` tuple (NULLs first)."""
    keys, order = list(keys), list(order)
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                      *[F.col(c).alias(c) for c in payload])
    picked = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return picked.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in payload]).select(*df.columns)


def first_match_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns, order) -> DataFrame:
    """Map ``columns`` from the first right row per key onto the left rows."""
    r = keep_first(right.select(right_key, *columns, *[o for o in order if o not in columns and o != right_key]),
                   [right_key], order)
    r = r.select(F.col(right_key).alias("__rk"), *columns)
    return left.join(r, left[left_key] == r["__rk"], "left").drop("__rk")


def unique_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns,
                  on_duplicate: str = "error", order=None) -> DataFrame:
    """Left join to a side whose key must be unique.

    ``on_duplicate='error'`` fails the run where a right key repeats (the source's own behaviour): the right side is
    aggregated by its key, which it is shuffled by for the join anyway, and the count is checked in the same plan.
    ``'first'`` keeps the first row per key by ``order`` instead.  No job runs while the frame is built.
    """
    r = right.where(F.col(right_key).isNotNull()).select(right_key, *columns, *[o for o in (order or []) if o not in columns and o != right_key])
    if on_duplicate == "first":
        r = keep_first(r, [right_key], order or [right_key]).select(F.col(right_key).alias("__rk"), *columns)
    elif on_duplicate == "error":
        repeat = F.raise_error(F.concat(F.lit(f"lookup key {right_key} repeats: "), F.col("__rk").cast("string")))
        r = (r.groupBy(F.col(right_key).alias("__rk")).agg(F.min(F.struct(*columns)).alias("__v"), F.count(F.lit(1)).alias("__n"))
             .select(F.when(F.col("__n") == 1, F.col("__rk")).otherwise(repeat.cast(right.schema[right_key].dataType)).alias("__rk"),
                     *[F.col(f"__v.{c}").alias(c) for c in columns]))
    else:
        raise ValueError("on_duplicate is 'error' or 'first'")
    return left.join(r, left[left_key] == r["__rk"], "left").drop("__rk")


def membership_flag(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str,
                    yes: str = "Yes", no: str = "No") -> DataFrame:
    """``yes`` when the left key occurs in the right table, else ``no``."""
    keys = right.select(F.col(right_key).alias("__rk")).where(F.col("__rk").isNotNull()).distinct()
    keys = keys.withColumn("__hit", F.lit(True))
    j = left.join(keys, left[left_key] == keys["__rk"], "left")
    return j.withColumn(name, F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no))).drop("__rk", "__hit")


def semi(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``right``."""
    rk = right_key or left_key
    r = right.select(F.col(rk).alias("__rk"))
    return left.join(r, left[left_key] == r["__rk"], "left_semi")


def anti(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in ``right`` (NULL keys are kept)."""
    rk = right_key or left_key
    r = right.select(F.col(rk).alias("__rk"))
    return left.join(r, left[left_key] == r["__rk"], "left_anti")


def align_schema(df: DataFrame, mapping, extra=()) -> DataFrame:
    """Rename source columns to list fields and fix the column set.

    ``mapping`` is an ordered list of ``(field, source)``.  The rename is
    keyed by source, so when two fields claim one source the later field
    wins and the earlier one comes out NULL.  Fields without a usable
    source keep a same-named column if there is one, else they are NULL
    strings.  ``extra`` names columns appended (NULL when absent).
    """
    rename = {}
    for fld, src in mapping:
        if src:
            rename[src] = fld
    renamed_away = {s for s, f in rename.items() if s != f}
    cols = []
    seen = set()
    for fld in [f for f, _ in mapping] + list(extra):
        if fld in seen:
            continue
        seen.add(fld)
        srcs = [s for s, f in rename.items() if f == fld and s in df.columns]
        if srcs:
            cols.append(F.col(srcs[-1]).alias(fld))
        elif fld in df.columns and fld not in renamed_away:
            cols.append(F.col(fld))
        else:
            cols.append(F.lit(None).cast("string").alias(fld))
    return df.select(*cols)
