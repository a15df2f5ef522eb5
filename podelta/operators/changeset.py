"""Change set between an externally held list and the desired rows.

Plan shape: one full-outer equi-join on the list key (each side shuffled
once by key; ``keep_first`` on the existing side is an aggregate on the same
key, so its output partitioning is reused by the join), followed by a single
projection that computes every per-field diff, the action, and the access
arrays as column expressions.  The user map is configuration, compiled into
a literal map expression, so access lookups need no join at all.

Keys are unique per side after dedupe, so the join cannot fan out or skew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podelta.config import NAN_WORDS, ListSpec
from podelta.functions.exprs import (PLAIN_NUMBER, canon, dropdown_value, float_text, nan_to_empty, parse_id_list, round3,
                                     strip)
from podelta.operators.lookups import keep_first

_NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def _is_num(t: str | None) -> bool:
    return t is not None and (t in _NUMERIC or t.startswith("decimal"))


def _any(cols) -> Column:
    cols = list(cols)
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def _simple_blank(c: Column, numeric: bool) -> Column:
    if numeric:
        return c.isNull() | F.isnan(c.cast("double"))
    return c.isNull() | (strip(c.cast("string")) == "")


def user_id_lookup(spec: ListSpec, name: Column) -> Column:
    """Owner name -> user id (as text); NULL when unknown or falsy."""
    if not spec.user_ids:
        return F.lit(None).cast("string")
    m = F.create_map(*[x for k, v in spec.user_ids.items() for x in (F.lit(str(k)), F.lit(int(v)))])
    uid = F.try_element_at(m, name)
    return F.when(uid.isNotNull() & (uid != 0), uid.cast("string"))


class ChangeSet:
    """Builds every stage of the change set from one joined frame.

    All text work (dropdown decode, rounding, canonical compare values, user
    lookups) happens in a projection on each side *before* the join, once
    per row.  After the join only attribute comparisons remain, which keeps
    the plan small even when Catalyst pushes the final filter down and
    inlines the per-field expressions into it.
    """

    def __init__(self, existing: DataFrame, desired: DataFrame, spec: ListSpec, on_duplicate: str = "error",
                 order: tuple[str, ...] = ()):
        """``on_duplicate``: "error" fails the run where a desired key repeats; "first" keeps the first by ``order``."""
        if on_duplicate not in ("error", "first") or (on_duplicate == "first" and not order):
            raise ValueError("on_duplicate is 'error', or 'first' with an order")
        self.spec = spec
        key, iid = spec.key, spec.item_id
        fields = [f.name for f in spec.fields if f.name != key]
        extra = [c for c in existing.columns if c not in fields and c not in (key, iid, spec.access_column)]
        self.value_cols = fields + extra
        self.has_access_col = spec.access_column in existing.columns
        self.identity = [c for c in spec.identity_columns if c in self.value_cols] if spec.item_level_access else []

        old = keep_first(existing.where(F.col(key).isNotNull()), [key], [iid])
        new = desired.where(F.col(key).isNotNull())
        once = F.lit(True)
        if on_duplicate == "first":
            new = keep_first(new, [key], list(order))
        else:
            # Counted on the partitioning that the join needs anyway.
            new = new.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(key)))
            once = F.when(F.col("__rows") > 1, F.raise_error(F.concat(F.lit("desired key occurs more than once: "),
                                                                      F.col(key).cast("string"))).cast("boolean")).otherwise(True)
        old_types, new_types = dict(existing.dtypes), dict(desired.dtypes)
        self.types = {}
        for c in self.value_cols:
            present = [t for t in (old_types.get(c), new_types.get(c)) if t is not None]
            self.types[c] = "double" if present and all(_is_num(t) for t in present) else "string"
        self.old_cols = {c for c in self.value_cols if c in old_types}
        self.new_cols = {c for c in self.value_cols if c in new_types}

        o_sel = [F.col(key).alias("__k"), F.lit(True).alias("__in_old"), F.col(iid).alias("__item_id")]
        n_sel = [F.col(key).alias("__k"), once.alias("__in_new")]
        for c in self.value_cols:
            t = self.types[c]
            o_raw = self._typed(c, F.col(c)) if c in self.old_cols else F.lit(None).cast(t)
            o_dec = self._decoded(c, o_raw)
            n_raw = self._typed(c, F.col(c)) if c in self.new_cols else F.lit(None).cast(t)
            if c in self.old_cols:
                o_sel += [self.fmt(c, o_raw).alias(f"of__{c}"), canon(self.fmt(c, o_dec), t).alias(f"oc__{c}")]
            if c in self.new_cols:
                n_fmt = self.fmt(c, n_raw)
                if t == "double":
                    n_keep = n_fmt.isNotNull() & ~F.isnan(n_fmt)
                else:
                    n_keep = n_fmt.isNotNull() & ~strip(n_fmt).isin("", *NAN_WORDS)
                n_sel += [n_raw.alias(f"n__{c}"), n_fmt.alias(f"nf__{c}"), canon(n_fmt, t).alias(f"nc__{c}"),
                          n_keep.alias(f"nk__{c}")]
            if c in self.identity:
                num = t == "double"
                if c in self.old_cols:
                    o_sel += [canon(o_dec, t).alias(f"ocr__{c}"),
                              F.when(~_simple_blank(o_dec, num), user_id_lookup(spec, o_dec.cast("string")))
                              .alias(f"orid__{c}")]
                if c in self.new_cols:
                    n_sel += [canon(n_raw, t).alias(f"ncr__{c}"),
                              F.when(~_simple_blank(n_raw, num), user_id_lookup(spec, n_raw.cast("string")))
                              .alias(f"ngid__{c}")]
        if self.has_access_col:
            o_sel.append(parse_id_list(F.col(spec.access_column)).alias("__have"))
        self.joined = old.select(*o_sel).join(new.select(*n_sel), "__k", "full_outer")

    # -- per-field pieces ---------------------------------------------------
    def _typed(self, c: str, x: Column) -> Column:
        return x.cast("double") if self.types[c] == "double" else x.cast("string")

    def _decoded(self, c: str, x: Column) -> Column:
        f = self.spec.field(c)
        if f is not None and f.dropdown and self.types[c] == "string":
            return dropdown_value(x)
        return x

    def _col(self, name: str, c: str, side_cols) -> Column:
        return F.col(f"{name}__{c}") if c in side_cols else F.lit(None).cast(
            "boolean" if name == "nk" else ("string" if name in ("oc", "nc", "ocr", "ncr", "orid", "ngid")
                                            else self.types[c]))

    def fmt(self, c: str, x: Column) -> Column:
        f = self.spec.field(c)
        if f is None or not f.format_float:
            return x
        if self.types[c] == "double":
            return round3(x)
        # Only text in number form is parsed; the guard keeps '5d' and '1_000' as they are.
        num = F.when(strip(x).rlike(PLAIN_NUMBER), strip(x).try_cast("double"))
        return F.when(num.isNotNull() & ~F.isnan(num), float_text(F.round(num, 3))).otherwise(x)

    def changed(self, c: str) -> Column:
        return ~self._col("oc", c, self.old_cols).eqNullSafe(self._col("nc", c, self.new_cols))

    # -- stages -------------------------------------------------------------
    def frame(self) -> DataFrame:
        in_old = F.coalesce(F.col("__in_old"), F.lit(False))
        in_new = F.coalesce(F.col("__in_new"), F.lit(False))
        checked = [c for c in self.spec.checked if c in self.value_cols]
        flags = self.joined.withColumns({f"ch__{c}": self.changed(c) for c in self.value_cols})
        changed_names = F.filter(F.array(*[F.when(F.col(f"ch__{c}"), F.lit(c)) for c in checked]),
                                 lambda x: x.isNotNull()) if checked else F.array().cast("array<string>")
        pre = (F.when(in_new & ~in_old, F.lit("add"))
               .when(in_old & ~in_new, F.lit("delete"))
               .when(F.size("__changed") > 0, F.lit("update"))
               .otherwise(F.lit("")))
        return (flags
                .withColumn("__both", in_old & in_new)
                .withColumn("__changed", changed_names)
                .withColumn("__pre", pre))

    def field_diff(self) -> DataFrame:
        f = self.frame().where("__both")
        return (f.where(F.size("__changed") > 0)
                .select(F.col("__k").alias(self.spec.key),
                        F.array_join("__changed", ",").alias("changed_fields"),
                        F.size("__changed").cast("bigint").alias("n_changed")))

    def actions(self) -> DataFrame:
        f = self.frame()
        return f.select(F.col("__k").alias(self.spec.key),
                        F.when(F.col("__pre") == "", F.lit("none")).otherwise(F.col("__pre")).alias("action"))

    def result(self, stage: str = "final") -> DataFrame:
        spec = self.spec
        f = self.frame()
        act = F.col("__pre")
        checked = [c for c in spec.checked if c in self.value_cols]
        nf = {c: self._col("nf", c, self.new_cols) for c in self.value_cols}
        values = {c: (F.when(act == "add", nf[c])
                      .when(act == "update", F.when(F.col(f"ch__{c}"), nf[c]))
                      .when(act == "delete", self._col("of", c, self.old_cols)))
                  for c in self.value_cols}

        admins = F.array(*[F.lit(str(a)) for a in spec.admin_ids]).cast("array<string>")
        empty = F.array().cast("array<string>")
        if spec.item_level_access:
            grants = [self._col("ngid", c, self.new_cols) for c in self.identity]
            revokes = [F.when(~self._col("ocr", c, self.old_cols).eqNullSafe(self._col("ncr", c, self.new_cols)),
                              self._col("orid", c, self.old_cols)) for c in self.identity]
            add_l = F.array_distinct(F.filter(F.array(*grants).cast("array<string>"), lambda x: x.isNotNull())) \
                if grants else empty
            rem_l = F.array_distinct(F.filter(F.array(*revokes).cast("array<string>"), lambda x: x.isNotNull())) \
                if revokes else empty
            with_admins = F.concat(add_l, admins)
            if self.has_access_col:
                add_common = F.array_sort(F.array_except(with_admins, F.col("__have")))
                rem_common = F.array_sort(F.array_intersect(rem_l, F.col("__have")))
            else:
                add_common, rem_common = with_admins, rem_l
            f = (f.withColumn("__add", F.when(F.col("__both"), add_common).when(act == "add", admins).otherwise(empty))
                  .withColumn("__rem", F.when(F.col("__both"), rem_common).otherwise(empty)))
            # NaN is no value to send
            data_changed = _any(F.col(f"ch__{c}") & nf[c].isNotNull() & (~F.isnan(nf[c]) if self.types[c] == "double" else F.lit(True))
                                for c in checked)
            cancel = (act == "update") & (F.size("__add") == 0) & (F.size("__rem") == 0) & ~data_changed
        else:
            f = f.withColumn("__add", empty).withColumn("__rem", empty)
            kept = _any(F.col(f"ch__{c}") & F.coalesce(self._col("nk", c, self.new_cols), F.lit(False))
                        for c in checked)
            cancel = (act == "update") & ~kept
        f = f.withColumn("action", F.when(cancel, F.lit("")).otherwise(act)).where(F.col("action") != "")
        if stage == "access":
            return f.select(F.col("__k").alias(spec.key), "action",
                            F.array_join("__add", "; ").alias("add_user_ids"),
                            F.array_join("__rem", "; ").alias("remove_user_ids"))

        out = {}
        for c in self.value_cols:
            out[c] = nan_to_empty(values[c]) if self.types[c] == "string" else values[c]
        # Owner fields refilled from the desired side wherever it has a value.
        for c in spec.refill_columns:
            if c in self.value_cols:
                out[c] = F.coalesce(self._col("n", c, self.new_cols), out[c])
        f = f.withColumns({f"r__{c}": e for c, e in out.items()})
        # Final grants = earlier grants + ids of the owner names + admins.
        names = [F.split(F.coalesce(F.col(f"r__{c}").cast("string"), F.lit("")), "[,;]")
                 for c in spec.refill_columns if c in self.value_cols]
        if names:
            ids = F.transform(F.filter(F.transform(F.flatten(F.array(*names)), lambda t: strip(t)),
                                       lambda t: t != ""),
                              lambda t: user_id_lookup(spec, t))
            owner_ids = F.filter(ids, lambda x: x.isNotNull())
        else:
            owner_ids = empty
        final_add = F.array_sort(F.array_distinct(F.concat("__add", owner_ids, admins)))
        return f.select(
            F.col("__k").alias(spec.key),
            F.col("__item_id").cast("bigint").alias(spec.item_id),
            *[F.col(f"r__{c}").alias(c) for c in self.value_cols],
            "action",
            F.array_join(final_add, "; ").alias("add_user_ids"),
            F.array_join("__rem", "; ").alias("remove_user_ids"),
            F.array_join("__add", "; ").alias(spec.access_column),
        )


def change_set(existing: DataFrame, desired: DataFrame, spec: ListSpec) -> DataFrame:
    """Typed change set (add / update / delete) with access columns."""
    return ChangeSet(existing, desired, spec).result()


def field_diff(existing: DataFrame, desired: DataFrame, spec: ListSpec) -> DataFrame:
    """Checked fields that differ, per key present on both sides."""
    return ChangeSet(existing, desired, spec).field_diff()


def change_actions(existing: DataFrame, desired: DataFrame, spec: ListSpec) -> DataFrame:
    """Action per key before empty updates are cancelled ('none' when unchanged)."""
    return ChangeSet(existing, desired, spec).actions()


def access_delta(existing: DataFrame, desired: DataFrame, spec: ListSpec) -> DataFrame:
    """Effective grant / revoke ids per kept row."""
    return ChangeSet(existing, desired, spec).result(stage="access")


def action_summary(changes: DataFrame) -> DataFrame:
    """Rows per action."""
    return changes.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))
