"""Multi-label rule classification of order lines.

Every rule compiles to one boolean expression and the label text to one
``concat_ws``, evaluated on each line as it is read.  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podelta.config import (AUDIT_COLUMNS, LAST_LABEL, NOT_BLANK, NOTE_KINDS, NOTE_TRACKERS, TRACKER_RULES,
                            Condition, Rule)
from podelta.functions.exprs import blank_to_zero, strip


def _stripped_name(column: str) -> str:
    return f"__s_{column}"


def condition_expr(cond: Condition, columns) -> Column:
    """R1 for one condition; NULL-safe (always TRUE or FALSE).

    Reads the stripped text from ``__s_<column>`` when the frame has it
    (see ``label_lines``), so each column is stripped once per row.
    """
    if cond.column not in columns:
        return F.lit(False)
    c = F.col(cond.column)
    sname = _stripped_name(cond.column)
    stripped = F.col(sname) if sname in columns else strip(c.cast("string"))
    if tuple(cond.values) == (NOT_BLANK,):
        return c.isNotNull() & (stripped != "")
    texts = [str(v).strip() for v in cond.values if v is not None]
    match_null = any(v is None for v in cond.values)
    hit = F.coalesce(stripped.isin(texts), F.lit(False)) if texts else F.lit(False)
    return (c.isNull() | hit) if match_null else (c.isNotNull() & hit)


def rule_expr(rule: Rule, columns) -> Column:
    e = F.lit(True)
    for cond in rule.conditions:
        e = e & condition_expr(cond, columns)
    return e


def ordered_rules(rules=TRACKER_RULES, last_label: str = LAST_LABEL):
    """Rule order with ``last_label`` moved to the end.

    Moving one label behind the others when a line has several is the same
    as always evaluating its rule last, so the joined text can be built in
    a single pass.
    """
    return [r for r in rules if r.name != last_label] + [r for r in rules if r.name == last_label]


def label_text(df: DataFrame, rules=TRACKER_RULES, last_label: str = LAST_LABEL) -> Column:
    """R2 + R3: names of matching rules joined with ', ' ('' when none).

    ``concat_ws`` skips NULLs and compiles into whole-stage codegen, unlike
    array lambdas.
    """
    cols = set(df.columns)
    return F.concat_ws(", ", *[F.when(rule_expr(r, cols), F.lit(r.name)) for r in ordered_rules(rules, last_label)])


def label_lines(df: DataFrame, rules=TRACKER_RULES, keep_unlabelled: bool = False) -> DataFrame:
    """Add ``tracker`` (', '-joined labels); R4 keeps labelled lines only.

    One projection of the line itself: no job runs while the frame is built, no line moves, and each line is labelled from
    the values that are read with it.  A line is emitted for its label, if it has one, so that no later filter computes the
    label again.
    """
    texts = sorted({c.column for r in rules for c in r.conditions if c.column in df.columns})
    staged = df.withColumns({_stripped_name(c): strip(F.col(c).cast("string")) for c in texts})
    label = label_text(staged, rules)
    if not keep_unlabelled:
        label = F.explode(F.array_remove(F.array(label), F.lit("")))
    return staged.withColumn("tracker", label).drop(*map(_stripped_name, texts))


def tracker_counts(labelled: DataFrame) -> DataFrame:
    """Open lines per tracker (a line counts once for each of its labels)."""
    return (labelled.select(F.explode(F.split("tracker", ", ")).alias("tracker"))
            .groupBy("tracker").agg(F.count(F.lit(1)).alias("lines")))


def note_column_names() -> list[str]:
    """Empty note columns per tracker (snake-cased) followed by the audit columns."""
    notes = [f"sm_{t.lower()}_{k.lower()}" for t in NOTE_TRACKERS for k in NOTE_KINDS]
    return notes + list(AUDIT_COLUMNS)


def tracked_line_frame(labelled: DataFrame, quantity_cols=("quantity",)) -> DataFrame:
    """P12 + P18: blank quantities become 0 and the empty note / audit columns are added."""
    types = dict(labelled.dtypes)
    out = labelled.withColumns({c: blank_to_zero(c, "double" if types[c] == "string" else None) for c in quantity_cols
                                if c in labelled.columns})
    return out.withColumns({c: F.lit("") for c in note_column_names()})
