"""Scalar operators as ``Column -> Column`` builders.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; there is no Python UDF in the library.  ANSI mode stays on, so
every parse uses a ``try_*`` form or is guarded by a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podelta.config import BLANK_WORDS, NAN_WORDS

# Text that Python's float() accepts (after stripping): digits with single
# underscores between them, optional fraction / exponent, or inf / nan words.
_DIGITS = r"\d(?:_?\d)*"
PY_FLOAT_PATTERN = (
    rf"^[+-]?(?:(?:(?:{_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)
PY_NAN_PATTERN = r"^[+-]?(?i:nan)$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Whitespace that Python's str.strip() removes (ASCII and Latin-1 range).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (no regex)."""
    return F.trim(col_(c), F.lit(WHITESPACE))


def text(c) -> Column:
    return col_(c).cast("string")


# P1 / P2 -------------------------------------------------------------------
def first_token(c, sep: str = " ") -> Column:
    """First part of ``c`` split on ``sep`` (vendor id from a vendor name)."""
    return F.element_at(F.split(col_(c), sep), 1)


def after_first_token(c, sep: str = " ") -> Column:
    """Everything after the first ``sep``; NULL when there is none."""
    return F.try_element_at(F.split(col_(c), sep, 2), F.lit(2))


# P4 ------------------------------------------------------------------------
def normalize_line_id(c) -> Column:
    """Text form of a line id: '' -> '0', trailing '.0' dropped, NULL -> 'nan'."""
    s = text(c)
    return (F.when(s.isNull(), F.lit("nan"))
            .when(s == "", F.lit("0"))
            .otherwise(F.regexp_replace(s, r"\.0$", "")))


# P5 ------------------------------------------------------------------------
def concat_key(*cols, sep: str | None = None) -> Column:
    """Composite key.  Without ``sep`` any NULL part makes the key NULL."""
    parts = [text(c) for c in cols]
    if sep is None:
        return F.concat(*parts)
    return F.concat_ws(sep, *[F.coalesce(p, F.lit("nan")) for p in parts])


# P6 ------------------------------------------------------------------------
def membership_label(c, values, label: str) -> Column:
    return F.when(col_(c).isin(list(values)), F.lit(label)).otherwise(F.lit(""))


# P7 ------------------------------------------------------------------------
def strip_numeric_prefix(c) -> Column:
    """'1 | Awaiting Release' -> 'Awaiting Release'."""
    return F.regexp_replace(col_(c), r"^\d+\s*\|?\s*", "")


# P8 ------------------------------------------------------------------------
def int_or_zero(c) -> Column:
    """Numeric text -> integer (truncated); anything else -> 0."""
    s = strip(text(c))
    num = F.regexp_replace(s, "_", "").try_cast("double")
    as_long = F.when(F.abs(num) < 9.2e18, num.cast("long"))
    ok = s.rlike(PY_FLOAT_PATTERN) & ~s.rlike(PY_NAN_PATTERN)
    return F.when(ok, F.coalesce(as_long, F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))


# P3 / P9 -------------------------------------------------------------------
def to_date_or_null(c, fmt: str | None = None) -> Column:
    if fmt is None:
        return col_(c).try_cast("date")
    return F.to_date(F.try_to_timestamp(text(c), F.lit(fmt)))


def date_text(c) -> Column:
    """Date as 'yyyy-MM-dd' text; NULL stays NULL."""
    return F.date_format(col_(c), "yyyy-MM-dd")


# P10 -----------------------------------------------------------------------
def dropdown_value(c) -> Column:
    """JSON object text with a ``Value`` key -> that value; anything else unchanged."""
    s = text(c)
    # Only text that starts like an object is handed to the JSON parser.
    looks_like_object = F.ltrim(s).startswith("{")
    has_value = F.coalesce(F.array_contains(F.json_object_keys(s), "Value"), F.lit(False))
    return F.when(~looks_like_object, s).when(has_value, F.get_json_object(s, "$.Value")).otherwise(s)


# P11 -----------------------------------------------------------------------
_LITERAL_DICT = r"^\s*\{.*?(['\"])Value\1\s*:\s*(['\"])(.*?)\2\s*[,}]"


def literal_dict_value(c) -> Column:
    """Python-literal dict text ``{'Value': 'Yes', ...}`` -> ``Yes``; else unchanged."""
    s = text(c)
    return F.when(s.rlike(_LITERAL_DICT), F.regexp_extract(s, _LITERAL_DICT, 3)).otherwise(s)


# P12 -----------------------------------------------------------------------
def blank_to_zero(c, target: str | None = None) -> Column:
    """Blank -> 0.  ``target`` is the numeric type of a text column; text that is no number becomes NULL."""
    s = col_(c)
    blank = s.isNull() | (strip(text(s)) == "")
    if target is None:
        return F.when(blank, F.lit(0)).otherwise(s)
    return F.when(blank, F.lit(0).cast(target)).when(strip(text(s)).rlike(PLAIN_NUMBER), strip(text(s)).try_cast(target))


# Plain decimal numbers; type suffixes ('5d') and digit separators ('1_000') are text.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def float_text(c) -> Column:
    """Text of a double without exponent from 1e-4 up to 1e16, with at least one decimal ('12345678.5', '0.0005', '5.0')."""
    d = col_(c).cast("double")
    size = F.abs(d)
    wide = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    cut = F.regexp_replace(d.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    return F.when(wide, F.when(cut.endswith("."), F.concat(cut, F.lit("0"))).otherwise(cut)).otherwise(d.cast("string"))


# P13 -----------------------------------------------------------------------
def round3(c) -> Column:
    return F.round(col_(c).cast("double"), 3)


# P14 -----------------------------------------------------------------------
def canon(c, dtype: str = "string") -> Column:
    """Canonical compare value; ``canon(a) <=> canon(b)`` is value equivalence.

    * NULL, NaN and whitespace-only text are blank -> NULL.
    * Text Python's float() accepts compares as a number ('5.0' = '5' = 5).
      The text 'nan' is not blank but matches only another 'nan'.
    * Any other text compares stripped.
    """
    x = col_(c)
    if dtype in ("double", "float"):
        return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("N:"), (x.cast("double") + F.lit(0.0)).cast("string")))
    if dtype in ("int", "bigint", "long", "smallint", "tinyint") or dtype.startswith("decimal"):
        return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("N:"), (x.cast("double") + F.lit(0.0)).cast("string")))
    s = strip(text(x))
    as_text = F.concat(F.lit("S:"), s)
    # The number is parsed in exactly one branch, behind the pattern test, so
    # no value that fails the pattern ever reaches the (exception-based)
    # string-to-double parse.
    as_number = F.concat(F.lit("N:"), (F.regexp_replace(s, "_", "").try_cast("double") + F.lit(0.0)).cast("string"))
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
            .when(~s.rlike(PY_FLOAT_PATTERN), as_text)
            .when(s.rlike(PY_NAN_PATTERN), F.lit("NAN"))
            .otherwise(F.coalesce(as_number, as_text)))


def equivalent(a, b, dtype_a: str = "string", dtype_b: str = "string") -> Column:
    return canon(a, dtype_a).eqNullSafe(canon(b, dtype_b))


# P15 / P16 -----------------------------------------------------------------
def parse_id_list(c) -> Column:
    """'8; 12,13' -> ['8', '12', '13'] (trimmed, empties dropped, first-seen order, distinct)."""
    parts = F.transform(F.split(F.coalesce(text(c), F.lit("")), "[,;]"), lambda t: strip(t))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def render_id_list(a) -> Column:
    return F.array_join(F.array_distinct(col_(a)), "; ")


def sorted_ids(a) -> Column:
    return F.array_sort(F.array_distinct(col_(a)))


# P19 / P20 -----------------------------------------------------------------
def is_blank(c) -> Column:
    """NULL, NaN, whitespace, or the words nan / none / null in any case."""
    s = col_(c)
    t = strip(text(s))
    # Lower case is no shorter than the text, so only texts as short as the words need it.
    return s.isNull() | ((F.char_length(t) <= max(map(len, BLANK_WORDS))) & F.lower(t).isin(list(BLANK_WORDS)))


def nan_to_empty(c) -> Column:
    """Output cleanup of a text column: NULL and exact 'nan' words -> ''."""
    s = col_(c)
    return F.coalesce(F.when(~s.isin(list(NAN_WORDS)), s), F.lit(""))


# P24 -----------------------------------------------------------------------
def contains_ci(c, needle: str) -> Column:
    return F.coalesce(F.lower(col_(c)).contains(needle.lower()), F.lit(False))


# P25 -----------------------------------------------------------------------
def path_for(c, base: str, suffix: str) -> Column:
    return F.concat(F.lit(base), text(c), F.lit(suffix))
