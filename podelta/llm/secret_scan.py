"""Secret scan (operator 1): keyword automaton, anchored expressions near hits, checksum validation.

One Aho-Corasick pass over a text finds keyword hits; expressions are only tried at those places, anchored there.  Long hex
runs have no keyword of their own, so the text's hex digits are mapped to one class symbol and the keyword is a row of 32
of these.  Tokens that carry a checksum (a CRC32 in base 62 behind the random part) count only if it fits.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, batches, spark_schema

#: Base kinds in the order in which they are listed, then the kinds with a checksum.
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("checked",)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
CHECKED_RANDOM, CHECKED_SUM = 30, 6
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

# On the lower-cased text, where ASCII letters match in either case.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_CHECKED = re.compile(r"[a-z]{3}_([A-Za-z0-9]{%d})([A-Za-z0-9]{%d})(?![A-Za-z0-9])" % (CHECKED_RANDOM, CHECKED_SUM))

_CLASSES = bytes(ord("h") if c in b"0123456789abcdef" else ord(" ") for c in range(256))
_HEX_KEYWORD = b"h" * MIN_HEX
_automata: dict = {}


def keyword_automaton():
    """Automaton over the lower-cased keywords; values are (kind, length)."""
    if not _automata:
        a = ahocorasick.Automaton()
        for w in ASSIGN_WORDS:
            a.add_word(w, ("assign", len(w)))
        a.add_word("akia", ("access", 4))
        for w in CHECKED_PREFIXES:
            a.add_word(w, ("checked", len(w)))
        a.make_automaton()
        _automata["keywords"] = a
    return _automata["keywords"]


def base62(n: int, width: int) -> str:
    digits = ""
    while n:
        n, r = divmod(n, 62)
        digits = BASE62[r] + digits
    return digits.rjust(width, "0")


def checksum_fits(random_part: str, tail: str) -> bool:
    """The tail is the CRC32 of the random part in base 62, padded with zeros."""
    return base62(zlib.crc32(random_part.encode()), len(tail)) == tail


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, code points, end exclusive, ordered by start, then kind as listed.

    Per base kind the matches are the leftmost non-overlapping ones; a match that is too short still uses up its place.
    """
    if not text:
        return []
    raw = text.encode()
    lower = raw.lower().decode()  # bytes.lower changes A-Z only, so places stay the same
    found: list[tuple[str, int, int]] = []
    used = {"assign": 0, "access": 0, "checked": 0}
    for last, (kind, n) in keyword_automaton().iter(lower):
        at = last - n + 1
        if at < used[kind]:
            continue
        if kind == "assign":
            if m := _ASSIGN.match(lower, at):
                used[kind] = m.end()
                if m.end(2) - m.start(2) >= MIN_VALUE:
                    found.append((kind, at, m.end()))
        elif kind == "access":
            if m := _ACCESS.match(text, at):
                used[kind] = m.end()
                if m.end() - at >= MIN_ACCESS:
                    found.append((kind, at, m.end()))
        elif (m := _CHECKED.match(text, at)) and checksum_fits(m[1], m[2]):
            used[kind] = m.end()
            found.append((kind, at, m.end()))
    found += _long_hex(raw, len(raw) != len(text))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _long_hex(raw: bytes, wide: bool) -> Iterator[tuple[str, int, int]]:
    classes = raw.translate(_CLASSES)
    end = 0
    while (at := classes.find(_HEX_KEYWORD, end)) >= 0:
        stop = classes.find(b" ", at)
        end = stop if stop >= 0 else len(classes)
        start = len(raw[:at].decode()) if wide else at
        yield "hex", start, start + end - at


def _rows(key, text) -> Iterator[tuple]:
    yield key, [{"kind": k, "start": s, "end": e} for k, s, e in scan(text)]


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` array<struct<kind, start, end>> for every input row.

    Null and empty texts give an empty array, null keys stay, repeated rows are scanned one by one, an empty table gives no
    rows; other columns are neither read nor returned.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = arrow_schema(docs, key, spans=pa.list_(span))
    return docs.select(key, text).mapInArrow(batches(_rows, schema), spark_schema(schema))


def render(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined, in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
