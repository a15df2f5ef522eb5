"""Quality rules by compression bands (operator 2).

A text is compressed with zstandard, once whole and once in fixed chunks.  The ratio compressed / raw bytes of normal prose
falls with length, so each length band has its own lower limit (below: repetitive) and upper limit (above: incompressible).
Fixed word rules come first; a text that fails them is rejected whatever its ratios are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from podelta.llm.common import arrow_schema, batches, spark_schema
from podelta.llm.textstats import SYMBOLS, SPACE, count_of, duplicate_lines, repeated_words, words_of

#: (raw bytes from, lowest ratio, highest ratio).  Texts below the first band are judged by the word rules only.
#: Limits come from labelled texts that are not held out (crc32 of the id mod 5 not 0), length by length.  The lower ones lie
#: just under the least ratio of good texts, between them and those of bad ones where there are enough.  The upper ones lie
#: between good texts and noise of that length; under 96 bytes both are stored as they are (prose up to 1.14, noise from 1.09),
#: so there no ratio tells them apart.
BANDS = (
    (64, 0.70, 1.60),
    (96, 0.65, 1.01),
    (128, 0.62, 0.925),
    (192, 0.58, 0.865),
    (256, 0.54, 0.82),
    (384, 0.52, 0.765),
    (512, 0.51, 0.725),
    (768, 0.49, 0.69),
    (1024, 0.46, 0.65),
    (2048, 0.44, 0.65),
    (4096, 0.42, 0.65),
    (8192, 0.405, 0.65),
    (16384, 0.39, 0.65),
    (131072, 0.34, 0.65),
)
CHUNK_BYTES = 4096
LEAST_CHUNK = 256  # a shorter rest is not judged on its own
MAX_BAD_CHUNKS = 0.2  # share of judged chunks out of band that rejects a text
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def band(n: int, bands=BANDS) -> tuple[float, float] | None:
    """Limits for a raw length of ``n`` bytes."""
    found = None
    for start, low, high in bands:
        if n >= start:
            found = (low, high)
    return found


def judge(raw: bytes, compressor, bands=BANDS, chunk: int = CHUNK_BYTES, share: float = MAX_BAD_CHUNKS):
    """(whole ratio, chunks judged, chunks out of band, reason or None) of one text."""
    ratio = len(compressor.compress(raw)) / len(raw) if raw else None
    reason = None
    limits = band(len(raw), bands)
    if limits:
        reason = "repetitive" if ratio < limits[0] else "incompressible" if ratio > limits[1] else None
    judged = low = high = 0
    for at in range(0, len(raw), chunk):
        part = raw[at : at + chunk]
        limits = band(len(part), bands)
        if limits and len(part) >= LEAST_CHUNK:
            r = ratio if len(part) == len(raw) else len(compressor.compress(part)) / len(part)
            judged, low, high = judged + 1, low + (r < limits[0]), high + (r > limits[1])
    if reason is None and judged and low + high > share * judged:
        reason = "repetitive chunks" if low >= high else "incompressible chunks"
    return ratio, judged, low + high, reason


def _assess(compressor, key, text) -> Iterator[tuple]:
    raw = (text or "").encode()
    words = words_of(raw)
    n, repeat = len(words), repeated_words(words)
    spaces = count_of(raw, SPACE)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    ratio, judged, bad, reason = judge(raw, compressor)
    yield (key, n, len(text or "") - spaces, count_of(raw, SYMBOLS), duplicate_lines(raw), repeat, failed,
           not failed and reason is None, ratio, judged, bad, "words" if failed else reason)


KEPT = 7  # place of the verdict in a row of _assess


def compressor():
    """One per task: it holds memory and cannot be sent."""
    return zstandard.ZstdCompressor(level=LEVEL)


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: word counts, base rule, ratios and verdict.

    Null text counts as empty: no words, rejected by the word rule, ratio null.  Null keys stay.  Repeated rows are judged
    one by one.  An empty table gives no rows.  Other columns are neither read nor returned.
    """
    schema = arrow_schema(docs, key, n_words=pa.int64(), word_chars=pa.int64(), n_symbols=pa.int64(),
                          n_dup_lines=pa.int64(), n_repeat_words=pa.int64(), base_failed=pa.bool_(), kept=pa.bool_(),
                          ratio=pa.float64(), n_chunks=pa.int32(), n_bad_chunks=pa.int32(), reason=pa.string())

    def run(it):
        yield from batches(partial(_assess, compressor()), schema)(it)

    return docs.select(key, text).mapInArrow(run, spark_schema(schema))


def _verdicts(it, text_at: int):
    used = compressor()
    for batch in it:
        kept = [next(_assess(used, None, t))[KEPT] for t in batch.column(text_at).to_pylist()]
        yield batch.filter(pa.array(kept, pa.bool_()))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text the rules keep, all columns unchanged (no join, so repeated keys cannot multiply)."""
    at = docs.columns.index(text)
    return docs.mapInArrow(lambda it: _verdicts(it, at), docs.schema)
