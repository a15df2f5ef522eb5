"""Substring dedup by recompression (operator 12).

Words become symbols.  A round replaces each run of one symbol by a symbol for (symbol, length), then each pair whose first symbol
is a left one and whose second is a right one by a symbol for the pair.  Names and sides are functions of content alone, so all
tasks name alike without a table of names, and equal substrings get the same symbols except at their borders, where a run or a pair
may reach outside.

A window of ``size`` words is named by what no context can change: per round its outermost runs and then, where its first symbol is
a right one or its last a left one, that symbol are taken off; the rest consists of symbols that every occurrence of the window
shares, and the next round goes on with them until nothing is left.  The taken-off symbols, outside in, spell the window: two
windows have one name if and only if they have the same words, whatever surrounds them.

Names have 128 bits, of which a window's bucket and 64 bits are kept.  Blocks of documents send each name once per bucket, with
the least document that holds it there, so a passage that a third of all documents share is one entry a block.  A bucket finds the
names that a smaller document holds too and sends back the places.  Places of a document become ranges, and its text is read again
to drop them.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, batches, spark_schema, stage

#: Fixed value of the contract.
WINDOW = 13
#: Windows that a task names at once, and characters of text that a bucket stands for (about 4 million windows).
BLOCK, BUCKET_CHARS = 1 << 19, 27_000_000
#: Words of a text that are named at once; longer texts go on with an overlap, as a window's name does not depend on the rest.
PIECE = 1 << 18
#: Windows that are named in one go.
SLICE = 1 << 16
#: Names that are sorted in one go.
SORTED = 1 << 18

_MIX = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], np.uint64)
_TURN = np.array([[0xBF58476D1CE4E5B9], [0x94D049BB133111EB]], np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the sequence (a, b), in two lanes of 64 bits."""
    h = a * _TURN
    h += b
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(run of each place, start and end of each run, symbols with runs replaced)."""
    fresh = np.ones(symbols.shape[1], bool)
    fresh[1:] = (symbols[:, 1:] != symbols[:, :-1]).any(axis=0)
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], symbols.shape[1]) - 1
    out = symbols[:, start]
    long = np.flatnonzero(end > start)
    if len(long):
        out[:, long] = _mix(out[:, long], (end - start + 1)[long].astype(np.uint64))
    return np.cumsum(fresh) - 1, start, end, out


def left_side(symbols: np.ndarray, step: int) -> np.ndarray:
    """Whether a symbol is a left one in this round."""
    return (symbols[0] >> np.uint64(step + 7)) & np.uint64(1) == 1


def pairs(symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(new place of each place, symbols with pairs replaced)."""
    first = np.zeros(symbols.shape[1], bool)
    first[:-1] = left[:-1] & ~left[1:]
    stay = np.ones(symbols.shape[1], bool)
    stay[1:] = ~first[:-1]
    out = symbols.copy()
    at = np.flatnonzero(first)
    out[:, at] = _mix(symbols[:, at], symbols[:, at + 1])
    return np.cumsum(stay) - 1, out[:, stay]


def _spell(h: np.ndarray, symbols: np.ndarray, at: np.ndarray, tag) -> np.ndarray:
    """Names of what was spelled so far followed by the symbols at ``at``, each with a number (its length in the window, or step)."""
    x = symbols[:, at]
    x += np.asarray(tag, np.uint64) * _TURN
    x ^= h
    x *= _MIX
    x ^= x >> np.uint64(31)
    return x


def window_names(symbols: np.ndarray, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """(2, windows): the name of each window of ``size`` symbols that begins at one of ``starts``."""
    names = np.zeros((2, len(starts)), np.uint64)
    open_, h = np.arange(len(starts)), names.copy()  # windows with symbols left, and what they spelled so far
    a, b = starts, starts + size - 1
    step = 0
    while len(open_):
        run, begin, end, symbols_up = runs(symbols)
        ra, rb = run[a], run[b]
        h = _spell(h, symbols, a, np.minimum(end[ra], b) - a + 1)
        h = _spell(h, symbols, b, b - np.maximum(begin[rb], a) + 1)
        more = rb - ra > 1
        names[:, open_[~more]] = h[:, ~more]
        open_, h, a, b, symbols = open_[more], h[:, more], ra[more] + 1, rb[more] - 1, symbols_up
        left = left_side(symbols, step)
        off = np.flatnonzero(~left[a])
        h[:, off] = _spell(h[:, off], symbols, a[off], 2 * step + 101)
        a[off] += 1
        off = np.flatnonzero(left[b] & (b >= a))
        h[:, off] = _spell(h[:, off], symbols, b[off], 2 * step + 102)
        b[off] -= 1
        more = a <= b
        names[:, open_[~more]] = h[:, ~more]
        place, symbols = pairs(symbols, left)
        open_, h, a, b = open_[more], h[:, more], place[a[more]], place[b[more]]
        step += 1
    return names


class Words(dict):
    """Numbers of distinct words, given as they come; ``symbols`` are their 128-bit names."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def symbols(self) -> np.ndarray:
        raw = b"".join(map(xxhash.xxh3_128_digest, self))
        return np.frombuffer(raw, "<u8").reshape(-1, 2).T.copy()


def _pack(values: np.ndarray, dtype: str) -> bytes:
    """Differences of ``values`` with their bytes sorted by rank, which the shuffle's compression shrinks well."""
    d = np.diff(values.astype(dtype), prepend=np.zeros(1, dtype))
    return d.view(np.uint8).reshape(-1, d.itemsize).T.tobytes()


def _unpack(raw, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel(), dtype=dtype)


# What travels between tasks: the first words of windows, packed for many documents; for each run of windows of one document its
# key, the hash of its text, and how many.  Towards a bucket the windows' names go along (bucket -1 - n: already known to be
# repeated); back from it windows are dealt to slots, each for some of the documents.
_PACKED = [("docs", pa.binary()), ("texts", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())]
SENT = pa.schema([("bucket", pa.int64()), ("names", pa.binary()), *_PACKED])
FOUND = pa.schema([("slot", pa.int64()), *_PACKED])
RANGES = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("borders", pa.list_(pa.int64()))])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """First place of each run of equal rows."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(fresh)


def _packed(docs: np.ndarray, texts: np.ndarray, run: np.ndarray, places: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Windows of the documents numbered in ``run``."""
    first = _changes(run)
    at = run[first]
    return _pack(docs[at], "<i8"), texts[at].tobytes(), _pack(np.diff(np.append(first, len(run))), "<u4"), _pack(places, "<u4")


def _raw(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """Values of a binary column, copied once."""
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in column])


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(docs, texts, run, places) of many rows."""
    many = lambda name, dtype: np.concatenate([_unpack(x.as_buffer(), dtype) for x in rows.column(name)])
    docs = many("docs", "<i8")
    return docs, _raw(rows.column("texts"), "<i8"), np.repeat(np.arange(len(docs), dtype=np.int32), many("counts", "<u4")), many("places", "<u4")


def _least(names: np.ndarray, docs: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Whether a smaller document holds the same name; ``more`` tells names apart that agree in their 64 bits."""
    out = np.empty(len(names), bool)
    for part in _by_first_bits(names):  # slices keep the work space small; equal names are in one slice
        order = part[np.argsort(names[part])]
        mine = docs[order]
        first = _changes(names[order], *(m[order] for m in more))
        out[order] = mine > np.repeat(np.minimum.reduceat(mine, first), np.diff(np.append(first, len(mine))))
    return out


def _by_first_bits(names: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the names, about ``SORTED`` at once: those whose first bits agree."""
    bits = min(8, (len(names) // SORTED).bit_length())
    if not bits:
        yield np.arange(len(names))
        return
    lead = (names.view(np.uint8)[7::8] if sys.byteorder == "little" else names.view(np.uint8)[::8]) >> np.uint8(8 - bits)
    for value in range(1 << bits):
        part = np.flatnonzero(lead == value)
        if len(part):
            yield part


def _block(words: Words, ids: list[np.ndarray], docs: list[int], texts: list[int], offsets: list[int], buckets: int,
           size: int) -> Iterator[tuple]:
    """Rows to send for the pieces of one block."""
    lengths = np.array([len(x) for x in ids])
    windows = lengths - size + 1
    piece = np.repeat(np.arange(len(ids), dtype=np.int32), windows)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(np.cumsum(lengths) - lengths, windows) + place
    place = (place + np.repeat(np.array(offsets), windows)).astype(np.uint32)
    symbols, ids = words.symbols(), np.concatenate(ids)
    names, bucket = np.empty(len(piece), np.uint64), np.empty(len(piece), np.min_scalar_type(buckets))
    for at in range(0, len(starts), SLICE):  # slices keep the work space small; no name depends on where a slice ends
        part = starts[at : at + SLICE]
        names[at : at + SLICE], other = window_names(symbols[:, ids[part[0] : part[-1] + size]], part - part[0], size)
        bucket[at : at + SLICE] = other % np.uint64(buckets)
    del starts, symbols, ids
    docs, texts = np.array(docs, np.int64), np.array(texts, np.int64)
    # Of equal names the one of the least document goes out, with its repeats in that document, which share its fate.
    repeat = _least(names, docs[piece], bucket)
    mine = np.flatnonzero(~repeat)
    mine = mine[np.argsort(bucket[mine], kind="stable")]
    parts = [(-1 - (docs[0] ^ texts[0]) % buckets, np.flatnonzero(repeat))] + [(int(bucket[p[0]]), p) for p in np.split(mine, _changes(bucket[mine])[1:])]
    for to, part in parts:
        if len(part):
            yield int(to), names[part].tobytes() if to >= 0 else b"", *_packed(docs, texts, piece[part], place[part])


def _name_blocks(buckets: int, size: int, block: int, piece: int):
    """Function for mapInArrow: (doc, text hash, text) to rows of ``SENT``."""
    from podelta.llm.common import to_batch

    def run(it) -> Iterator[pa.RecordBatch]:
        words, ids, docs, texts, offsets, held = Words(), [], [], [], [], 0
        for batch in it:
            for at in range(batch.num_rows):
                split = (batch.column(2)[at].as_py() or "").encode("utf-8", "surrogatepass").split()  # bytes.split knows ASCII space only
                doc, text = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                for start in range(0, len(split) - size + 1, piece):
                    part = split[start : start + piece + size - 1]
                    ids.append(np.fromiter(map(words.__getitem__, part), np.int32, len(part)))
                    docs.append(doc), texts.append(text), offsets.append(start)
                    held += len(part)
                    if held >= block:
                        for row in _block(words, ids, docs, texts, offsets, buckets, size):
                            yield to_batch([row], SENT)
                        words, ids, docs, texts, offsets, held = Words(), [], [], [], [], 0
        if ids:
            for row in _block(words, ids, docs, texts, offsets, buckets, size):
                yield to_batch([row], SENT)

    return run


def _find(slots: int):
    """Function for applyInArrow: the windows of one bucket whose name a smaller document holds too, dealt to slots."""
    from podelta.llm.common import to_batch

    def run(group: pa.Table) -> pa.Table:
        docs, texts, at, places = _unpacked(group)
        if group.column("bucket")[0].as_py() >= 0:
            rank = np.unique(docs, return_inverse=True)[1].astype(np.int32)
            hit = _least(_raw(group.column("names"), "<u8"), rank[at])
            places, at = places[hit], at[hit]
        slot = ((docs ^ texts).view(np.uint64) % np.uint64(slots)).astype(np.int64)[at]
        order = np.argsort(slot, kind="stable")
        rows = [(int(slot[p[0]]), *_packed(docs, texts, at[p], places[p])) for p in np.split(order, _changes(slot[order])[1:]) if len(p)]
        return pa.Table.from_batches([to_batch(rows, FOUND)] if rows else [], FOUND)

    return run


def _ranges(size: int):
    """Function for applyInArrow: word ranges that the windows of a slot's documents cover."""

    def run(group: pa.Table) -> pa.Table:
        docs, texts, at, places = _unpacked(group)
        order = np.lexsort((places, texts[at], docs[at]))
        docs, texts, places = docs[at][order], texts[at][order], places[order].astype(np.int64)
        new = np.zeros(len(docs), bool)
        new[_changes(docs, texts)] = True
        first = np.flatnonzero(new | np.append(False, np.diff(places) > size))
        borders = np.ravel([places[first], places[np.append(first[1:], len(places)) - 1] + size], order="F")
        lead = np.flatnonzero(new[first])  # ranges at which a document begins
        offsets = np.append(2 * lead, len(borders)).astype(np.int32)
        return pa.Table.from_arrays([pa.array(docs[first[lead]]), pa.array(texts[first[lead]]), pa.ListArray.from_arrays(offsets, borders)],
                                    schema=RANGES)

    return run


def covered(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, block: int = BLOCK,
            bucket_chars: int = BUCKET_CHARS, piece: int = PIECE) -> DataFrame:
    """(doc, text_hash, borders): word ranges [b0, b1), [b2, b3), ... covered by windows that also start in a smaller document."""
    read = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    chars = read.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // bucket_chars))
    sent = read.mapInArrow(_name_blocks(buckets, size, block, piece), spark_schema(SENT))
    found = sent.groupBy("bucket").applyInArrow(_find(buckets), spark_schema(FOUND))
    return found.groupBy("slot").applyInArrow(_ranges(size), spark_schema(RANGES))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, block: int = BLOCK,
          bucket_chars: int = BUCKET_CHARS, piece: int = PIECE) -> DataFrame:
    """(key, n_words, n_removed, kept): texts without the words covered by a window that also starts in a smaller document.

    ``key`` is an integer column.  A word is a run of characters that are no ASCII white space; kept words are joined by one space.
    Windows are judged on the input.  Every input row gives one row.  Null and empty texts have no words; texts shorter than a window
    lose none.  A null key is neither smaller nor larger than another, so its row loses no words and takes none from others.  Rows of
    one key take nothing from one another; repeated rows have equal results.  An empty table gives no rows.  Texts of any length are
    named in pieces.  Other columns are neither read nor returned.
    """
    ranges = stage(covered(docs, key, text, size, block, bucket_chars, piece), "ranges")
    schema = arrow_schema(docs, key, n_words=pa.int64(), n_removed=pa.int64(), kept=pa.string())

    def rows(k, t, borders) -> Iterator[tuple]:
        words = (t or "").encode("utf-8", "surrogatepass").split()
        n, kept = len(words), words
        if borders:
            inside = [0, *borders, n]
            kept = [w for a, b in zip(inside[::2], inside[1::2]) for w in words[a:b]]
        yield k, n, n - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")

    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(key).cast("long").alias("doc"),
                       F.xxhash64(text).alias("hash"))
    joined = read.join(ranges.withColumnRenamed("doc", "d"), (F.col("doc") == F.col("d")) & (F.col("hash") == F.col("text_hash")), "left")
    return joined.select("key", "text", "borders").mapInArrow(batches(rows, schema, 256), spark_schema(schema))
