"""SentencePiece encoding and decoding by an Aho-Corasick automaton and Viterbi (operator 8).

One automaton holds all pieces.  Reading a text, it reports at each position every piece that ends there (its output links,
longest first), and each report relaxes the best score of that position, so one pass finds the best segmentation.  A
character that no piece covers falls back to its UTF-8 byte pieces.

Where no piece holds two neighbouring characters together every segmentation cuts, so the best one is the best of each
segment between such places: before a run of space marks, and between letters or digits and other signs.  The cuts are
derived from the vocabulary, and frequent segments are remembered in a bounded table.  Scores are whole numbers, so sums,
and with them ties, do not depend on where a text is cut.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from podelta.llm.common import arrow_schema, spark_schema

MARK = "▁"  # fixed value: the space mark
MEMORY = 200_000  # remembered segments per generation; a task holds two
LONGEST = 64  # characters of a remembered segment
FLUSH = 1_000_000  # pieces per result batch
ZIPF_SHIFT = 2.7
UNIT = 1_000_000  # scores count millionths of a natural logarithm
NEVER = -(10**18)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file, in a form that is small to broadcast."""

    def __init__(self, pieces: dict[str, int], scores: dict[int, int], byte_ids: list[int], size: int):
        self.pieces, self.scores, self.byte_ids, self.size = pieces, scores, byte_ids, size


def load(model_file: str, scoring: str = "zipf") -> Vocabulary:
    """Read a model file on the driver.

    ``scoring`` "model" takes the file's scores as log probabilities (unigram models).  A merge model only has ranks;
    "zipf" turns rank r into the log probability of r under Zipf's law over the vocabulary.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = sp.get_piece_size()
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(sp.is_byte(i) for i in byte_ids):
        raise ValueError("the model has no byte pieces, so texts could not be restored exactly")
    pieces = {sp.id_to_piece(i): i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    if scoring == "model":
        logs = {i: sp.get_score(i) for i in pieces.values()}
    else:
        total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in range(len(pieces))))
        logs = {i: -math.log(-sp.get_score(i) + ZIPF_SHIFT) - total for i in pieces.values()}
    return Vocabulary(pieces, {i: round(x * UNIT) for i, x in logs.items()}, byte_ids, size)


def segment_pattern(pieces) -> re.Pattern:
    """Expression whose matches tile a text and end only where no piece can reach across."""
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        return re.compile(".+", re.S)
    bridges = {"_"}
    for p in pieces:
        for x, y in zip(p, p[1:]):
            if MARK not in (x, y) and _wordly(x) != _wordly(y):
                bridges |= {x, y} - {c for c in (x, y) if not _wordly(c)}
    bridge = "".join(map(re.escape, sorted(bridges)))
    word, other = rf"[^\W{bridge}]++", rf"[^\w{MARK}{bridge}]++"
    return re.compile(f"{MARK}*+{word}(?![{bridge}])|{MARK}*+{other}(?![{bridge}])|{MARK}*+[^{MARK}]++|{MARK}++", re.S)


def _wordly(c: str) -> bool:
    return re.fullmatch(r"\w", c) is not None


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = vocabulary.byte_ids
        self.automaton = ahocorasick.Automaton()
        for piece, i in vocabulary.pieces.items():
            self.automaton.add_word(piece, (i, 1 - len(piece), vocabulary.scores[i]))
        self.automaton.make_automaton()
        self.alone = {p for p in vocabulary.pieces if len(p) == 1}
        self.byte_score = min(vocabulary.scores.values()) - 10 * UNIT
        self.segments = segment_pattern(vocabulary.pieces)
        text_of = [b""] * (vocabulary.size + 1)  # the last for ids without text
        self.length_of = [1] * vocabulary.size
        for piece, i in vocabulary.pieces.items():
            text_of[i] = piece.replace(MARK, " ").encode()
            self.length_of[i] = len(piece)
        for b, i in enumerate(self.byte_ids):
            text_of[i] = bytes([b])
        self.table = pa.array(text_of, pa.large_binary())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def viterbi(self, segment: str) -> list[int]:
        """Piece ids of best total score; of equal ones the longer last piece wins."""
        n = len(segment)
        best = [0] + [NEVER] * n
        back = [-1] * (n + 1)
        if self.alone.issuperset(segment):
            for last, (i, to_start, score) in self.automaton.iter(segment):
                s = best[last + to_start] + score
                last += 1
                if s > best[last]:
                    best[last] = s
                    back[last] = i
        else:
            at = 0
            for last, (i, to_start, score) in self.automaton.iter(segment):
                while at < last:  # no later report changes these positions
                    at += 1
                    self._fall_back(segment, at, best, back)
                s = best[last + to_start] + score
                if s > best[last + 1]:
                    best[last + 1], back[last + 1] = s, i
            while at < n:
                at += 1
                self._fall_back(segment, at, best, back)
        ids = []
        at = n
        while at:
            i = back[at]
            if i >= 0:
                ids.append(i)
                at -= self.length_of[i]
            else:
                ids += [self.byte_ids[b] for b in reversed(segment[at - 1].encode())]
                at -= 1
        ids.reverse()
        return ids

    def _fall_back(self, segment, at, best, back):
        if back[at] < 0:
            best[at] = best[at - 1] + self.byte_score * len(segment[at - 1].encode())

    def _part(self, text: str) -> list[bytes]:
        """Ids of each segment as packed integers, remembered ones looked up in one go."""
        segments = self.segments.findall(text)
        found = list(map(self.known.get, segments))
        for j, ids in enumerate(found):
            if ids is None:
                found[j] = self._learn(segments[j])
        return found

    def _learn(self, segment: str) -> bytes:
        ids = self.known.get(segment) or self.older.get(segment) or array("i", self.viterbi(segment)).tobytes()
        if len(segment) <= LONGEST:
            if len(self.known) >= MEMORY:
                self.older, self.known = self.known, {}
            self.known[segment] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the text with a space mark in front; a space mark in the text itself becomes byte pieces."""
        if not text:
            return np.empty(0, np.int32)
        out: list[bytes] = []
        for k, part in enumerate(text.split(MARK)):
            if k:
                out.append(array("i", (self.byte_ids[b] for b in MARK.encode())).tobytes())
            out += self._part((MARK if k == 0 else "") + part.replace(" ", MARK))
        return np.frombuffer(b"".join(out), np.intc)

    def decode(self, ids: pa.Array) -> list[str]:
        """Texts of an array of id lists, the inverse of ``encode``.

        Ids without text give nothing, broken byte sequences the replacement character.  Taking the pieces of all lists
        from one table puts their bytes end to end, so a text is a slice of one buffer.
        """
        flat = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        unknown = len(self.table) - 1
        taken = self.table.take(pa.array(np.where((flat < 0) | (flat > unknown), unknown, flat)))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False))])
        if not len(flat):
            return [""] * len(ids)
        places = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1)[ends]
        data = memoryview(taken.buffers()[2])
        return [str(data[a:b][1:], "utf-8", "replace") for a, b in zip(places[:-1].tolist(), places[1:].tolist())]


_codecs: dict = {}


def codec(vocabulary) -> Codec:
    """The codec of a broadcast vocabulary, built once per task."""
    if vocabulary.value not in _codecs:
        _codecs[vocabulary.value] = Codec(vocabulary.value)
    return _codecs[vocabulary.value]


def _flushed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Result batches of bounded size; a row's last value tells its weight."""
    out: list[tuple] = []
    weight = 0
    for *row, n in rows:
        out.append(row)
        weight += n + 16
        if weight >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, weight = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", scoring: str = "zipf") -> DataFrame:
    """``key`` and ``piece_ids`` array<int> per input row.

    Null and empty texts have no pieces (an empty array), null keys stay, repeated rows are encoded one by one, an empty
    table gives no rows; other columns are neither read nor returned.  The vocabulary is the only thing that is broadcast;
    its size is that of the model file.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(model_file, scoring))
    schema = arrow_schema(docs, key, piece_ids=pa.list_(pa.int32()))

    def run(it):
        c = codec(vocabulary)
        yield from _flushed(((k, ids, len(ids)) for batch in it for k, ids in (
            (k, c.encode(t)) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))), schema)

    return docs.select(key, text).mapInArrow(run, spark_schema(schema))


def decode(encoded: DataFrame, model_file: str, key: str = "doc_id", ids: str = "piece_ids", scoring: str = "zipf",
           keep_ids: bool = False) -> DataFrame:
    """``key`` and ``text`` per input row, with the ids in between if asked; null or empty id lists give the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load(model_file, scoring))
    schema = arrow_schema(encoded, key, **({ids: pa.list_(pa.int32())} if keep_ids else {}), text=pa.string())

    def run(it):
        c = codec(vocabulary)
        for batch in it:
            texts = pa.array(c.decode(batch.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *([batch.column(1).cast(schema.field(1).type)] if keep_ids else []), texts], schema=schema)

    return encoded.select(key, ids).mapInArrow(run, spark_schema(schema))
