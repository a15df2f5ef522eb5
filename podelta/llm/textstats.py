"""Statistics of one whole text, shared by the quality rules and the quality classifier."""

from __future__ import annotations

import numpy as np

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def words_of(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` cuts at space and 0x09-0x0D only."""
    return raw.split()


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Number of words that lie in a window of ``size`` words which the text holds twice or more.

    Exact: windows are compared through dense ids, built up by pairing neighbours, never through hashes.
    """
    n = len(words)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    base = len(ids)
    if base == n:
        return 0
    run = w
    for k in range(1, size):
        _, run, counts = np.unique(run[: n - k] * base + w[k:], return_inverse=True, return_counts=True)
        if len(counts) == len(run):
            return 0
    twice = counts[run] > 1
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines (split at \\n) that hold a word and equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def count_of(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))
