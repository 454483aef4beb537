"""Words of many texts at once as 64-bit hashes, computed over their bytes in numpy."""

from __future__ import annotations

import numpy as np

#: Words are maximal runs without space and bytes 9 to 13; A-Z count as a-z.
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
ASIS = np.arange(256, dtype=np.uint64)

#: Bytes handled at once; pieces end between words.
PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


def _piece(data: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and start positions of one piece."""
    word = IS_WORD[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    power = np.cumprod(np.full(int(at.max()) + 1, BASE, np.uint64))
    value = (fold[data[starts[0]:]] + np.uint64(1)) * power[at]
    value[~word[starts[0]:]] = 0
    h = np.add.reduceat(value, starts - starts[0])
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h, starts


def word_hashes(texts: list[bytes], fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text); ``fold`` maps the bytes first."""
    flat = b"\n".join(texts)
    if not flat:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(flat, np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    hashes, starts, lo = [], [], 0
    while lo < len(data):
        hi = min(lo + PIECE, len(data))
        while hi < len(data):  # move the cut behind white space
            gap = np.flatnonzero(~IS_WORD[data[hi:hi + PIECE]])
            if len(gap):
                hi += int(gap[0]) + 1
                break
            hi = min(hi + PIECE, len(data))
        h, s = _piece(data[lo:hi], fold)
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    at = np.concatenate(starts)
    edges = np.searchsorted(at, np.append(begin, len(data) + 1))
    return np.concatenate(hashes), np.diff(edges)
