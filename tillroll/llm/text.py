"""Vectorised word work on Arrow strings: whole batches as byte arrays.

Words are maximal runs without the bytes 0x20 and 0x09-0x0D.  Each gets a
64-bit hash of its bytes (a polynomial with an odd base modulo 2**64, so that
differences of one running sum give every word's value, then mixed).
Texts are handled in blocks of about a megabyte; a longer text is cut between
words, so that memory does not grow with the longest text by more than its
word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer on 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to ``limit`` bytes together, or one longer text."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, BLOCK + 1)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    up, down = _pow(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def pieces(data: np.ndarray, limit: int = BLOCK) -> Iterator[np.ndarray]:
    """One text cut between words into pieces of about ``limit`` bytes."""
    lo, n = 0, len(data)
    while n - lo > limit:
        gaps = np.flatnonzero(SPACE[data[lo + 1:lo + limit]])
        if len(gaps):
            cut = lo + 1 + int(gaps[-1])
        else:
            after = np.flatnonzero(SPACE[data[lo + limit:]])
            if not len(after):
                break
            cut = lo + limit + int(after[0])
        yield data[lo:cut]
        lo = cut
    yield data[lo:]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, word hashes, word offsets)`` for block after block of texts.

    A-Z is lower-cased.  The offsets give each text of the block its words.
    """
    for lo, hi in blocks(offsets):
        part = LOWER[data[offsets[lo]:offsets[hi]]]
        if hi - lo == 1 and len(part) > BLOCK:
            found = []
            for piece in pieces(part):
                found.append(hash_spans(piece, *spans(~SPACE[piece])))
            words = np.concatenate(found)
            yield lo, words, np.array([0, len(words)])
            continue
        inside = ~SPACE[part]
        starts, ends = spans(inside)
        own = offsets[lo:hi + 1] - offsets[lo]
        # a word that runs over the border of two texts is cut there
        cross = own[1:-1]
        cross = cross[(cross > 0) & (cross < len(part))]
        cross = np.unique(cross[inside[cross] & inside[cross - 1]]) if len(cross) else cross
        if len(cross):
            starts = np.sort(np.concatenate([starts, cross]))
            ends = np.sort(np.concatenate([ends, cross]))
        yield lo, hash_spans(part, starts, ends), np.searchsorted(starts, own)
