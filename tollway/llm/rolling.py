"""Rolling hashes of many texts at once, on NumPy arrays over an Arrow string column.

All arithmetic is modulo 2^64. A prefix sum S of value[i] * B^i gives the hash of any stretch as
(S[end] - S[start]) * B^-start, so that every window costs a few vector operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1), kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(1 << n.bit_length(), 1 << 16), base, np.uint64)
        out[0] = 1
        have = _powers[base] = np.cumprod(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all others; one to one."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def prefix(values: np.ndarray) -> np.ndarray:
    """S, with S[0] = 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def stretch(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of [start, end) from the prefix sum s; lengths count as well."""
    h = (s[end] - s[start]) * powers(INVERSE, len(s))[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each text begins (one more at the end); null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`, once A-Z are in lower case
IS_LETTER = np.ones(256, bool)
IS_LETTER[:128] = False
IS_LETTER[48:58] = IS_LETTER[97:123] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def words(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (a run of bytes with `inside`, within one text), and the first word of each text (one more at the end)."""
    is_in = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = is_in.copy()
    starts[1:] &= ~is_in[:-1] | edge[1:-1]
    ends = is_in
    ends[:-1] &= ~is_in[1:] | edge[1:-1] if len(data) > 1 else True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, at)


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """Hashes of the stretches [start, end) of data, starts ascending; prefix sums are held for `most` bytes at once."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        base = int(start[i])
        j = int(np.searchsorted(start, base + most))
        own = data[base : int(end[i:j].max())]
        out[i:j] = stretch(prefix(BYTE_VALUES[own]), start[i:j] - base, end[i:j] - base)
        i = j
    return out


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return byte_hashes(data, start, end)


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of `size` units begins, for units numbered through texts that begin at `first`."""
    n = np.diff(first) - size + 1
    n[n < 0] = 0
    skip = np.cumsum(n) - n
    return np.repeat(first[:-1] - skip, n) + np.arange(n.sum())


def runs(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) that windows of `size` at the sorted positions `at` cover; touching runs are one."""
    if not len(at):
        return at, at
    gap = np.flatnonzero(at[1:] > at[:-1] + size)
    return at[np.r_[0, gap + 1]], at[np.r_[gap, len(at) - 1]] + size


def chunks(batches, column: str, most: int = 1 << 19):
    """Record batches cut so that their texts have about `most` bytes, but one row at least."""
    for batch in batches:
        texts_ = batch.column(column)
        size = np.diff(texts(texts_)[1])
        start = 0
        while start < len(size):
            n = max(1, int(np.searchsorted(np.cumsum(size[start : start + 100_000]), most, "right")))
            yield batch.slice(start, n)
            start += n
