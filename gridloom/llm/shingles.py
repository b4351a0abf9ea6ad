"""Hashed words and word shingles of text columns, in whole arrays and without Python strings.

A word's 64-bit hash is a polynomial over random byte values modulo 2**64, read off prefix sums of
the column's bytes, then mixed. Words are runs of bytes other than space and TAB to CR (no other
byte of UTF-8 text is a separator), with A-Z lower-cased.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MIX = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(64)
_VALUES = _random.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)
#: A-Z share the values of a-z, but where the case counts.
_CASED = _VALUES.copy()
_VALUES[65:91] = _VALUES[97:123]
#: Texts longer than this have power tables of their own, which are not kept.
KEPT_POWERS = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) >= size:
        return _powers[0], _powers[1]
    made = []
    for base in (_STEP, _BACK):
        table = np.full(size, np.uint64(base), np.uint64)
        table[0] = 1
        made.append(np.cumprod(table, dtype=np.uint64))
    if size <= KEPT_POWERS:
        _powers[:] = made
    return made[0], made[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows (n + 1); nulls are empty rows."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def hashed_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; words never cross ``bounds``."""
    return word_spans(raw, bounds, _VALUES)[:2]


def cased_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (upper and lower case apart), start and end of every word."""
    return word_spans(raw, bounds, _CASED)


def word_spans(raw: np.ndarray, bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = (raw != 32) & (raw - np.uint8(9) > 4)  # below 9 it wraps around
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_tables(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX), starts, ends


def row_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a column in order, and where each row's begin (n + 1)."""
    raw, bounds = column_bytes(column)
    hashes, starts = hashed_words(raw, bounds)
    return hashes, np.searchsorted(starts, bounds)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` words, in order; with fewer words, of the whole run; of none, nothing."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total = total * MIX + hashes[k : n - width + 1 + k]
    return mixed(total + np.uint64(width))


def text_words(text: str | None) -> np.ndarray:
    return row_words(pa.array([text or ""], pa.string()))[0]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text_words(text), width))


def row_sets(column: pa.Array, width: int):
    """The shingle set of each row of a column."""
    hashes, bounds = row_words(column)
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield np.unique(shingle_hashes(hashes[start:stop], width))
