"""Words, hashes and Arrow buffers: what several operators of this subpackage share.

Everything works on the UTF-8 bytes of a slice of rows at once, with numpy, inside Spark tasks. Words are runs of
bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes have 64 bits; equality of two of them is taken as
equality of what was hashed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
"""Bytes of text that are worked on at once; a longer text is a slice of its own."""

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20_240_607))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
EXACT_BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1 + n // 8, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            out = np.full(size, _U(base), np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0], _powers[1]


class Hashes:
    """Hashes of any ranges of a sequence of 64-bit values: equal ranges have equal hashes wherever they are."""

    def __init__(self, values: np.ndarray) -> None:
        up, _ = _power_table(len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        _, down = _power_table(len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * down[starts]
                   + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(salt))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text or binary column; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes, or of one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


class Words:
    """The words of some rows: ``starts`` and ``ends`` in the bytes, ``rows`` the first word of each row, and hashes."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, gaps: np.ndarray = SPACES) -> None:
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~gaps[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
        self.ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
        self.rows = np.searchsorted(self.starts, offsets)
        self.data = data
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = Hashes(BYTE_VALUES[self.data]).of(self.starts, self.ends)
        return self._hashes

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle of so many words; a shorter row is one shingle, an empty one none."""
    counts = np.diff(words.rows)
    per_row = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    rows = np.repeat(np.arange(len(counts)), per_row)
    first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(per_row, out=first[1:])
    starts = np.arange(len(rows)) - first[rows] + words.rows[rows]
    ends = starts + np.minimum(width, counts[rows])
    return Hashes(words.hashes).of(starts, ends, salt=width), rows


def distinct_by_row(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted by row and value, and where each row begins."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[keep], rows[keep]
    return values, np.searchsorted(rows, np.arange(n + 1))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
