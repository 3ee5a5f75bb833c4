"""Non-decreasing whole numbers in little more space than they need: Elias-Fano code with select.

Of each number the low bits are stored as they are and the high bits as gaps in unary, so n numbers below u take about
2 + log2(u / n) bits each. ``select`` finds the k-th without a table of 64-bit places: every 64th one of the unary part
has its place as 32 bits, words are counted from there, and only where 64 ones span more than 16,384 bits are
all their places stored.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QBxxxxxxxQQQQ")
SAMPLE = 64
SPARSE = 16_384
_U = np.uint64


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, sparse: np.ndarray, places: np.ndarray) -> None:
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples, self.sparse, self.places = low, high, samples, sparse, places

    def __len__(self) -> int:
        return self.n

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """Code of non-decreasing unsigned 64-bit numbers."""
        values = np.ascontiguousarray(values, np.uint64)
        n = len(values)
        largest = int(values[-1]) if n else 0
        low_bits = max(0, (largest // max(n, 1)).bit_length() - 1)
        ones = (values >> _U(low_bits)).astype(np.int64) + np.arange(n)
        if n and int(ones[-1]) >= 1 << 32:
            raise ValueError("too many numbers for one code: places are 32 bits")
        high = _packed(ones, int(ones[-1]) + 1 if n else 0)
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & _U(1)).astype(np.uint8)
        low = _words(np.packbits(bits.reshape(-1), bitorder="little"), spare=1)
        first = ones[::SAMPLE]
        last = ones[np.minimum(np.arange(len(first)) * SAMPLE + SAMPLE - 1, max(n - 1, 0))] if n else first
        sparse = np.flatnonzero(last - first > SPARSE)
        places = ones[(sparse[:, None] * SAMPLE + np.arange(SAMPLE)).clip(max=max(n - 1, 0))] if n else np.zeros((0, SAMPLE))
        return cls(n, low_bits, low, high, first.astype(np.uint32), sparse.astype(np.uint32), places.reshape(-1).astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high), len(self.samples), len(self.sparse))
        return head + b"".join(a.astype(a.dtype.newbyteorder("<")).tobytes() for a in (self.low, self.high, self.samples, self.sparse, self.places))

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, n_low, n_high, n_samples, n_sparse = _HEAD.unpack_from(data)
        at, parts = _HEAD.size, []
        for count, kind in ((n_low, "<u8"), (n_high, "<u8"), (n_samples, "<u4"), (n_sparse, "<u4"), (n_sparse * SAMPLE, "<u4")):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The numbers at places ``k`` (from 0), as unsigned 64 bits."""
        k = np.asarray(k, np.int64)
        if len(k) and (k.min() < 0 or k.max() >= self.n):
            raise IndexError("there is no such number")
        return ((self._one(k) - k).astype(np.uint64) << _U(self.low_bits)) | self._low(k)

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), np.uint64)
        at = k * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # Shifted by one and the rest, since a shift by 64 is not defined.
        both = (self.low[word] >> shift) | ((self.low[word + 1] << _U(1)) << (_U(63) - shift))
        return both & _U((1 << self.low_bits) - 1)

    def _one(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one of the unary part."""
        out = np.zeros(len(k), np.int64)
        block, rest = k // SAMPLE, k % SAMPLE
        of = np.searchsorted(self.sparse, block)
        listed = np.zeros(len(k), bool)
        if len(self.sparse):
            listed = self.sparse[np.minimum(of, len(self.sparse) - 1)] == block
            out[listed] = self.places[of[listed] * SAMPLE + rest[listed]]
        todo = np.flatnonzero(~listed)
        begin = self.samples[block[todo]].astype(np.int64)
        word, rest = begin >> 6, rest[todo]
        bits = self.high[word] & (_U(0xFFFFFFFFFFFFFFFF) << (begin & 63).astype(np.uint64))
        while len(todo):
            ones = np.bitwise_count(bits).astype(np.int64)
            here = rest < ones
            out[todo[here]] = word[here] * 64 + _one_in(bits[here], rest[here])
            todo, word, rest = todo[~here], word[~here] + 1, (rest - ones)[~here]
            bits = self.high[word]
        return out


def _packed(ones: np.ndarray, size: int) -> np.ndarray:
    bits = np.zeros(size, np.uint8)
    bits[ones] = 1
    return _words(np.packbits(bits, bitorder="little"))


def _words(data: np.ndarray, spare: int = 0) -> np.ndarray:
    """Bytes as little-endian 64-bit words, zeros at the end."""
    out = np.zeros((-(-len(data) // 8) + spare) * 8, np.uint8)
    out[: len(data)] = data
    return out.view("<u8").astype(np.uint64)


def _one_in(words: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Place of the one with so many ones below it, in each word."""
    words, rest, place = words.copy(), rest.copy(), np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & _U((1 << width) - 1)).astype(np.int64)
        up = rest >= below
        rest[up] -= below[up]
        words[up] >>= _U(width)
        place[up] += width
    return place
