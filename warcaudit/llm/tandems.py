"""Periodic runs of words, by branching tandem repeats of an enhanced suffix array.

The suffixes of the words of a slice of texts are sorted by doubling; words of different texts differ, so no repeat
leaves its text. From the common prefixes of neighbours come the intervals of suffixes that share a prefix of some
depth, and their children, without any tree: bounds are found by descending a table of minima. A square of period d
that cannot be moved one word to the right begins at a suffix i whose interval of depth d also holds i + d, in another
child. One of the two lies outside the largest child, so it is enough to look from the smaller children both ways.
Each such square, moved left as far as it remains one, is a run; runs with the same ends keep their least period.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import require

RESULT = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
SLICE_WORDS = 1 << 16
"""Words of texts that are sorted together; a longer text is sorted alone."""


class SuffixOrder:
    """The suffixes of a sequence in order, and their ranks by the first 1, 2, 4, … symbols.

    Each doubling sorts only suffixes that are not yet told apart.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.n = len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        ordered = symbols[self.order]
        slots, fresh = np.arange(n), np.append(True, ordered[1:] != ordered[:-1])
        rank = np.zeros(n, np.int32)
        self.levels: list[np.ndarray] = []
        reach = 1
        while True:
            # A group's rank is its first place in the order; a suffix alone in its group has its final place.
            first = np.maximum.accumulate(np.where(fresh, slots, 0))
            rank[self.order[slots]] = first
            self.levels.append(rank.copy())
            shared = ~(fresh & np.append(fresh[1:], True))
            slots, first = slots[shared], first[shared]
            if not len(slots):
                break
            at = self.order[slots]
            behind = at + reach
            key = first * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
            by_key = np.argsort(key, kind="stable")
            key = key[by_key]
            self.order[slots] = at[by_key]
            fresh = np.append(True, key[1:] != key[:-1])
            reach *= 2

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that two different places have in common from there on, a before or after b."""
        length = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            x, y = a + length, b + length
            inside = np.maximum(x, y) < self.n
            same = inside & (self.levels[level][np.minimum(x, self.n - 1)] == self.levels[level][np.minimum(y, self.n - 1)])
            length[same] += 1 << level
        return length

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that two places have in common up to there, a before b."""
        length = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            x, y = a - length - (1 << level), b - length - (1 << level)
            same = (x >= 0) & (self.levels[level][np.maximum(x, 0)] == self.levels[level][np.maximum(y, 0)])
            length[same] += 1 << level
        return length


def _smaller_children(lcp: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """All children but the largest of every interval: their slots, and depth and bounds of the interval for each slot.

    ``lcp[j]`` is what the suffixes in slots j - 1 and j share, zero at both ends; interval bounds are [low, high).
    """
    n = len(lcp) - 1
    minima = [lcp]
    for k in range(max(1, longest).bit_length()):
        half = 1 << k
        upper = np.zeros_like(lcp)
        if half < len(lcp):
            upper[:-half] = minima[-1][half:]
        minima.append(np.minimum(minima[-1], upper))
    at = np.flatnonzero(lcp)
    depth = lcp[at]
    low, high = at.copy(), at + 1
    for k in range(len(minima) - 1, -1, -1):
        step = 1 << k
        before = np.maximum(low - step, 0)
        low = np.where((low >= step) & (minima[k][before] >= depth), before, low)
        high = np.where(minima[k][np.minimum(high, n)] >= depth, high + step, high)
    low -= 1
    # Boundaries of one interval next to each other, in order: between them lie its children.
    by_interval = np.argsort(low * (n + 1) + high, kind="stable")
    at, depth, low, high = at[by_interval], depth[by_interval], low[by_interval], high[by_interval]
    opens = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(at)]
    closes = np.append(opens[1:], True)[: len(at)]
    begins = np.concatenate([np.where(opens, low, np.append(0, at[:-1])[: len(at)]), at[closes]])
    ends = np.concatenate([at, high[closes]])
    interval = np.cumsum(opens) - 1
    of = np.concatenate([interval, interval[closes]])
    size = ends - begins
    greatest = np.zeros(interval[-1] + 1 if len(interval) else 0, np.int64)
    np.maximum.at(greatest, of, size)
    largest = np.flatnonzero(size == greatest[of])
    _, one = np.unique(of[largest], return_index=True)
    keep = np.ones(len(of), bool)
    keep[largest[one]] = False
    begins, size, source = begins[keep], size[keep], np.concatenate([np.arange(len(at)), np.flatnonzero(closes)])[keep]
    upto = np.cumsum(size)
    slots = np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - (upto - size), size)
    source = np.repeat(source, size)
    return slots, depth[source], low[source], high[source]


def runs(symbols: np.ndarray, longest: int, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and least period of every run with so many periods and symbols, by start and period.

    ``longest`` bounds how many suffixes can share a first symbol.
    """
    n = len(symbols)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    suffixes = SuffixOrder(symbols)
    order, place = suffixes.order, suffixes.levels[-1]
    lcp = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(symbols[order[1:]] == symbols[order[:-1]]) + 1
    lcp[near] = suffixes.common_after(order[near - 1], order[near])
    slots, depth, low, high = _smaller_children(lcp, longest)

    def symbol(at: np.ndarray) -> np.ndarray:
        return np.where(at < n, symbols[np.minimum(at, n - 1)], -1)

    here = order[slots]
    found = []
    for first, other in ((here, here + depth), (here - depth, here - depth)):
        inside = (other >= 0) & (other < n)
        k = np.flatnonzero(inside)
        rank = place[other[k]]
        k = k[(rank >= low[k]) & (rank < high[k])]
        # Branching: the word after the first half is not the one after the second.
        k = k[symbol(first[k] + depth[k]) != symbol(first[k] + 2 * depth[k])]
        found.append((first[k], depth[k]))
    start, period = (np.concatenate(x) for x in zip(*found))
    end = start + 2 * period
    start = start - suffixes.common_before(start, start + period)
    enough = end - start >= np.maximum(least, exponent * period)
    start, end, period = start[enough], end[enough], period[enough]
    by_ends = np.lexsort((period, end, start))
    start, end, period = start[by_ends], end[by_ends], period[by_ends]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, period = start[new], end[new], period[new]
    by_start = np.lexsort((period, start))
    return start[by_start], end[by_start], period[by_start]


def _texts(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of texts, in slices of so many words."""
    some, size = [], 0
    for text in column.cast(pa.large_binary()):
        words = (text.as_py() or b"").split()
        if some and size + len(words) > SLICE_WORDS:
            yield some
            some, size = [], 0
        some.append(words)
        size += len(words)
    if some:
        yield some


def _slice(texts: list[list[bytes]], exponent: int, least: int) -> tuple[np.ndarray, list, list[bytes]]:
    """Number of runs, the runs, and the text without repeated periods, of each text."""
    sizes = np.array([len(t) for t in texts])
    begins = np.append(0, np.cumsum(sizes))
    known: dict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    words = np.fromiter((known[w] for t in texts for w in t), np.int64, begins[-1])
    owner = np.repeat(np.arange(len(texts)), sizes)
    start, end, period = runs(owner * (len(known) + 1) + words, int(sizes.max(initial=0)), exponent, least)
    text = np.searchsorted(begins, start, "right") - 1
    counts = np.bincount(text, minlength=len(texts))
    gone = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, end, -1)
    kept = np.cumsum(gone) == 0
    left = [b" ".join(compress(t, kept[a:b].tolist()) if c else t) for t, a, b, c in zip(texts, begins, begins[1:], counts)]
    return counts, [start - begins[text], end - start, period], left


def _found(column: pa.Array, exponent: int, least: int) -> pa.Array:
    parts = []
    for texts in _texts(column):
        counts, fields, left = _slice(texts, exponent, least)
        rows = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], names=["start", "length", "period"])
        offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
        parts.append(pa.StructArray.from_arrays(
            [pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(offsets, rows), pa.array(left, pa.binary()).cast(pa.string())],
            names=["n_words", "runs", "collapsed"]))
    if not parts:
        empty = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))), ("collapsed", pa.string())])
        return pa.array([], empty)
    return pa.concat_arrays(parts)


def find_runs(docs: DataFrame, text: str = "text", out: str = "periodic", exponent: int = 4, least: int = 6) -> DataFrame:
    """All rows and columns of a table, and the periodic runs of words of each text.

    The column ``out`` has the number of words, the runs (``start`` word, ``length``, least ``period``) with at least
    ``exponent`` periods and ``least`` words that no neighbouring word extends, by start and period, and the words joined
    by single spaces without those that any run holds after its first period. Words are runs of bytes other than space and
    0x09-0x0D, compared as they are. Null, empty and blank texts have no words and no runs. Texts of any length are
    handled whole, in memory that grows with the text; each row is worked on alone, so repeated rows give repeated results,
    and an empty table gives an empty one. A column named ``out`` is replaced. Nothing is shuffled.
    """
    require(docs, text)
    return docs.withColumn(out, F.arrow_udf(lambda column: _found(column, exponent, least), RESULT)(F.col(text)))


def with_periods(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The same table, the words of a tenth of the texts made periodic from some word on, as the query's contract says.

    With h the CRC-32 of the id in decimal and g = h div 10: where h ends in 0 and there are n words, word i from a = g mod n on
    becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Rows without id stay as they are.
    """
    def run(idents: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([_repeated(i, t) for i, t in zip(idents.to_pylist(), texts.to_pylist())], pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(ident), F.col(text)))


def _repeated(ident: int | None, text: str | None) -> str | None:
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 or not text:
        return text
    words, g = text.encode().split(), h // 10
    n = len(words)
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[i if i < a else a + (i - a) % p] for i in range(n)).decode()


def longest(found: Column) -> Column:
    """The run with most words; of equally long ones the first, then the one with the smallest period. Null without runs."""
    return F.array_max(F.transform(found, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def listed(found: Column) -> Column:
    """Each run as ``start,length,period`` on a line of its own."""
    lines = F.transform(found, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
