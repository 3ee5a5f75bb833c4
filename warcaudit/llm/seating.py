"""Scores of texts under a hierarchical Pitman-Yor language model.

Restaurants are contexts. A word's fine context is the word before it, so there are as many as the training texts have
words; ``COARSE`` classes of words before are the parents of the fine ones, and the context without any word is the parent
of those, above a uniform base over the training vocabulary and one unknown word. A table of a restaurant is a customer
of its parent.

All restaurants' tables that serve one word are seated together, for each word alone, by the Chinese-restaurant rule. A sweep
seats all customers of all three levels again. Those of a word in a restaurant are seated jointly: given all else, they have t tables with a
weight that is known. Where there are more than ``JOINTLY``, Gibbs moves take them from their tables and seat them again, and the seats are
kept from sweep to sweep. Words only meet in the restaurants' totals, which each round takes from the round before.
Predictive probabilities are averaged over the samples after burn-in.

Counts of words by context are shuffled by word, once a round.
A task names the contexts that its words occur in, with their customers and tables; those are shuffled by context, added up, and
the totals go back to the tasks that named them. In the last round the places of words in the texts are shuffled instead of the counts; every
word's averaged probabilities meet its places, and sums by document come out. What is collected are the totals of the parents. Nothing that
grows with the vocabulary is broadcast or collected.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import require, written
from .text import Words, buffers, mix, signed, slices

COARSE = 16
DISCOUNT = (0.75, 0.75, 0.75)
STRENGTH = (1.0, 1.0, 1.0)
SWEEPS, BURN_IN, MOVES = 6, 2, 2
"""A sweep seats all customers again; by moves, as often as there are, where they cannot be seated jointly."""
ROUNDS = 2
"""Passes that only find the restaurants' totals, before the one whose probabilities are kept."""
JOINTLY = 2048
GROUPS = 8
AT_ONCE = 1_000_000
"""Customers that are seated in one go; fewer than 2^21."""
BLOCK_TOKENS = 1_000_000
BLOCK_TEXTS = 40_000
"""A block has fewer texts than 2^15, which is the room of a text's number beside its token's context."""
BUCKETS = 16
"""Parts of a task's words that are worked off one by one."""
CHUNK = 500_000
FLUSH = 3_000_000
END, START = np.uint64(0x452821E638D01377), np.uint64(0x13198A2E03707344)


def _tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, fine context (48 bits of a hash of the word before) and row of every token; the end is a token of every row."""
    words = Words(offsets, data)
    rows = len(offsets) - 1
    counts = np.diff(words.rows) + 1
    last = np.cumsum(counts) - 1
    word = np.full(int(counts.sum()), END)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = words.hashes
    before = np.empty(len(word), np.uint64)
    before[1:] = word[:-1]
    before[last - counts + 1] = START
    return word, mix(before) >> np.uint64(16), np.repeat(np.arange(rows), counts)


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole rows of bounded size: their batches' slices, and word, context and row of every token."""
    parts: list = []
    found: list[tuple[np.ndarray, ...]] = []
    rows = tokens = 0
    for batch in batches:
        offsets, data = buffers(batch.column(column))
        for a, b in slices(offsets):
            for c in range(a, b, BLOCK_TEXTS // 4):
                d = min(b, c + BLOCK_TEXTS // 4)
                word, context, row = _tokens(offsets[c: d + 1] - offsets[c], data[offsets[c]: offsets[d]])
                found.append((word, context, row + rows))
                parts.append(batch.slice(c, d - c))
                rows, tokens = rows + d - c, tokens + len(word)
                if tokens >= BLOCK_TOKENS or rows >= BLOCK_TEXTS // 2:
                    yield parts, *[np.concatenate(x) for x in zip(*found)]
                    parts, found, rows, tokens = [], [], 0, 0
    if parts:
        yield parts, *[np.concatenate(x) for x in zip(*found)]


def _bodies(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Binary values cut out of one array at ``first`` and its end."""
    offsets = np.append(first, len(values)) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


class Totals:
    """Customers and tables of every restaurant: fine ones, then coarse ones, then the root; ``parent`` is the class of each fine one."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, vocabulary: float, parent: np.ndarray | None = None) -> None:
        self.customers, self.tables, self.vocabulary = customers, tables, vocabulary
        self.fine = len(customers) - COARSE - 1
        self.parent = np.arange(self.fine) % COARSE if parent is None else parent
        level = np.repeat([2, 1, 0], [self.fine, COARSE, 1])
        self.discount, self.strength = np.array(DISCOUNT)[level], np.array(STRENGTH)[level]
        self.new = self.strength + self.discount * tables
        self.back = self.new / (self.strength + customers)
        self.unseen = float(self.back[-1] / (vocabulary + 1))

    def probability(self, restaurant: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        return ((customers - self.discount[restaurant] * tables + self.new[restaurant] * parent)
                / (self.strength[restaurant] + self.customers[restaurant]))


@functools.cache
def _arrangements(discount: float) -> np.ndarray:
    """Logarithm of the weight of all ways to seat n customers at t tables, one row after another for n from 1 to ``JOINTLY``.

    These are the generalised Stirling numbers: the last customer has a table alone, or is at one of the t tables of the others.
    """
    rows = [np.zeros(1)]
    for n in range(1, JOINTLY):
        t = np.arange(1, n + 1)
        rows.append(np.logaddexp(np.append(-np.inf, rows[-1]), np.append(np.log(n - discount * t) + rows[-1], -np.inf)))
    return np.concatenate(rows)


class Ways(NamedTuple):
    """Some pairs, their customers, and for every number of tables, one pair after another, the weight of the ways to sit there."""

    pairs: np.ndarray
    customers: np.ndarray
    first: np.ndarray
    tables: np.ndarray
    weight: np.ndarray


def ways_of(customers: np.ndarray, discount: float) -> Iterator[Ways]:
    """Pairs of three customers and more, as many as have ``AT_ONCE`` customers at a time."""
    turns = np.flatnonzero(customers > 2)
    while len(turns):
        now = turns[: max(int(np.searchsorted(np.cumsum(customers[turns]), AT_ONCE, "right")), 1)]
        turns = turns[len(now):]
        n = customers[now]
        first = np.append(0, np.cumsum(n)[:-1])
        t = np.arange(1, int(n.sum()) + 1) - np.repeat(first, n)
        yield Ways(now, n, first, t.astype(float), _arrangements(discount)[np.repeat(n * (n - 1) // 2 - 1, n) + t])


def tables_of(rng: np.random.Generator, customers: np.ndarray, mass: np.ndarray, discount: float, ways: Iterable[Ways] | None = None) -> np.ndarray:
    """Seat all customers of pairs of up to ``JOINTLY`` again, jointly: how many tables they have, whatever their seats were.

    This is the draw that moves of one customer after another tend to. ``ways``, if given, are those of the same customers.
    """
    out = customers.copy()  # one customer has one table
    two = np.flatnonzero(customers == 2)
    out[two] = 1 + (rng.random(len(two)) * (mass[two] + 1 - discount) < mass[two])
    for pairs, n, first, t, known in ways_of(customers, discount) if ways is None else ways:
        weight = np.repeat(np.log(mass[pairs]), n)
        weight *= t
        weight += known
        weight -= np.repeat(np.maximum.reduceat(weight, first), n)
        np.exp(weight, out=weight)
        upto = np.cumsum(weight)
        start = upto[first] - weight[first]
        end = upto[first + n - 1]
        found = np.searchsorted(upto, start + rng.random(len(pairs)) * (end - start), "right")
        out[pairs] = np.minimum(found, first + n - 1) - first + 1
    return out


class Seating:
    """Customers of one word at the tables of one restaurant each, for many pairs of word and restaurant at once.

    Pairs of up to ``JOINTLY`` customers are seated jointly and have only a number of tables. Of the others the sizes of the tables are
    kept, in the order of their pairs, since the customers of a pair are all alike. They are rows only while they sit down,
    ``AT_ONCE`` or so of them.
    """

    def __init__(self, rng: np.random.Generator, pairs: int, discount: float) -> None:
        self.rng, self.discount = rng, discount
        self.customers, self.tables = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
        self.sizes, self.owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.before: np.ndarray | None = None
        self.ways: list[Ways] | None = None

    def sweep(self, customers: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """The tables of each pair when all its customers, now so many, have been seated again."""
        few = np.where(customers <= JOINTLY, customers, 0)
        if self.before is None or (self.before != few).any():
            self.before, self.ways = few, None
        elif few.sum() <= AT_ONCE and self.ways is None:  # the same customers again, and maybe more often
            self.ways = list(ways_of(few, self.discount))
        out = tables_of(self.rng, few, mass, self.discount, self.ways)
        if (customers > JOINTLY).any() or self.customers.any():
            self.fit(customers - few, mass)
            for _ in range(MOVES):
                self.move(mass)
            out += self.tables
        return out

    def fit(self, customers: np.ndarray, mass: np.ndarray) -> None:
        """Make it so many customers: any of them leave, and those that come are seated one after another."""
        less = np.maximum(self.customers - customers, 0)
        if less.any():
            self._leave(less)
        while (more := customers - self.customers).any():
            now = np.clip(AT_ONCE - (np.cumsum(more) - more), 0, more)
            who = np.repeat(np.arange(len(now)), now)
            place, fresh, _ = self._draw(who, mass)
            self._sit(who, place, fresh)
            self.customers = self.customers + now
        self._close()

    def move(self, mass: np.ndarray) -> None:
        """Take every customer from its table once and seat it again, at a table or at a new one.

        Customers leave in ``GROUPS`` by chance and are seated one after another. Given all others, that is the right draw for one customer
        of a pair; for more of them it is a proposal, which is accepted so often that the draw is right.
        """
        waiting = np.where(self.customers[self.owner] > 1, self.sizes, 0)  # one customer alone always has a table
        for turn in range(turns := -(-int(waiting.sum()) // AT_ONCE)):
            off = waiting if turn == turns - 1 else self.rng.binomial(waiting, 1 / (turns - turn))
            waiting = waiting - off
            at = np.arange(len(off))  # where a table is now, among new ones
            rows = np.repeat(at, off)
            pair = self.owner[rows]
            local = np.cumsum(np.append(0, pair[1:] != pair[:-1]))[: len(rows)]
            group = self.rng.integers(0, GROUPS, len(rows))
            # By group and pair, and by chance in a pair.
            order = np.sort((group << 60) | (local << 40) | (self.rng.integers(0, 1 << 19, len(rows)) << 21) | np.arange(len(rows)))
            edges = np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS)))
            for k in range(GROUPS):
                if edges[k + 1] > edges[k]:
                    new = self._again(at[rows[order[edges[k]: edges[k + 1]] & ((1 << 21) - 1)]], mass)
                    at = at if new is None else new[at]
            grown = np.zeros(len(self.sizes), np.int64)
            grown[at] = waiting
            waiting = grown
        self._close()

    def _again(self, seat: np.ndarray, mass: np.ndarray) -> np.ndarray | None:
        """Seat the customers at some tables, in the order of their pairs, again; where the tables are then, if there are new ones."""
        who = self.owner[seat]
        np.subtract.at(self.sizes, seat, 1)
        place, fresh, norm = self._draw(who, mass)
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        if len(first) < len(who):
            # The same customers' seats as they were, seated in the same order: the first of a table without others opened it.
            opened = np.zeros(len(self.sizes), np.int64)
            opened[seat[::-1]] = np.arange(len(seat))[::-1]
            was = (self.sizes[seat] == 0) & (opened[seat] == np.arange(len(seat)))
            sizes = np.diff(np.append(first, len(who)))
            ratio = np.add.reduceat(np.log(norm) - np.log(self._norm(who, mass, was, np.repeat(first, sizes))), first)
            stay = np.repeat(np.log(self.rng.random(len(first))) > ratio, sizes)
            if stay.any():
                number = np.cumsum(fresh & ~stay) - 1
                new = place >= len(self.sizes)
                opener = np.flatnonzero(fresh)[place[new] - len(self.sizes)]
                place[new] = number[opener] + len(self.sizes)
                place[stay] = seat[stay]
                fresh = fresh & ~stay
        return self._sit(who, place, fresh)

    def _norm(self, who: np.ndarray, mass: np.ndarray, fresh: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Weight of all seats that each customer had to choose from, after the ones before it in its pair."""
        before = np.cumsum(fresh) - fresh
        return self.weight[who] + mass[who] + (np.arange(len(who)) - begin) - self.discount * (before - before[begin])

    def _draw(self, who: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A seat for each customer in turn (pairs in order), whether it opens a table, and the weight of all seats it had.

        The seats are the numbers of the tables, and after those new tables in the order in which they are opened.
        """
        n, d = len(who), self.discount
        up = np.append(0, np.cumsum(np.where(self.sizes > 0, self.sizes - d, 0)))
        edge = np.cumsum(np.bincount(self.owner, minlength=len(self.customers)))
        top = up[edge]
        base = np.append(0, top[:-1])
        self.weight = top - base
        new = np.append(True, who[1:] != who[:-1])
        first = np.flatnonzero(new)
        begin = first[np.cumsum(new) - 1]
        chance, own = self.rng.random(n), mass[who]
        fresh = np.zeros(n, bool)
        while True:  # the more tables were opened before, the less weight the others have
            norm = self._norm(who, mass, fresh, begin)
            again = chance * norm < own
            if (again == fresh).all():
                break
            fresh = again
        over = chance * norm - own
        weight = self.weight[who]
        place = np.empty(n, np.int64)
        place[fresh] = len(self.sizes) + np.arange(int(fresh.sum()))
        old = np.flatnonzero(~fresh & (over < weight))
        end = top[who[old]]
        place[old] = np.searchsorted(up, np.minimum(base[who[old]] + over[old], np.nextafter(end, 0)), "right") - 1
        mate = np.flatnonzero(~fresh & (over >= weight))
        if len(mate):  # beside one who came before it in its pair
            upto = np.cumsum(np.where(fresh, 1 - d, 1.0))
            start = np.append(0, upto)[begin[mate]]
            beside = np.arange(n)
            beside[mate] = np.clip(np.searchsorted(upto, start + over[mate] - weight[mate], "right"), begin[mate], mate - 1)
            while (beside[mate] != beside[beside[mate]]).any():
                beside[mate] = beside[beside[mate]]
            place[mate] = place[beside[mate]]
        return place, fresh, norm

    def _sit(self, who: np.ndarray, place: np.ndarray, fresh: np.ndarray) -> np.ndarray | None:
        n = len(self.sizes)
        sizes = np.concatenate([self.sizes, np.zeros(int(fresh.sum()), np.int64)])
        np.add.at(sizes, place, 1)
        if len(sizes) == n:
            self.sizes = sizes
            return None
        openers = who[fresh]
        spot = np.searchsorted(self.owner, openers, "right") + np.arange(len(openers))  # behind the others of its pair
        old = np.ones(len(sizes), bool)
        old[spot] = False
        at = np.flatnonzero(old)
        self.sizes, self.owner, owner = np.empty_like(sizes), np.empty_like(sizes), self.owner
        self.sizes[at], self.sizes[spot] = sizes[:n], sizes[n:]
        self.owner[at], self.owner[spot] = owner, openers
        return at

    def _leave(self, less: np.ndarray) -> None:
        """So many customers leave, any of a pair: those who do are drawn, or those who do not if these are fewer."""
        fewer = np.minimum(less, self.customers - less)
        end = np.cumsum(self.customers)
        chosen = np.zeros(0, np.int64)
        short = fewer
        while short.any():
            pair = np.repeat(np.arange(len(short)), short)
            more = end[pair] - 1 - (self.rng.random(len(pair)) * self.customers[pair]).astype(np.int64)
            chosen = np.unique(np.concatenate([chosen, more]))
            short = fewer - np.bincount(np.searchsorted(end, chosen, "right"), minlength=len(end))
        went = np.bincount(np.searchsorted(np.cumsum(self.sizes), chosen, "right"), minlength=len(self.sizes))
        self.sizes = np.where((fewer < less)[self.owner], went, self.sizes - went)
        self.customers = self.customers - less

    def _close(self) -> None:
        keep = self.sizes > 0
        self.sizes, self.owner = self.sizes[keep], self.owner[keep]
        self.tables = np.bincount(self.owner, minlength=len(self.customers))


def sample(rng: np.random.Generator, word: np.ndarray, context: np.ndarray, count: np.ndarray, n_words: int,
           totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Averaged probabilities of some words, and what they add to the restaurants' customers and tables.

    ``word``, ``context`` and ``count`` say how often each word follows each fine context. A sweep seats all customers of the fine
    restaurants again, then those of their parents, of which there is one for each table, then those of the root. Returns the probabilities in the root, word and coarse context of each coarse pair with its probability, those of the fine
    pairs, and customers and tables by restaurant.
    """
    pair, up = np.unique(word * COARSE + totals.parent[context], return_inverse=True)
    pair_word, pair_place = pair // COARSE, pair % COARSE + totals.fine
    top = np.full(n_words, totals.fine + COARSE)
    many = np.flatnonzero(count > 1)  # one customer has one table, wherever it sits
    customers, tables = (np.zeros(totals.fine + COARSE + 1) for _ in range(2))
    sums = [np.zeros(n) for n in (n_words, len(pair), len(word))]
    root = base = np.full(n_words, 1 / (totals.vocabulary + 1))
    middle = totals.back[pair_place] * root[pair_word]
    seats, above, first = (Seating(rng, n, d) for n, d in zip((len(many), len(pair), n_words), DISCOUNT[::-1]))
    kept = 0

    for sweep in range(SWEEPS):
        t_fine = np.ones(len(word), np.int64)
        t_fine[many] = seats.sweep(count[many], totals.new[context[many]] * middle[up[many]])
        c_pair = np.bincount(up, t_fine, len(pair)).astype(np.int64)
        t_pair = above.sweep(c_pair, totals.new[pair_place] * root[pair_word])
        c_top = np.bincount(pair_word, t_pair, n_words).astype(np.int64)
        t_top = first.sweep(c_top, totals.new[top] * base)
        root = totals.probability(top, c_top, t_top, base)
        middle = totals.probability(pair_place, c_pair, t_pair, root[pair_word])
        fine = totals.probability(context, count, t_fine, middle[up])
        if sweep >= BURN_IN:
            kept += 1
            for s, p in zip(sums, (root, middle, fine)):
                s += p
            for out, values in ((customers, (count, c_pair, c_top)), (tables, (t_fine, t_pair, t_top))):
                for places, v in zip((context, pair_place, top), values):
                    out += np.bincount(places, v, len(out))
    return sums[0] / kept, pair, sums[1] / kept, sums[2] / kept, customers / kept, tables / kept


class Numbers(NamedTuple):
    """Training tokens, distinct training words, and the customers and tables of the coarse restaurants and the root."""

    tokens: int
    vocabulary: int
    customers: np.ndarray
    tables: np.ndarray


ROW = "task long, bucket long, kind byte, number long, body binary"
TOTALS, PLACES, TEXT, NUMBERS, COUNTS = 0, 1, 2, 3, 4
MOST = 2**16 - 1
TEXTS = 1 << 16
"""Blocks are numbered in steps of so many, so that a text has the number of its block and its row in it."""
HELD = np.uint64(1 << 15)


def _rows(task: np.ndarray, bucket: np.ndarray, kind: int, number: np.ndarray, bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(task, np.int64)), pa.array(np.asarray(bucket, np.int64)), pa.array(np.full(len(bodies), kind, np.int8)),
         pa.array(np.asarray(number, np.int64)), pa.array(bodies, pa.binary())], names=["task", "bucket", "kind", "number", "body"])


def _summed_up(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and the sums of what is beside them."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], order[first], np.add.reduceat(value[order].astype(np.int64), first)


def _bodies_of(word: np.ndarray, body: np.ndarray, tasks: int) -> tuple[np.ndarray, list[bytes]]:
    """The buckets of sorted words, and for each the number of its words, the words, how many values each has, and those."""
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    end = np.append(first[1:], len(word))
    distinct, sizes = word[first], (end - first).astype(np.uint64)
    bucket = ((distinct >> np.uint64(32)) * np.uint64(tasks * BUCKETS) >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    stop = np.append(begin[1:], len(bucket))
    return bucket[begin], [np.concatenate([np.array([b - a], np.uint64), distinct[a:b], sizes[a:b], body[first[a]: end[b - 1]]]).tobytes()
                           for a, b in zip(begin.tolist(), stop.tolist())]


def _held(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column(1).combine_chunks().fill_null(False))


def _places(docs: DataFrame, tasks: int) -> DataFrame:
    """Where every word occurs, a row for each block of texts and bucket of words, and a row for each block about its texts.

    ``docs`` has ``id, held, text``. A place is its context, whether the text is held out, and the text's row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for parts, word, context, row in _blocks(batches, 2):
            table = pa.Table.from_batches(parts)
            n = table.num_rows
            held = _held(table).astype(np.uint64)
            order = np.argsort(word, kind="stable")
            of = row[order]
            bucket, bodies = _bodies_of(word[order], (context[order] << np.uint64(16)) | (held[of] * HELD) | of.astype(np.uint64), tasks)
            yield _rows(bucket // BUCKETS, bucket, PLACES, np.full(len(bucket), base), bodies)
            ids = table.column(0).combine_chunks()
            about = np.column_stack([np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid()).astype(np.int64), held.astype(np.int64), np.bincount(row, minlength=n)])
            yield _rows([int(mix(np.array([base], np.uint64))[0]) % tasks], [-1], TEXT, [base], [about.astype(np.int64).tobytes()])
            base += TEXTS

    return docs.mapInArrow(run, ROW)


def _counts(docs: DataFrame, tasks: int) -> DataFrame:
    """How often every word follows each context in the training texts of a block, a row for each block and bucket of words.

    That is all that the restaurants' totals depend on. A value is a context and a number; numbers beyond ``MOST`` are several values.
    Contexts of texts that are held out are there as well, if need be with none.
    """
    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, word, context, row in _blocks(batches, 2):
            trains = ~_held(pa.Table.from_batches(parts))[row]
            _, first, count = _summed_up(mix(word ^ mix(context)), trains)
            order = np.argsort(word[first], kind="stable")
            first, count = first[order], count[order]
            times = np.maximum(-(-count // MOST), 1)
            number = np.full(int(times.sum()), MOST)
            number[np.cumsum(times) - 1] = count - MOST * (times - 1)
            first = np.repeat(first, times)
            bucket, bodies = _bodies_of(word[first], (context[first] << np.uint64(16)) | number.astype(np.uint64), tasks)
            yield _rows(bucket // BUCKETS, bucket, COUNTS, np.zeros(len(bucket)), bodies)

    return docs.mapInArrow(count_words, ROW)


class Bucket:
    """The places of some words, or only their counts, and the counts by context. Places beyond ``CHUNK`` wait on disk, so a common
    word needs no room for its own."""

    def __init__(self, counted: bool = False) -> None:
        self.counted = counted
        self.fresh: list[tuple[np.ndarray, int]] = []
        self.size = 0
        self.chunks: list[tuple[np.ndarray, np.ndarray]] = []
        self.file = None
        self.waiting = 0
        self.pairs = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]

    def add(self, body: np.ndarray, block: int) -> None:
        self.fresh.append((body, block))
        self.size += len(body)
        if self.size >= CHUNK:
            self.pack()

    def pack(self) -> None:
        """Places as the hash of their word and context and the number of their text; pairs with the words' training counts."""
        if not self.fresh:
            return
        counts = [int(body[0]) for body, _ in self.fresh]
        word = np.concatenate([np.repeat(body[1: n + 1], body[n + 1: 2 * n + 1].astype(np.int64)) for n, (body, _) in zip(counts, self.fresh)])
        place = np.concatenate([body[2 * n + 1:] for n, (body, _) in zip(counts, self.fresh)])
        context, trains = place >> np.uint64(16), place & np.uint64(MOST) if self.counted else (place & HELD) == 0
        pair = mix(word ^ mix(context))
        found, first, count = _summed_up(pair, trains)
        new = [found, word[first], context[first], count]
        if len(self.pairs[0]):
            both = [np.concatenate(x) for x in zip(self.pairs, new)]
            found, first, count = _summed_up(both[0], both[3])
            new = [found, both[1][first], both[2][first], count]
        self.pairs = new
        fresh, self.fresh, self.size = self.fresh, [], 0
        if self.counted:
            return
        text = np.repeat([block for _, block in fresh], [len(body) - 2 * n - 1 for n, (body, _) in zip(counts, fresh)])
        text += (place & (HELD - np.uint64(1))).astype(np.int64)
        if self.chunks:
            self.file = self.file or tempfile.TemporaryFile()
            for x in self.chunks.pop():
                np.save(self.file, x)
            self.waiting += 1
        self.chunks = [(pair, text)]

    def places(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each place where its pair is, and its text."""
        if self.waiting:
            self.file.seek(0)
        for k in range(self.waiting + 1):
            pair, text = (np.load(self.file), np.load(self.file)) if k < self.waiting else self.chunks[0]
            yield np.searchsorted(self.pairs[0], pair), text

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Seated(NamedTuple):
    """Some words' pairs with contexts, seated: their contexts, and what the pairs add to those and to the restaurants above them."""

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    tokens: int
    vocabulary: int
    base: np.ndarray
    score: np.ndarray
    known: np.ndarray


def _seat(bucket: Bucket, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None, numbers: Numbers | None, share: int) -> Seated:
    """Seat the words of a bucket; without totals of a round before, with those to expect if the bucket is one of ``share`` alike."""
    _, word, context, count = bucket.pairs
    words, of_word = np.unique(word, return_inverse=True)
    contexts, of_context = np.unique(context, return_inverse=True)
    n = np.bincount(of_word, count, len(words))
    trained = count > 0
    seen = n > 0
    tokens, vocabulary = int(n.sum()), int(seen.sum())
    if numbers is None:
        # A pair is in this bucket for certain, each other of its context by chance.
        customers = np.bincount(of_context, count, len(contexts)) * share
        pairs = np.bincount(of_context, trained, len(contexts))
        tables = np.maximum(pairs - 1, 0) * share + (pairs > 0)
        above = np.repeat([tokens * share / COARSE / 2, tokens * share / 4], [COARSE, 1]) + 1.0
        totals = Totals(np.append(np.maximum(customers, tables), above), np.append(tables, above / 2), vocabulary * share, (contexts % np.uint64(COARSE)).astype(np.int64))
    else:
        at = np.searchsorted(known[0], contexts)
        totals = Totals(np.append(known[1][at], numbers.customers), np.append(known[2][at], numbers.tables), numbers.vocabulary,
                        (contexts % np.uint64(COARSE)).astype(np.int64))
    number = np.cumsum(seen) - 1  # among words that occur in training
    rng = np.random.Generator(np.random.PCG64(int(words[0])))
    root, pair, middle, fine, customers, tables = sample(rng, number[of_word[trained]], of_context[trained], count[trained], vocabulary, totals)
    p = np.full(len(words), totals.unseen)
    p[seen] = root
    parent = totals.parent[of_context]
    p = totals.back[parent + totals.fine] * p[of_word]
    if len(pair):
        wanted = np.where(seen[of_word], number[of_word] * COARSE + parent, -1)
        at = np.minimum(np.searchsorted(pair, wanted), len(pair) - 1)
        p = np.where(pair[at] == wanted, middle[at], p)
    p = totals.back[of_context] * p
    p[trained] = fine
    return Seated(contexts, customers, tables, tokens, vocabulary, np.log10(n + 1)[of_word], np.log10(p), seen[of_word].astype(float))


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Distinct contexts with the sums of what is beside them."""
    context, *values = (np.concatenate(x) for x in zip(*parts))
    distinct, at = np.unique(context, return_inverse=True)
    return distinct, *[np.bincount(at, v, len(distinct)) for v in values]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Bucket | None, tuple | None, pa.RecordBatch | None]]:
    """The buckets of sorted rows one by one, with task and that task's totals of contexts; rows about texts as they come."""
    bucket: Bucket | None = None
    key = task = None
    parts: list[tuple[np.ndarray, ...]] = []
    known = None
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(4)]
        for k, (own, name, kind, number) in enumerate(zip(*(c.tolist() for c in columns))):
            if bucket is not None and name != key:
                bucket.pack()
                yield task, bucket, known, None
                bucket.close()
                bucket = None
            if own != task:
                task, parts, known = own, [], None
            if kind == TEXT:
                yield task, None, None, batch.slice(k, 1)
                continue
            body = np.frombuffer(batch.column(4)[k].as_buffer(), np.uint64)
            if kind == TOTALS:
                context, values = body[: len(body) // 3], body[len(body) // 3:].view(np.float64)
                parts.append((context, *np.split(values, 2)))
                continue
            if known is None and parts:
                whole = [np.concatenate(x) for x in zip(*parts)]
                order = np.argsort(whole[0])
                known, parts = tuple(x[order] for x in whole), []
            if bucket is None:
                bucket, key = Bucket(kind == COUNTS), name
            bucket.add(body, number)
    if bucket is not None:
        bucket.pack()
        yield task, bucket, known, None
        bucket.close()


def _body(context: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> bytes:
    return context.tobytes() + customers.astype(np.float64).tobytes() + tables.astype(np.float64).tobytes()


def _dealt(words: DataFrame, tasks: int, totals: DataFrame | None) -> DataFrame:
    rows = words if totals is None else words.unionAll(totals.filter(F.col("kind") == TOTALS))
    return rows.repartitionById(tasks, F.col("task").cast("int")).sortWithinPartitions("task", "bucket")


def restaurant_totals(counts: DataFrame, tasks: int, totals: DataFrame | None = None, numbers: Numbers | None = None) -> tuple[DataFrame, Numbers]:
    """A round of seating: for each task the totals of its words' contexts, and the numbers of all."""
    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts, size, above = None, [], 0, np.zeros(2 * COARSE + 4)

        def out() -> Iterator[pa.RecordBatch]:
            context, customers, tables = _added(parts)
            to = (context * np.uint64(tasks) >> np.uint64(48)).astype(np.int64)
            begin = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            stop = np.append(begin[1:], len(to))
            yield _rows(to[begin], np.zeros(len(begin)), TOTALS, np.full(len(begin), task),
                        [_body(context[a:b], customers[a:b], tables[a:b]) for a, b in zip(begin, stop)])
            yield _rows([task], [0], NUMBERS, [task], [above.tobytes()])

        for own, bucket, known, _ in _buckets(batches):
            if bucket is None:
                continue
            if own != task:
                if parts:
                    yield from out()
                task, parts, size, above = own, [], 0, np.zeros(2 * COARSE + 4)
            s = _seat(bucket, known, numbers, tasks * BUCKETS)
            n = len(s.contexts)
            parts.append((s.contexts, s.customers[:n], s.tables[:n]))
            above += np.concatenate([s.customers[n:], s.tables[n:], [s.tokens, s.vocabulary]])
            size += n
            if size >= FLUSH:
                parts = [_added(parts)]
                size = 0
        if parts:
            yield from out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, sources = [], []
        for batch in batches:
            for kind, source, body in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                if kind == NUMBERS:
                    yield _rows([source], [-1], NUMBERS, [source], [body])
                    continue
                context = np.frombuffer(body, np.uint64, len(body) // 24)
                parts.append((context, *np.split(np.frombuffer(body, np.float64, offset=len(body) // 3), 2)))
                sources.append(source)
        if parts:
            context, customers, tables = _added(parts)
            for (wanted, *_), source in zip(parts, sources):
                at = np.searchsorted(context, wanted)
                yield _rows([source], [-1], TOTALS, [0], [_body(wanted, customers[at], tables[at])])

    found = written(_dealt(counts, tasks, totals).mapInArrow(seat, ROW).repartitionById(tasks, F.col("task").cast("int")).mapInArrow(add, ROW))
    bodies = [np.frombuffer(r.body, np.float64) for r in found.filter(F.col("kind") == NUMBERS).select("body").toLocalIterator()]
    above = np.sum([np.zeros(2 * COARSE + 4), *bodies], axis=0)
    return found, Numbers(int(above[-2]), int(above[-1]), above[: COARSE + 1], above[COARSE + 1: -2])


SUMS = "block long, sums binary, about binary"


def _summed(places: DataFrame, tasks: int, totals: DataFrame, numbers: Numbers) -> DataFrame:
    """Sums by text over its tokens: one row for each block of texts and some million places, with the sums of the texts that occur."""
    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        text, base, score, known = (np.concatenate(x) for x in zip(*held))
        distinct, at = np.unique(text, return_inverse=True)
        n = len(distinct)
        table = np.column_stack([distinct % TEXTS + TEXTS * np.bincount(at, known, n), np.bincount(at, base, n), np.bincount(at, score, n)])
        block = distinct - distinct % TEXTS
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(block[begin]), _bodies(table.ravel(), begin * 3), pa.nulls(len(begin), pa.binary())],
                                          names=["block", "sums", "about"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for _, bucket, known, about in _buckets(batches):
            if about is not None:
                yield pa.RecordBatch.from_arrays([about.column(3), pa.nulls(1, pa.binary()), about.column(4)], names=["block", "sums", "about"])
                continue
            s = _seat(bucket, known, numbers, tasks * BUCKETS)
            for at, text in bucket.places():
                held.append((text, s.base[at], s.score[at], s.known[at]))
                size += len(text)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return _dealt(places, tasks, totals).mapInArrow(run, SUMS)


FOUND = "id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _by_text(pieces: DataFrame) -> DataFrame:
    """The sums of every text of a block, added up block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums, about = None, np.zeros((0, 3)), None

        def out() -> pa.RecordBatch:
            n = len(about)
            whole = np.zeros((n, 3))
            whole[: len(sums)] = sums[:n]
            return pa.RecordBatch.from_arrays(
                [pa.array(about[:, 0], mask=about[:, 1] == 0), pa.array(about[:, 2] == 1), pa.array(about[:, 3]),
                 pa.array(np.rint(whole[:, 2]).astype(np.int64)), pa.array(whole[:, 0]), pa.array(whole[:, 1])],
                names=["id", "held_out", "n_tokens", "n_known", "base", "score"])

        for batch in batches:
            for own, part, texts in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if own != block:
                    if about is not None:
                        yield out()
                    block, sums, about = own, np.zeros((0, 3)), None
                if texts is not None:
                    about = np.frombuffer(texts, np.int64).reshape(-1, 4)
                    continue
                table = np.frombuffer(part, np.float64).reshape(-1, 3)
                known, at = np.divmod(table[:, 0].astype(np.int64), TEXTS)
                if at.max(initial=-1) >= len(sums):
                    sums = np.concatenate([sums, np.zeros((int(at.max()) + 1 - len(sums), 3))])
                sums[at] += np.column_stack([table[:, 1:], known])  # a text is once in a row
        if about is not None:
            yield out()

    return pieces.repartition("block").sortWithinPartitions("block").mapInArrow(run, FOUND)


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of the table: id, whether it was held out of training, tokens, and log10 scores.

    Trains on the rows for which ``held`` is not true and scores all, whole texts. Tokens are words and one end, so a
    null or empty text is one end token. ``n_known`` tokens occur in training; ``base_score`` adds up
    log10((c+1)/(N+V+1)) of add-one smoothing, ``score`` is the model's log10 probability. Repeated rows train and score
    as often as they occur. Without training rows, every token has the base probability. An empty table gives an empty one.
    """
    require(docs, id_col, text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    totals = numbers = None
    for _ in range(ROUNDS):
        totals, numbers = restaurant_totals(_counts(rows, tasks), tasks, totals, numbers)
    found = _by_text(_summed(_places(rows, tasks), tasks, totals, numbers))
    return found.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(numbers.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(numbers.tokens + numbers.vocabulary + 1)))).alias("base_score"), "score")
