"""Benchmark passages in documents, also reordered ones, by greedy string tiling.

Texts are runs of letters and digits, A-Z as a-z. Seeds: the rolling hashes of all five-word windows of documents and
of benchmark items are joined; one row carries all places of a window in a document, another all places in an item, so
a repeated window never multiplies rows. For each document and item that share a seed, the seeds are drawn together
along their diagonals to matches, and matches are marked longest first on words that no tile has yet; what is left of a
match that lost words is matched again by its rolling hashes, until nothing of five words is left. The share of an
item's words that tiles cover, wherever they are in the document, decides.

A document's windows are looked up in a bit table of fixed size first, so that only windows that may be in the
benchmark leave their task. Its size is a parameter; when the benchmark is large, more windows pass and the join
decides, with the same results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import free_name, require, written
from .text import NOT_ALNUM, Hashes, Words, buffers, signed, slices

LEAST = 5
SHARE = 0.8
BITS = 1 << 22


def _windows(offsets: np.ndarray, data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Hash, first word in its row, and row of every window; a shorter row is one window."""
    words = Words(offsets, data, NOT_ALNUM)
    counts = np.diff(words.rows)
    per_row = np.where(counts >= least, counts - least + 1, (counts > 0).astype(np.int64))
    rows = np.repeat(np.arange(len(counts)), per_row)
    first = np.cumsum(per_row) - per_row
    at = np.arange(len(rows)) - first[rows]
    starts = at + words.rows[rows]
    return Hashes(words.hashes).of(starts, starts + np.minimum(least, counts[rows])), at, rows, words


def item_windows(benchmark: DataFrame, item: str, text: str, least: int) -> DataFrame:
    """``window, item_id, n_words, size, places``: every distinct window of every item and where it begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            hashes, at, rows, words = _windows(offsets, data, least)
            counts = np.diff(words.rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(hashes)), batch.column(0).take(pa.array(rows)), pa.array(counts[rows]),
                 pa.array(np.minimum(least, counts[rows])), pa.array(at)],
                names=["window", "item_id", "n_words", "size", "at"])

    # An item that occurs more than once, or under one id with other texts, is one item for each text.
    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text")).dropna().distinct()
    schema = f"window long, item_id {benchmark.schema[item].dataType.simpleString()}, n_words long, size long, at long"
    return rows.mapInArrow(run, schema).groupBy("window", "item_id", "n_words", "size").agg(
        F.sort_array(F.collect_list("at")).alias("places"))


def _by_window(seeds: list[tuple[list[int], list[int]]]) -> list[tuple[list[int], list[int]]]:
    """Seeds that share a place, which are the same window, as one; most often there are none."""
    counts = [(sum(len(s[k]) for s in seeds), len({p for s in seeds for p in s[k]})) for k in (0, 1)]
    if all(n == distinct for n, distinct in counts):
        return seeds
    root = list(range(len(seeds)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    seen: dict[tuple[int, int], int] = {}
    for number, seed in enumerate(seeds):
        for side in (0, 1):
            for place in seed[side]:
                root[find(seen.setdefault((side, place), number))] = find(number)
    merged: dict[int, tuple[set[int], set[int]]] = {}
    for number, seed in enumerate(seeds):
        both = merged.setdefault(find(number), (set(), set()))
        for side in (0, 1):
            both[side].update(seed[side])
    return [(sorted(d), sorted(i)) for d, i in merged.values()]


def _sequence(places: list[list[int]]) -> tuple[np.ndarray, int]:
    """Which window begins at each word from the first place on, numbered from 1 and 0 for none, and that place."""
    sizes = [len(p) for p in places]
    at = np.concatenate([np.asarray(p, np.int64) for p in places])
    first = int(at.min())
    # One place more at either end, where nothing begins.
    line = np.zeros(int(at.max()) - first + 3, np.int64)
    line[at - first + 1] = np.repeat(np.arange(1, len(places) + 1), sizes)
    return line, first - 1


def _matches(seeds: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document word, item word and windows of every match: windows next to each other that cannot be extended.

    A match begins where the windows before it differ, so places are paired only across different windows before
    them: of a text that repeats itself, one match for each diagonal and not one for each of its words.
    """
    doc, doc_first = _sequence([d for d, _ in seeds])
    item, item_first = _sequence([i for _, i in seeds])
    before_doc = before_item = None
    starts = []
    for d, i in seeds:
        d, i = np.unique(np.asarray(d, np.int64)) - doc_first, np.unique(np.asarray(i, np.int64)) - item_first
        before_doc, before_item = doc[d - 1], item[i - 1]
        for value in np.unique(before_doc):
            # No window before both is two different ends.
            other = i if value == 0 else i[before_item != value]
            mine = d[before_doc == value]
            starts.append((np.repeat(mine, len(other)), np.tile(other, len(mine))))
    at, of = (np.concatenate(x) for x in zip(*starts))
    values = np.concatenate([doc, item]).astype(np.uint64)
    # A place of the document where nothing begins is like no place of the item.
    values[: len(doc)][doc == 0] = np.uint64(len(seeds) + 1)
    hashes = Hashes((values + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    length = np.ones(len(at), np.int64)
    for step in 1 << np.arange(int(min(len(doc), len(item))).bit_length())[::-1]:
        inside = (at + length + step <= len(doc)) & (of + length + step <= len(item))
        x, y = np.where(inside, at + length, 0), np.where(inside, of + length, 0) + len(doc)
        same = inside & (hashes.of(x, x + np.where(inside, step, 0)) == hashes.of(y, y + np.where(inside, step, 0)))
        length[same] += step
    return at + doc_first, of + item_first, length


def tiles(seeds: list[tuple[list[int], list[int]]], size: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: ``(document word, item word, words)`` of the tiles, longest first, then by place.

    ``seeds`` has for each shared window its places in the document and in the item. Seeds next to each other on a
    diagonal are one match; a match that has lost words to longer tiles is cut to its unmarked stretches, which stay
    candidates while a whole window fits. It ends when no window fits into what is left of the item.
    """
    at, of, windows = _matches(_by_window(seeds))
    words = windows + size - 1
    first_at, first_of = int(at.min()), int(of.min())
    used_at = np.zeros(int((at + words).max()) - first_at, bool)
    used_of = np.zeros(int((of + words).max()) - first_of, bool)
    matches: dict[int, list[tuple[int, int]]] = {}
    for n in np.unique(words).tolist():
        here = words == n
        matches[n] = list(zip((at[here] - first_at).tolist(), (of[here] - first_of).tolist()))
    out = []
    room = True
    while matches and room:
        n = max(matches)
        for a, i in sorted(matches.pop(n)):
            taken = used_at[a: a + n] | used_of[i: i + n]
            if not taken.any():
                out.append((a + first_at, i + first_of, n))
                used_at[a: a + n] = used_of[i: i + n] = True
                if not _fits(used_of, size):
                    room = False
                    break
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]])))
            for k, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - k >= size:
                    matches.setdefault(end - k, []).append((a + k, i + k))
    return out


def _fits(used: np.ndarray, size: int) -> bool:
    """Whether so many words next to each other are unmarked."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]])))
    return bool(len(edges)) and int((edges[1::2] - edges[::2]).max()) >= size


FOUND = "n_tiles long, n_covered long, coverage double, tiles array<struct<doc_word: long, item_word: long, words: long>>"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", least: int = LEAST, share: float = SHARE) -> DataFrame:
    """Pairs of document and item of which tiles cover at least the share: ids, words of the item, tiles, coverage.

    Items shorter than ``least`` words must occur whole. Texts that are null or without words match nothing; items
    without id are left out. Documents with the same id count as one with the windows of all; those without id are
    one document with a null id. An empty table on either side gives an empty result.
    """
    require(docs, id_col, text)
    require(benchmark, item, item_text)
    known = written(item_windows(benchmark, item, item_text, least))
    # At most one row for each bit of the table, whatever the benchmark's size.
    bits = np.zeros(BITS, bool)
    hit = known.select(F.pmod("window", F.lit(BITS)).cast("int").alias("bit")).distinct().toArrow().column(0).to_numpy()
    bits[hit] = True
    sizes = [r["size"] for r in known.select("size").distinct().collect()]
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed).astype(bool)
        for batch in batches:
            offsets, data = buffers(batch.column(1))
            for a, b in slices(offsets):
                part = offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]]
                for size in sizes:
                    hashes, at, rows, _ = _windows(*part, size)
                    pick = np.flatnonzero(table[hashes & np.uint64(BITS - 1)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(hashes[pick])), batch.column(0).take(pa.array(rows[pick] + a)),
                         pa.array(at[pick])], names=["window", "doc", "at"])

    kind = docs.schema[id_col].dataType.simpleString()
    ours = docs.select(F.col(id_col).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"window long, doc {kind}, at long")
    # Only what is in the benchmark is gathered; a window's places in one document are one row from here on.
    shared = (ours.join(known.select("window").distinct(), "window", "left_semi")
              .groupBy("window", "doc").agg(F.sort_array(F.collect_set("at")).alias("at")).join(known, "window"))

    def tile(key: tuple, table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        found = tiles(list(zip(table.column("at").to_pylist(), table.column("places").to_pylist())), size)
        covered = sum(n for _, _, n in found)
        rows = [{"doc_word": a, "item_word": i, "words": n} for a, i, n in found]
        return pa.table({"doc": pa.array([key[0].as_py()], table.schema.field("doc").type),
                         "item_id": pa.array([key[1].as_py()], table.schema.field("item_id").type),
                         "n_words": [key[2].as_py()], "n_tiles": [len(found)], "n_covered": [covered],
                         "coverage": [covered / key[2].as_py()],
                         "tiles": pa.array([rows], pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_word", "item_word", "words")])))})

    item_kind = benchmark.schema[item].dataType.simpleString()
    # Windows that together cannot reach the share need no tiling: each place of one covers at most `size` words of the
    # item. The sum needs no shuffle of its own, and most pairs share only a common phrase.
    reach = F.sum(F.size("places") * F.col("size")).over(Window.partitionBy("doc", "item_id", "n_words"))
    shared = shared.withColumn("reach", reach).filter(F.col("reach") >= share * F.col("n_words")).drop("reach")
    pairs = shared.groupBy("doc", "item_id", "n_words").applyInArrow(
        tile, f"doc {kind}, item_id {item_kind}, n_words long, {FOUND}")
    return (pairs.filter(F.col("coverage") >= share).withColumnRenamed("doc", id_col)
            .withColumnRenamed("item_id", free_name(docs.select(id_col), item)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no benchmark item; those without id are kept only if none of them holds one."""
    bad = contaminated(docs, benchmark, id_col).select(F.col(id_col).alias("_bad_id")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]), "left_anti")
