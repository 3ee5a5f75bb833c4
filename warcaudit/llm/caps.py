"""Near-duplicate vectors by cosine, found with spherical-cap filters.

A filter is a direction with a cap around it. Directions are structured: a random rotation is cut into two halves,
each half has a code of random unit vectors, and every combination of a code word from either half is a direction; a
few such product codes are used, each with its own rotation. A vector belongs in each code to the ``LISTED``
directions nearest to it: its caps are all that exceed the height which it itself sets there, so no vector has too few
of them or too many. They are listed without going through all directions: the best sums of two halves are sums of the
best of each half. Vectors that meet in a filter are compared, by cosine in double precision.

Bit-equal vectors are one node from the start. A filter with many nodes is dealt out as pairs of blocks of at most
``BLOCK`` nodes, so no task holds more than two of them. Within a task pairs are only counted, each in the smallest
filter that its two nodes share, and handed on as links from each node to the smallest of its component there: what
leaves a task is linear in what came in. How many code words there are follows the number of nodes, so that filters
do not fill up as the table grows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import require, written

CODES = 6
LISTED = 4
"""Directions that a vector belongs to in each code."""
BLOCK = 1024
SEED = 7_907


def code_words(nodes: int) -> int:
    """Code words of a half: one direction of each code for four nodes."""
    return min(max(math.ceil(math.sqrt(nodes / 4)), 32), 2048)


class Filters:
    """The directions for vectors of one length."""

    def __init__(self, length: int, words: int) -> None:
        rng = np.random.Generator(np.random.PCG64([SEED, length, words]))
        self.words, self.part = words, -(-length // 2)
        full = 2 * self.part
        self.rotation = np.stack([np.linalg.qr(rng.standard_normal((full, full)))[0][:length] for _ in range(CODES)])
        code = rng.standard_normal((CODES, 2, self.part, words))
        self.code = code / np.linalg.norm(code, axis=2, keepdims=True)

    def of(self, unit: np.ndarray) -> np.ndarray:
        """For each unit vector a row with the sorted numbers of its filters."""
        out = []
        for k in range(CODES):
            halves = (unit @ self.rotation[k]).reshape(len(unit), 2, self.part)
            best, value = [], []
            for h in range(2):
                products = halves[:, h] @ self.code[k, h]
                top = np.argpartition(-products, LISTED - 1, axis=1)[:, :LISTED]
                best.append(top)
                value.append(np.take_along_axis(products, top, 1))
            sums = (value[0][:, :, None] + value[1][:, None, :]).reshape(len(unit), -1)
            pick = np.argpartition(-sums, LISTED - 1, axis=1)[:, :LISTED]
            left = np.take_along_axis(best[0], pick // LISTED, 1)
            right = np.take_along_axis(best[1], pick % LISTED, 1)
            out.append((k * self.words + left) * self.words + right)
        return np.sort(np.concatenate(out, axis=1), axis=1)


@cache
def filters(length: int, words: int) -> Filters:
    return Filters(length, words)


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _digests(column: pa.Array) -> pa.Array:
    """Digest of each vector; null for one that is null, empty, zero, or holds null or non-finite components."""
    out = []
    for v in column:
        key = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            if np.isfinite(x).all() and x.any():
                key = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
        out.append(key)
    return pa.array(out, pa.binary())


def _listed(nodes: DataFrame, words: int, with_vectors: bool) -> DataFrame:
    """A row for each node and filter; with vectors also the node's weight, vector and all its filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                vectors = [np.asarray(v, np.float64) for v in part.column("vector").to_pylist()]
                found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(vectors)
                for length in {len(v) for v in vectors}:
                    rows = [k for k, v in enumerate(vectors) if len(v) == length]
                    for k, f in zip(rows, filters(length, words).of(_unit(np.stack([vectors[k] for k in rows])))):
                        # Vectors of another length are never met.
                        found[k] = f + (length << 32)
                counts = [len(f) for f in found]
                at = pa.array(np.repeat(np.arange(len(vectors)), counts))
                columns = {"filter": pa.array(np.concatenate(found))}
                if with_vectors:
                    columns |= {c: part.column(c).take(at) for c in ("node", "weight", "vector")}
                    columns["filters"] = pa.array([f.tobytes() for f in found], pa.binary()).take(at)
                yield pa.RecordBatch.from_pydict(columns)

    schema = "filter long"
    if with_vectors:
        schema += f", node {nodes.schema['node'].dataType.simpleString()}, weight long, vector {nodes.schema['vector'].dataType.simpleString()}, filters binary"
    return nodes.mapInArrow(run, schema)


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that two rows of sorted, padded numbers share, for each pair of rows; -1 where there is none."""
    out = np.full(len(a), -1)
    left = np.arange(len(a))
    for c in range(a.shape[1]):
        hit = (b[left] == a[left, c][:, None]).any(1) & (a[left, c] >= 0)
        out[left[hit]] = a[left[hit], c]
        left = left[~hit]
        if not len(left):
            break
    return out


def _linked(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    rows, columns = np.nonzero(a @ b.T >= least)
    if same:
        keep = rows < columns
        rows, columns = rows[keep], columns[keep]
    return rows, columns


def _compare(filter_: int, sides: np.ndarray, same: bool, weight: np.ndarray, unit: np.ndarray, lists: np.ndarray,
             least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links counted for each row, and each row's smallest linked row, within one pair of blocks."""
    left, right = (np.flatnonzero(sides == s) for s in (0, 0 if same else 1))
    links, root = np.zeros(len(sides), np.int64), np.arange(len(sides))
    if not len(left) or not len(right):
        return links, root
    i, j = _linked(unit[left], unit[right], least, same)
    i, j = left[i], right[j]
    for begin in range(0, len(i), 1 << 16):
        x, y = i[begin: begin + (1 << 16)], j[begin: begin + (1 << 16)]
        here = _first_common(lists[x], lists[y]) == filter_
        np.add.at(links, x[here], weight[y[here]])
        np.add.at(links, y[here], weight[x[here]])
    while len(i):  # every row takes the smallest root around it until none changes
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        root = root[root]
        if (root == before).all():
            break
    return links, root


def _within(rows: DataFrame, least: float) -> DataFrame:
    """``node, links, root`` for nodes that are linked within a pair of blocks; rows come sorted by pair of blocks."""
    def work(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        """Results of all groups of a table of whole groups."""
        batch = table.combine_chunks().to_batches()[0]
        key = np.column_stack([batch.column(c).to_numpy() for c in ("filter", "x", "y")])
        side, node, weight = (batch.column(c).to_numpy() for c in ("side", "node", "weight"))
        vectors, filters_ = batch.column("vector"), batch.column("filters")
        place, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
        lists = np.frombuffer(b"".join(filters_.to_pylist()), np.int64).reshape(len(node), -1)
        edges = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1))), len(node))
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            if b - a < 2:
                continue
            order = a + np.argsort(node[a:b])
            matrix = flat[place[a]: place[b]].reshape(b - a, -1).astype(np.float64)[order - a]
            links, root = _compare(key[a, 0], side[order], key[a, 1] == key[a, 2], weight[order], _unit(matrix), lists[order], least)
            some = np.flatnonzero((links > 0) | (root != np.arange(b - a)))
            if len(some):
                yield node[order][some], links[some], node[order][root[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []

        def out(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["node", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(c).to_numpy() for c in ("filter", "x", "y")])
            last = int(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))[-1])  # the last group may go on
            goes_on = last == 0 and bool(pending) and all(
                pending[-1].column(c)[-1].as_py() == v for c, v in zip(("filter", "x", "y"), key[0].tolist()))
            if not goes_on:
                whole = [*pending, batch.slice(0, last)]
                found = list(work(pa.Table.from_batches(whole))) if sum(b.num_rows for b in whole) else []
                if found:
                    yield out(found)
                pending = []
            pending.append(batch.slice(last))
        found = list(work(pa.Table.from_batches(pending))) if pending else []
        if found:
            yield out(found)

    return rows.mapInArrow(run, "node long, links long, root long")


def near(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = 0.9,
         words: int | None = None) -> DataFrame:
    """One row for each row of the table: id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other ids linked directly, ``component_id`` is the smallest id that links reach. A vector
    that is null, empty, zero, or holds null or non-finite components is linked with nothing, nor is one of another
    length or a row without id. Rows with the same id are one vector with the links of all. An empty table gives an
    empty one. Every link that is reported has been verified; which are found depends on the filters (the recall is
    measured in the tests).
    """
    require(vectors, id_col, vector)
    rows = written(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector"))
                   .withColumn("key", F.arrow_udf(_digests, "binary")("vector")))
    valid = rows.filter(F.col("key").isNotNull() & F.col("id").isNotNull())
    nodes = written(valid.groupBy("key", "id").agg(F.first("vector").alias("vector")).groupBy("key").agg(
        F.min("id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector")))
    words = words or code_words(nodes.count())
    sizes = _listed(nodes, words, False).groupBy("filter").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("filter").alias("of_filter"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    listed = _listed(nodes, words, True).join(sizes, F.col("filter") == F.col("of_filter"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (listed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("filter", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "weight", "vector", "filters"))
    found = written(_within(dealt.repartition("filter", "x", "y").sortWithinPartitions("filter", "x", "y"), least))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (nodes.select("key", "node", "weight").join(counted, "node", "left").join(joined, "node", "left")
             .select(F.col("key").alias("of_key"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                     F.coalesce("root", "node").alias("root")))
    return rows.join(named, (F.col("key") == F.col("of_key")) & F.col("id").isNotNull(), "left").select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"), F.coalesce("root", "id").eqNullSafe(F.col("id")).alias("kept"))
