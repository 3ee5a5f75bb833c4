"""Near-duplicate texts by the Jaccard similarity of their word n-grams, found with PartEnum signatures.

A text is its set of word shingles. Sizes fall into bands so that two sets of the wanted similarity are in the same
band or in neighbouring ones. For each such pair of bands the similarity bounds how many elements two sets may differ
in. The domain of all shingles is cut into partitions by hash, each into sub-partitions, and a set has one signature
for every partition and every subset of its sub-partitions that must agree in at least one place. Sets that are
similar enough share a signature, whatever the data; a partition that is empty in a set is no signature of it while
other partitions suffice.

Equal sets are one node from the start. Buckets of up to ``SMALL`` nodes give all their pairs to the exact check. A
larger bucket goes to the member that is in most large buckets, its centre, so that the many buckets of one group of
near copies become one group. A group is dealt out as pairs of blocks of at most ``BLOCK`` nodes; a task compares the
sets of two blocks with each other, exactly, and hands on one link from each node to the smallest of its component
there. So every two nodes that share a signature are compared, no pair is ever a row, and what leaves a task is linear
in what came in. The comparisons themselves still grow with the square of a group's size.

Node ids and shingles are 64-bit hashes of sets and of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import free_name, require, written
from .text import Words, buffers, distinct_by_row, mix, shingles, signed, slices

SMALL = 3
BLOCK = 256
BITS = 1 << 23
"""Bits of the table that tells which texts the exact check needs; its size does not depend on the data."""


@cache
def bands(percent: int, most: int) -> list[int]:
    """The smallest size of every band, up to a size."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] * 100 // percent, out[-1]) + 1)
    return out


@cache
def plan(percent: int, band: int, most: int) -> tuple[int, int, tuple[tuple[int, ...], ...], int]:
    """Partitions, sub-partitions, the subsets of them that make signatures, and how many signatures agree at least.

    Holds for two sets of a band, or of a band and the one below, that are similar enough: they differ in at most
    ``differ`` elements, so in some partition at most ``allowed`` sub-partitions differ. Where one difference is
    allowed, each further one spoils one signature more at most. Large sets have many elements in a partition, so two
    sub-partitions select well enough; small ones get three.
    """
    largest = bands(percent, most)[band + 1] - 1
    differ = 2 * largest * (100 - percent) // (100 + percent)
    if differ == 0:
        return 1, 1, ((0,),), 1
    if differ <= 2:
        return 1, differ + 2, tuple(combinations(range(differ + 2), 2)), 1
    subs = 3 if differ < 40 else 2
    parts = differ // 2 + 1
    parts += 1 + parts // 12
    return parts, subs, tuple(combinations(range(subs), subs - 1)), 2 * parts - differ


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _sets(offsets: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, where each row begins, sizes, and node ids."""
    hashes, rows = shingles(Words(offsets, data), width)
    values, first = distinct_by_row(hashes, rows, len(offsets) - 1)
    sizes = np.diff(first)
    nodes = mix(_row_sums(mix(values ^ np.uint64(0x5851F42D4C957F2D)), first) + sizes.astype(np.uint64))
    return values, first, sizes, nodes


def _signatures(values: np.ndarray, first: np.ndarray, nodes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature and node of every signature of every set."""
    sizes = np.diff(first)
    most = int(sizes.max(initial=1)) * 200 // percent + 2
    band_of = np.searchsorted(np.array(bands(percent, most)), sizes, "right") - 1
    outs: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    for own in np.unique(band_of[sizes > 0]):
        rows = np.flatnonzero((band_of == own) & (sizes > 0))
        count = sizes[rows]
        take = np.repeat(first[rows] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        elements, place = values[take], np.repeat(np.arange(len(rows)), count)
        for band in (own, own + 1):
            parts, subs, subsets, agree = plan(percent, int(band), most)
            cells = parts * subs
            cell = (mix(elements + np.uint64(int(band) * 2 + 1)) % np.uint64(cells)).astype(np.int64)
            at = place * cells + cell
            tag = mix(elements ^ np.uint64(0x2545F4914F6CDD1D))
            # Sums of 64-bit values by cell: the two halves are exact in floating point.
            low = np.bincount(at, (tag & np.uint64(0xFFFFFFFF)).astype(float), len(rows) * cells).astype(np.uint64)
            high = np.bincount(at, (tag >> np.uint64(32)).astype(float), len(rows) * cells).astype(np.uint64)
            total = (low + (high << np.uint64(32))).reshape(len(rows), parts, subs)
            held = np.bincount(at, minlength=len(rows) * cells).reshape(len(rows), parts, subs)
            value = np.zeros((len(rows), parts, len(subsets)), np.uint64)
            for k, subset in enumerate(subsets):
                for sub in subset:
                    value[:, :, k] = mix(value[:, :, k] + total[:, :, sub])
            number = np.arange(parts * len(subsets), dtype=np.uint64).reshape(1, parts, len(subsets))
            value = mix(value + number * np.uint64(0x9E3779B97F4A7C15) + np.uint64(int(band) * 0x632BE59BD9B4E019 & (2**64 - 1)))
            filled = np.stack([held[:, :, list(subset)].sum(2) > 0 for subset in subsets], axis=2)
            # As long as fewer signatures are empty than agree at least, one that agrees is not empty.
            keep = filled | ((~filled).sum((1, 2)) >= agree)[:, None, None]
            outs.append(value[keep])
            owners.append(np.broadcast_to(nodes[rows][:, None, None], keep.shape)[keep])
    if not outs:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(outs), np.concatenate(owners)


def sets(docs: DataFrame, width: int, text: str = "text", out: str = "set") -> DataFrame:
    """All rows, and a struct ``node, n`` of the id and the size of each text's set; the id of an empty one is null."""
    def run(column: pa.Array) -> pa.Array:
        offsets, data = buffers(column)
        nodes, sizes = np.zeros(len(column), np.uint64), np.zeros(len(column), np.int64)
        for a, b in slices(offsets):
            _, _, sizes[a:b], nodes[a:b] = _sets(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]], width)
        return pa.StructArray.from_arrays([pa.array(signed(nodes), mask=sizes == 0), pa.array(sizes)], names=["node", "n"])

    # Called nondeterministic so that a filter on the result does not work it out again in a second Python worker.
    return docs.withColumn(out, F.arrow_udf(run, "struct<node: bigint, n: bigint>").asNondeterministic()(F.col(f"`{text}`")))


def _buckets(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``sig, a, b``: all pairs of small buckets (sig null), and the members ``a`` of larger ones (b null)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = buffers(batch.column(0))
            seen = np.zeros(0, np.uint64)
            for a, b in slices(offsets):
                values, first, sizes, nodes = _sets(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]], width)
                # Copies within a batch are signed once.
                fresh = np.unique(nodes, return_index=True)[1]
                fresh = np.sort(fresh[(sizes[fresh] > 0) & ~np.isin(nodes[fresh], seen)])
                seen = np.append(seen, nodes[fresh])
                take = np.concatenate([values[first[r]: first[r + 1]] for r in fresh]) if len(fresh) else values[:0]
                starts = np.append(0, np.cumsum(sizes[fresh]))
                sigs, owner = _signatures(take, starts, nodes[fresh], percent)
                yield pa.RecordBatch.from_arrays([pa.array(signed(sigs)), pa.array(signed(owner))], names=["sig", "node"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, held, large = None, [], False

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["sig", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            sigs, nodes = (batch.column(k).to_numpy() for k in (0, 1))
            # Signatures that only one row has need no look, unless they meet the batch before or after.
            same = np.zeros(len(sigs), bool)
            same[1:] |= sigs[1:] == sigs[:-1]
            same[:-1] |= sigs[1:] == sigs[:-1]
            same[[0, -1]] = True
            rows: list[tuple] = []
            for s, node in zip(sigs[same].tolist(), nodes[same].tolist()):
                if s != sig:
                    if not large:
                        rows += [(None, x, y) for x, y in combinations(held, 2)]
                    sig, held, large = s, [node], False
                elif node != held[-1]:
                    if large:
                        rows.append((s, node, None))
                        held = [node]
                    else:
                        held.append(node)
                        if len(held) > SMALL:
                            rows += [(s, x, None) for x in held]
                            large = True
            if rows:
                yield out(rows)
        if held and not large and len(held) > 1:
            yield out([(None, x, y) for x, y in combinations(held, 2)])

    signed_rows = texts.mapInArrow(sign, "sig long, node long")
    return signed_rows.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(group, "sig long, a long, b long")


def _groups(members: DataFrame) -> DataFrame:
    """``centre, node``: the members of all buckets that have the same centre, the centre among them."""
    degree = members.groupBy("node").agg(F.count("*").alias("degree"))
    centre = members.join(degree, "node").groupBy("sig").agg(F.max(F.struct("degree", "node"))["node"].alias("centre"))
    return members.join(centre, "sig").select("centre", "node").distinct()


def _bodies(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, body``: one compressed text for each node that is asked for, and a few more."""
    bits = np.zeros(BITS, bool)
    # At most one row for each bit.
    bits[nodes.select(F.pmod("node", F.lit(BITS)).cast("int").alias("bit")).distinct().toArrow().column(0).to_numpy()] = True
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed).astype(bool)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            offsets, data = buffers(batch.column(0))
            for a, b in slices(offsets):
                part = data[offsets[a]: offsets[b]]
                _, _, sizes, ids = _sets(offsets[a: b + 1] - offsets[a], part, width)
                pick = np.unique(ids, return_index=True)[1]
                pick = pick[table[ids[pick] & np.uint64(BITS - 1)] & (sizes[pick] > 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(ids[pick])), pa.array([squeeze(data[offsets[a + r]: offsets[a + r + 1]]) for r in pick], pa.binary())],
                    names=["node", "body"])

    return written(texts.mapInArrow(run, "node long, body binary").join(nodes, "node", "left_semi")
                   .groupBy("node").agg(F.first("body").alias("body")))


def _opened(bodies: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sets of compressed texts: values, where each begins, and sizes."""
    expand = zstandard.ZstdDecompressor().decompress
    texts = [expand(b) for b in bodies]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = [_sets(offsets[x: y + 1] - offsets[x], data[offsets[x]: offsets[y]], width) for x, y in slices(offsets)]
    sizes = np.concatenate([f[2] for f in found])
    return np.concatenate([f[0] for f in found]), np.append(0, np.cumsum(sizes)), sizes


def _checked(pairs: DataFrame, bodies: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of some pairs ``a, b`` that are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                texts = [b for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()) for b in pair]
                values, _, sizes = _opened(texts, width)
                pair = np.repeat(np.arange(len(sizes)) // 2, sizes)
                order = np.lexsort((values, pair))
                twice = (values[order][1:] == values[order][:-1]) & (pair[order][1:] == pair[order][:-1])
                both = np.bincount(pair[order][1:][twice], minlength=batch.num_rows)
                linked = 100 * both >= percent * (sizes[0::2] + sizes[1::2] - both)
                yield batch.select(["a", "b"]).filter(pa.array(linked))

    left, right = (bodies.select(F.col("node").alias(c), F.col("body").alias(f"body_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long")


def _similar(values: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a left and a right row whose sets are similar enough."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    row, place = row[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    both = np.zeros((len(left), len(right)), np.float32)
    wide = int(shared.sum())
    for begin in range(0, wide, 4096):
        x, y = np.searchsorted(place, [begin, begin + 4096])
        table = np.zeros((len(sizes), min(4096, wide - begin)), np.float32)
        table[row[x:y], place[x:y] - begin] = 1
        both += table[left] @ table[right].T
    return np.nonzero(100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both))


def _joined(groups: DataFrame, bodies: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` that join all similar nodes of each group."""
    def work(nodes: list[int], sides: list[int], texts: list[bytes], same: bool) -> Iterator[tuple[int, int]]:
        side = np.array(sides)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        if len(nodes) < 2 or not len(left) or not len(right):
            return
        values, _, sizes = _opened(texts, width)
        i, j = _similar(values, sizes, left, right, percent)
        i, j = left[i], right[j]
        rank = np.argsort(np.argsort(nodes))
        root = rank.copy()
        while True:  # every row takes the smallest root around it until none changes
            before = root.copy()
            np.minimum.at(root, i, before[j])
            np.minimum.at(root, j, before[i])
            if (root == before).all():
                break
        ordered = sorted(nodes)
        yield from ((nodes[k], ordered[root[k]]) for k in np.flatnonzero(root != rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, ([], [], [])

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                own = tuple(batch.column(c)[k].as_py() for c in range(3))
                if own != key:
                    if key is not None:
                        found += work(*group, key[1] == key[2])
                    key, group = own, ([], [], [])
                for held, c in zip(group, (4, 3, 5)):
                    held.append(batch.column(c)[k].as_py())
            if found:
                yield out(found)
        found = list(work(*group, key[1] == key[2])) if key is not None else []
        if found:
            yield out(found)

    sizes = groups.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (groups.join(sizes, "centre").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("centre", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "node"))
    return (dealt.join(bodies, "node").select("centre", "x", "y", "side", "node", "body").repartition("centre", "x", "y")
            .sortWithinPartitions("centre", "x", "y").mapInArrow(run, "a long, b long"))


def links(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Exact links ``a, b`` between nodes that join all similar ones, for a table with one text column."""
    found = written(_buckets(texts, width, percent))
    bodies = _bodies(texts, found.select(F.explode(F.array("a", "b")).alias("node")).filter("node is not null").distinct(), width)
    pairs = found.filter(F.col("b").isNotNull()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    groups = _groups(found.filter(F.col("b").isNull()).select("sig", F.col("a").alias("node")))
    return _checked(pairs, bodies, width, percent).unionAll(_joined(written(groups), bodies, width, percent))


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of the table: id, ``n_shingles``, ``node``, ``component_id`` and ``kept``.

    Two texts are linked when the Jaccard similarity of their sets is at least ``percent`` hundredths;
    ``component_id`` is the smallest id that links reach. Equal sets are always linked; null texts and texts without
    words have an empty set and are linked with nothing. Rows without id take part, but give no component its id.
    ``kept`` marks the rows to stay: those with their component's id and the smallest node that has this id there.
    An empty table gives an empty one.
    """
    require(docs, id_col, text)
    rows = written(sets(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), width)
                   .select("id", "set.node", F.col("set.n").alias("n_shingles")))
    found = components(links(docs.select(F.col(text).alias("text")), width, percent))
    nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("id")).join(found, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"))
    first = nodes.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first"))
    # Two plain joins: nodes with their component, then rows with their node.
    named = nodes.join(first, "root").select(
        "node", F.col("first.id").alias("component_id"), F.col("first.node").alias("first_node"))
    return rows.join(named, "node", "left").select(
        F.col("id").alias(id_col), "n_shingles", "node",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("node").isNull() | ((F.col("node") == F.col("first_node")) & F.col("id").eqNullSafe(F.col("component_id")))).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of every component, with all its columns; rows without words all stay. Of repeated rows one stays."""
    ours = free_name(docs, "_set")
    stay = classes(docs, id_col, text, width, percent).filter(F.col("kept") & F.col("node").isNotNull()).select(
        F.col("node").alias("_stay_node"), F.col(id_col).alias("_stay_id")).distinct()
    keyed = sets(docs, width, text, ours)
    node = free_name(keyed, "_node")
    keyed = keyed.withColumn(node, F.col(ours)["node"]).drop(ours)
    some = keyed.join(stay, (F.col(node) == F.col("_stay_node")) & F.col(f"`{id_col}`").eqNullSafe(F.col("_stay_id")), "left_semi")
    return some.dropDuplicates([node]).unionByName(keyed.filter(F.col(node).isNull())).drop(node)
