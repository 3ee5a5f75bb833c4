"""Clusters of vectors around centroids, in whole numbers, found through a vantage-point tree.

Vectors become whole numbers, so that distances, sums and ties are exact and every machine gets the same clusters.
Each round builds a tree over the centroids on the driver and broadcasts it: its size is that of the centroids, a
parameter. Every vector searches it best-first: of its open nodes the one with the least possible distance comes next,
and a node is left out only if nothing in it can be as near as the nearest centroid so far; one that may be exactly as
near is searched, so that the smaller number wins ties. Tasks send sums by cluster, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import require, written

SCALE = 64
LARGEST = 1 << 27
"""Scaled components beyond this stop the job: squared distances of 64 of them would not fit 64 bits."""
LEAF = 4
"""Centroids that a node of the tree holds without being divided."""
OPEN_NODES = 1 << 20
"""Bounds of open nodes that are held at once, over all vectors that search together."""

RESULT = "{ident}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number vectors to one of them."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


class VantageTree:
    """Nodes over centroids: a vantage centroid and two children, or the few centroids of a leaf.

    Of each child the least and greatest distance of its centroids to the vantage centroid are kept.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.members: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        self._divide(np.arange(len(centroids)))

    def _divide(self, members: np.ndarray) -> int:
        node = len(self.members)
        self.members.append(members)
        self.children.append([])
        if len(members) > LEAF:
            vantage, others = members[:1], members[1:]
            away = squared(self.centroids[others], self.centroids[vantage[0]])
            order = np.argsort(away, kind="stable")
            self.members[node] = vantage
            for part in np.array_split(order, 2):
                low, high = np.sqrt(away[part].min()), np.sqrt(away[part].max())
                self.children[node].append((self._divide(np.sort(others[part])), float(low), float(high)))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector; of equally near ones the smallest number."""
        step = max(1, OPEN_NODES // len(self.members))
        found = [self._search(vectors[k: k + step]) for k in range(0, len(vectors), step)]
        return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (
            np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = np.full(len(vectors), len(self.centroids))
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        bounds = np.full((len(vectors), len(self.members)), np.inf)
        bounds[:, 0] = 0
        rows = np.arange(len(vectors))
        while len(rows):
            nodes = bounds[rows].argmin(axis=1)
            least = bounds[rows, nodes]
            # Inclusive: what may be just as near is still searched.
            near = least <= np.sqrt(best[rows])
            rows, nodes, least = rows[near], nodes[near], least[near]
            bounds[rows, nodes] = np.inf
            for node in np.unique(nodes):
                here = nodes == node
                self._visit(node, rows[here], least[here], vectors, number, best, bounds)
        return number, best

    def _visit(self, node, rows, least, vectors, number, best, bounds) -> None:
        for member in self.members[node]:
            away = squared(vectors[rows], self.centroids[member])
            better = (away < best[rows]) | ((away == best[rows]) & (member < number[rows]))
            best[rows[better]], number[rows[better]] = away[better], member
        for child, low, high in self.children[node]:
            # The one member is the vantage centroid. Roots are rounded, so bounds give way by more than that.
            root = np.sqrt(away)
            bounds[rows, child] = np.maximum(least, np.maximum(root - high, low - root) - 1e-12 * (root + high))


def whole_numbers(vectors: DataFrame, ident: str, vector: str, dimensions: int) -> DataFrame:
    """Vectors with so many components, none null or not finite, as whole numbers: ``ident, vector``."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c.cast("double")))
    scaled = F.transform(x, lambda c: F.floor(F.when(F.abs(c.cast("double")) * SCALE < LARGEST, c.cast("double") * SCALE).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("double"))).cast("int"))
    kept = vectors.filter(F.coalesce(F.size(x) == dimensions, F.lit(False)) & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(ident), scaled.alias("vector"))


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def _sums(rows: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors of each cluster, exact, and their number: one row a cluster and task, added up by Spark."""
    tree = rows.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _matrix(batch, dimensions)
            number, _ = tree.value.nearest(vectors)
            np.add.at(totals, number, vectors)
            sizes += np.bincount(number, minlength=k)
        filled = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()), pa.array([[*totals[c], sizes[c]] for c in filled], pa.list_(pa.int64()))], names=["cluster", "sums"])

    exact = (rows.mapInArrow(run, "cluster int, sums array<bigint>").select("cluster", F.posexplode("sums").alias("place", "part"))
             .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total")).collect())
    tree.unpersist()
    totals = np.zeros((k, dimensions + 1), object)
    for r in exact:
        totals[r.cluster, r.place] = int(r.total)
    return totals[:, :-1], totals[:, -1]


def starts(rows: DataFrame, ident: str, k: int, seed: int) -> list[list[int]]:
    """The first ``k`` vectors by the hash of seed and id; rows without id are never among them."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")).cast("binary"), 256)
    return [r.vector for r in rows.filter(F.col(ident).isNotNull()).select(order.alias("hash"), "vector").orderBy("hash", "vector").limit(k).collect()]


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, seed: int = 1,
            ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Cluster, squared distance and centroid of every vector after so many rounds, and the inertia of its cluster and of all.

    Vectors that are null, have another number of components, or hold null or non-finite ones are left out. Repeated
    rows count as often as they occur; a centroid that equals a smaller one gets no vectors and stays. With fewer
    than ``k`` vectors that have an id there are fewer centroids, with none the result is empty. Other columns are
    not looked at, whatever their names. Of the data only ``k`` centroids and their sums ever reach the driver.
    """
    require(vectors, ident, vector)
    spark = vectors.sparkSession
    id_type = vectors.schema[ident].dataType.simpleString()
    rows = written(whole_numbers(vectors, ident, vector, dimensions), "vectors")
    first = starts(rows, ident, k, seed)
    if not first:
        return spark.createDataFrame([], RESULT.format(ident=f"`{ident}` {id_type}"))
    centroids = np.array(first, np.int64)
    for _ in range(rounds):
        totals, sizes = _sums(rows, centroids)
        filled = np.flatnonzero(sizes)
        centroids = centroids.copy()
        # Whole-number division rounds down.
        centroids[filled] = (totals[filled] // sizes[filled, None]).astype(np.int64)
    tree = spark.sparkContext.broadcast(VantageTree(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, away = tree.value.nearest(_matrix(batch, dimensions))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(away, pa.int64())],
                                             names=[ident, "cluster", "distance"])

    placed = written(rows.mapInArrow(run, f"`{ident}` {id_type}, cluster int, distance bigint"), "placed")
    return _with_inertia(placed, centroids, ident)


def _with_inertia(placed: DataFrame, centroids: np.ndarray, ident: str) -> DataFrame:
    """Join each row to its cluster's sums: one row for each centroid."""
    spark = placed.sparkSession
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    whole = sum(sums.values())
    about = spark.createDataFrame([(int(c), int(total), int(whole), [int(x) for x in centroids[c]]) for c, total in sums.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return placed.join(F.broadcast(about), "cluster").select(ident, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: Column) -> Column:
    """SHA-256 of the components in decimal, joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ",").cast("binary"), 256)
