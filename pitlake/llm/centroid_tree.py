"""k-means over whole-number vectors: nearest centroids by a vantage-point tree, means by exact sums.

Each round the driver builds a tree over the k centroids and broadcasts it; k is a parameter, so its size is. Every
vector searches the tree best-first: the open node of the least lower bound is next, and a node stays open while its
bound is not above the best distance so far, equality included, because an equally near centroid with a smaller
number must win. The vectors of a batch are searched side by side, each with its own open nodes. Bounds are square
roots and carry a slack; distances that decide are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, mapped

LEAF = 3  # centroids of a leaf, at most
CELLS = 1 << 21  # vectors times nodes, or vectors times components, held at once
SLACK = 1e-9  # of a bound, relative; far above the error of a square root


@dataclass
class Tree:
    """A node tests its vantage point and has two children, or is a leaf of some centroids.

    members[i] holds a node's vantage point or a leaf's centroids; child[i] the numbers of its children (-1 for
    a leaf); low[i] and high[i] the least and greatest distance of each child's centroids from the vantage point.
    """

    centroids: np.ndarray
    members: list[np.ndarray]
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Whole squared distances of every vector to every centroid."""
    step = vectors[:, None, :] - centroids[None, :, :]
    return np.einsum("ijk,ijk->ij", step, step)


def build(centroids: np.ndarray) -> Tree:
    """The vantage point of a node is its centroid of the greatest distance spread, ties to the smaller number."""
    members, child, low, high = [], [], [], []

    def grow(ids: np.ndarray) -> int:
        node = len(members)
        members.append(ids)
        child.append((-1, -1))
        low.append((0.0, 0.0))
        high.append((0.0, 0.0))
        if len(ids) <= LEAF:
            return node
        near = np.sqrt(squared(centroids[ids], centroids[ids]).astype(np.float64))
        pick = int(np.argmax(near.std(axis=1)))
        rest = np.delete(np.arange(len(ids)), pick)
        rest = rest[np.argsort(near[pick, rest], kind="stable")]
        halves = rest[: len(rest) // 2], rest[len(rest) // 2 :]
        members[node] = ids[pick : pick + 1]
        low[node] = tuple(float(near[pick, half].min()) for half in halves)
        high[node] = tuple(float(near[pick, half].max()) for half in halves)
        child[node] = tuple(grow(np.sort(ids[half])) for half in halves)
        return node

    if len(centroids):
        grow(np.arange(len(centroids)))
    return Tree(centroids, members, np.array(child, np.int64).reshape(-1, 2), np.array(low).reshape(-1, 2), np.array(high).reshape(-1, 2))


def search(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; of equally near ones the smallest number."""
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    nearest = np.full(len(vectors), len(tree.centroids))
    step = max(1, CELLS // max(len(tree.members), tree.centroids.shape[1] * LEAF))
    for at in range(0, len(vectors), step):
        search_some(tree, vectors[at : at + step], best[at : at + step], nearest[at : at + step])
    return nearest, best


def search_some(tree: Tree, vectors: np.ndarray, best: np.ndarray, nearest: np.ndarray) -> None:
    bounds = np.full((len(vectors), len(tree.members)), np.inf)  # of open nodes; infinite where a node isn't open
    bounds[:, 0] = 0.0
    rows = np.arange(len(vectors))
    while len(rows):
        node = bounds[rows].argmin(axis=1)
        bound = bounds[rows, node]
        open_ = np.isfinite(bound) & (bound <= np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK) + SLACK)
        rows, node, bound = rows[open_], node[open_], bound[open_]
        bounds[rows, node] = np.inf
        for each in np.unique(node):
            here = np.flatnonzero(node == each)
            at, ids = rows[here], tree.members[each]
            distance = squared(vectors[at], tree.centroids[ids])
            least = distance.argmin(axis=1)  # members are ascending, so the first is the smallest number
            found, number = distance[np.arange(len(at)), least], ids[least]
            better = (found < best[at]) | ((found == best[at]) & (number < nearest[at]))
            best[at[better]], nearest[at[better]] = found[better], number[better]
            if tree.child[each, 0] >= 0:
                to_point = np.sqrt(distance[:, 0].astype(np.float64))
                for side in (0, 1):
                    apart = np.maximum(tree.low[each, side] - to_point, to_point - tree.high[each, side])
                    apart = np.maximum(apart - SLACK * (to_point + tree.high[each, side]), 0.0)
                    bounds[at, tree.child[each, side]] = np.maximum(bound[here], apart)


def limit_of(dimension: int) -> int:
    """Components below this give squared distances that fit a long."""
    return int(np.sqrt(2.0**62 / dimension) / 2)


def whole_vectors(batch: pa.RecordBatch, dimension: int, scale: float) -> tuple[pa.Array, np.ndarray]:
    """Ids and floor(scale * component) of a batch's vectors that have no null, non-finite or too large component."""
    values = batch.column("vector").flatten()
    numbers = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False).reshape(-1, dimension)
    with np.errstate(over="ignore", invalid="ignore"):
        cells = np.floor(numbers * scale)
        fits = (np.abs(cells) < limit_of(dimension)).all(axis=1)
    return batch.column("vec_id").filter(pa.array(fits)), cells[fits].astype(np.int64)


def vector_frame(vectors: DataFrame, dimension: int, key: str, column: str) -> DataFrame:
    """Ids and vectors of the wanted length alone, whatever else the table holds."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("vector") == dimension))


def first_centroids(rows: DataFrame, clusters: int, dimension: int, scale: float, seed: int) -> np.ndarray:
    """The vectors whose `seed:vec_id` has the smallest SHA-256; of rows with one id, those of the least components."""

    def finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = whole_vectors(batch, dimension, scale)
            yield pa.record_batch([ids, pa.array(list(cells), pa.list_(pa.int64()))], names=["vec_id", "cells"])

    # A task sends at most `clusters` rows to the driver.
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256), F.col("cells")]
    drawn = mapped(rows, finite, "vec_id long, cells array<long>").orderBy(*order).limit(clusters).collect()
    return np.array([r["cells"] for r in drawn], np.int64).reshape(-1, dimension)


def moved(rows: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of its vectors' mean; empty ones stay."""
    dimension = centroids.shape[1]
    tree = rows.sparkSession.sparkContext.broadcast(vars(build(centroids)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), dimension + 1), np.int64)
        for batch in batches:
            _, cells = whole_vectors(batch, dimension, scale)
            nearest, _ = search(Tree(**tree.value), cells)
            order = np.argsort(nearest, kind="stable")
            ids, first = np.unique(nearest[order], return_index=True)
            if len(ids):
                total[ids, 1:] += np.add.reduceat(cells[order], first, axis=0)
                total[ids, 0] += np.diff(np.append(first, len(order)))
        used = np.flatnonzero(total[:, 0])
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(list(total[used]), pa.list_(pa.int64()))], names=["cluster", "sums"])

    # A row per task and cluster; wide sums, since a cluster may hold any number of vectors.
    partial = mapped(rows, add, "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("place", "value"))
    sums = partial.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    tree.unpersist()
    wide: dict[int, dict[int, int]] = {}
    for r in sums:
        wide.setdefault(r["cluster"], {})[r["place"]] = int(r["value"])
    out = centroids.copy()
    for cluster, value in wide.items():
        out[cluster] = [value[place + 1] // value[0] for place in range(dimension)]
    return out


def cluster(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, dimension: int = 64, scale: float = 64.0, seed: int = 1,
    key: str = "vec_id", column: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids in their order.

    Kept are vectors of exactly `dimension` components, none null or non-finite. Left out are rows without an id
    and, since their squared distances don't fit a long, vectors with a component whose scaled floor is not below
    sqrt(2^62 / dimension) / 2 (134,217,728 for 64). Repeated rows are vectors of their own; fewer vectors than
    `clusters` make as many centroids as there are; an empty table gives an empty one. Other columns play no part.
    The result is a written table.
    """
    rows = vector_frame(vectors, dimension, key, column)
    centroids = first_centroids(rows, clusters, dimension, scale, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(rows, centroids, scale)
    tree = rows.sparkSession.sparkContext.broadcast(vars(build(centroids)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = whole_vectors(batch, dimension, scale)
            nearest, distance = search(Tree(**tree.value), cells) if len(cells) else (np.zeros(0), np.zeros(0))
            yield pa.record_batch([ids, pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return kept(mapped(rows, assign, "vec_id long, cluster int, distance long")), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds each cluster's and the whole sum of distances (null where it doesn't fit a long) and the centroid's digest."""
    summed = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per cluster
    inertia = {r["cluster"]: int(r["s"]) for r in summed}

    def fitting(n: int):
        return F.lit(n if n < 1 << 63 else None).cast("long")

    def per_cluster(values: list):
        return F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)

    numbers = range(len(centroids))
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    return assigned.select(
        "vec_id", "cluster", "distance",
        per_cluster([fitting(inertia.get(i, 0)) for i in numbers]).cast("long").alias("cluster_inertia"),
        fitting(sum(inertia.values())).alias("inertia"),
        per_cluster([F.lit(d) for d in digests]).cast("string").alias("centroid_sha256"),
    )
