"""Clustering by a vantage-point tree against plain search over odd little tables."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlake.llm import centroid_tree

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, vector string, cells int"


def brute(rows, clusters, rounds, dimension, scale, seed):
    kept = []
    for i, x in rows:
        if i is None or x is None or len(x) != dimension or any(c is None or not math.isfinite(c) for c in x):
            continue
        cells = [math.floor(scale * c) for c in x]
        if max(map(abs, cells)) < centroid_tree.limit_of(dimension):
            kept.append((i, cells))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [cells for _, cells in order[:clusters]]

    def nearest(cells):
        return min((sum((a - b) ** 2 for a, b in zip(cells, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, cells in kept:
            members.setdefault(nearest(cells)[1], []).append(cells)
        for k, rows_ in members.items():
            centroids[k] = [sum(column) // len(rows_) for column in zip(*rows_, strict=True)]
    out = []
    for i, cells in kept:
        distance, k = nearest(cells)
        out.append((i, k, distance, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()))
    inertia = {k: sum(r[2] for r in out if r[1] == k) for k in {r[1] for r in out}}
    whole = sum(inertia.values())
    return sorted((i, k, d, inertia[k], whole, digest) for i, k, d, digest in out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 1, "clash", "clash", 2) for i, x in rows], SCHEMA)


def found(spark, rows, **options):
    result = centroid_tree.with_inertia(*centroid_tree.cluster(frame(spark, rows), **options))
    return sorted(tuple(r) for r in result.collect())


def grid(n, dimension, step):
    """Vectors on a coarse grid, so that equal distances are common."""
    rng = np.random.default_rng(n)
    return [(i, (rng.integers(-3, 4, dimension) * step).tolist()) for i in range(n)]


ODD = [
    (1, [0.5, 0.25]), (2, None), (3, []), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, [None, 1.0]), (7, [math.nan, 1.0]), (8, [math.inf, 0.0]),
    (None, [0.0, 0.0]), (9, [0.5, 0.25]), (9, [0.5, 0.25]), (9, [-7.0, 1e-9]), (10, [1e300, 0.0]), (11, [-1e18, 0.0]), (12, [-0.001, -0.999]),
]


@pytest.mark.parametrize("clusters", [1, 2, 4, 16])
@pytest.mark.parametrize("rows", [[], ODD, grid(90, 2, 0.5)], ids=["empty", "odd", "grid"])
def test_against_plain_search(spark, rows, clusters):
    options = {"clusters": clusters, "rounds": 3, "dimension": 2, "scale": 4.0, "seed": 1}
    assert found(spark, rows, **options) == brute(rows, **options)


def test_more_dimensions_and_a_very_common_vector(spark):
    rows = grid(300, 8, 0.25) + [(1000 + i, [0.25] * 8) for i in range(150)]
    options = {"clusters": 16, "rounds": 3, "dimension": 8, "scale": 64.0, "seed": 1}
    assert found(spark, rows, **options) == brute(rows, **options)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(1, 3), st.integers(0, 10**6))
def test_search_is_exact(clusters, dimension, spread, seed):
    """Ties and repeated centroids included: the smallest number of the least distance."""
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-spread, spread + 1, (clusters, dimension)), rng.integers(-spread, spread + 1, (70, dimension))
    distance = centroid_tree.squared(vectors, centroids)
    nearest, best = centroid_tree.search(centroid_tree.build(centroids), vectors)
    assert (nearest == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()


def test_search_prunes():
    """Well-separated centroids: a vector beside one of 256 meets few of them."""
    rng = np.random.default_rng(5)
    centroids = rng.integers(-(10**6), 10**6, (256, 2))
    tree, met = centroid_tree.build(centroids), 0
    plain = centroid_tree.squared

    def counted(vectors, some):
        nonlocal met
        met += len(vectors) * len(some)
        return plain(vectors, some)

    centroid_tree.squared = counted
    try:
        centroid_tree.search(tree, centroids + 1)
    finally:
        centroid_tree.squared = plain
    assert met < 256 * 64
