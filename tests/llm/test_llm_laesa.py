import hashlib

import numpy as np
import pytest

from wardflow.llm import laesa

SCHEMA = "id long, vector array<int>, cluster string"


def brute(rows, k, rounds, seed="0"):
    """Lloyd's rounds over (id, vector), plainly."""
    held = [(i, v) for i, v in rows if v is not None and None not in v]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in held if i is not None)[:k]
    points = [list(v) for _, v in first]
    if not points:
        return [], []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in held:
            groups.setdefault(near(v)[1], []).append(v)
        for c, vs in groups.items():
            points[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return points, sorted(((i, near(v)[1], near(v)[0]) for i, v in held), key=str)


def check(spark, rows, k, rounds):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)
    found = laesa.cluster(df, k, rounds)
    points, expected = brute(rows, k, rounds)
    assert found.rows.columns == ["id", "cluster", "distance"]
    assert found.centroids == points
    assert sorted((tuple(r) for r in found.rows.collect()), key=str) == expected
    return found


def test_equal_to_plain_rounds_and_prunes(spark):
    rng = np.random.default_rng(5)
    homes = rng.integers(-5000, 5000, (8, 16))
    rows = [(i, (homes[i % 8] + rng.integers(-300, 300, 16)).tolist()) for i in range(600)]
    found = check(spark, rows, 8, 4)
    # Well separated groups: most centroids are ruled out by the pivots alone.
    assert max(found.measured) < 600 * 8 / 2


def test_ties_nulls_repeats_and_negative_sums(spark):
    rows = [(i, [(-1) ** i * (i % 3), -(i % 2)]) for i in range(40)] * 2
    rows += [(None, [1, 1]), (100, None), (101, [None, 2]), (7, [0, 0]), (7, [0, 0])]
    check(spark, rows, 5, 6)


def test_fewer_vectors_than_centroids_and_none(spark):
    check(spark, [(1, [4, 4]), (2, [5, 5])], 8, 3)
    check(spark, [(1, [4, 4])], 8, 0)
    check(spark, [], 8, 3)
    check(spark, [(None, [1, 2]), (3, None)], 8, 3)


def test_bounds_hold_for_large_components():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-laesa.MOST, laesa.MOST, (300, 64)).astype(np.int64)
    vectors[150:] = vectors[:150] + rng.integers(0, 2, (150, 64))
    points, pivots = vectors[:40] + 1, vectors[40:50]
    root = lambda a, b: np.sqrt(laesa.squared(a, b))
    best, distance, _ = laesa.nearest(vectors, root(vectors, pivots), points, root(points, pivots))
    exact = laesa.squared(vectors, points)
    assert (best == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        laesa.cluster(spark.createDataFrame([(1, [laesa.MOST + 1], "x")], SCHEMA), 2, 1)
