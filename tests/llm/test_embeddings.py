"""Whitening and clustering against plain counterparts."""

import hashlib
import math
import random

import numpy as np
import pytest

from article_warehouse.llm import clustering
from article_warehouse.llm.clustering import candidates, clustered, curve_keys
from article_warehouse.llm.vectors import merged_moments, moments_of
from article_warehouse.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, label int, x string, count string, place string, `a.b` string"
NAN, INF = float("nan"), float("inf")


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "c", "p", "q") for i, v in vectors], SCHEMA)


def random_vectors(count, length, seed=5, distinct=None):
    rng = random.Random(seed)
    made = [[rng.gauss(0.1 * k % 1, 0.2 + k % 3) for k in range(length)] for _ in range(distinct or count)]
    return [(i, made[i] if i < len(made) else rng.choice(made[:3])) for i in range(count)]


def on_grid(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening_against_one_covariance(spark, weighted):
    rows = random_vectors(400, 20, distinct=250)
    odd = [(1000, None), (1001, []), (1002, [1.0, None] * 10), (1003, [NAN] * 20), (1004, [INF] + [0.0] * 19), (1005, [1.0, 2.0])]
    found = whitened(frame(spark, rows + odd), weighted).collect()
    x = {i: on_grid(v) for i, v in rows}
    fit = list(x.values()) if weighted else [list(v) for v in {tuple(v) for v in x.values()}]
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    spread = centred.T @ centred / n
    values, axes = np.linalg.eigh(spread)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(found) == len(rows) * 16 and {r.component for r in found} == set(range(1, 17))
    sign = {}
    for r in found:
        k = r.component - 1
        expected = (np.array([n * c - s for c, s in zip(x[r.vec_id], sums, strict=True)]) / n) @ axes[:, k] / math.sqrt(values[k])
        flip = sign.setdefault(k, 1 if expected * r.whitened >= 0 else -1)
        assert r.whitened == pytest.approx(flip * expected, rel=1e-6, abs=1e-6)
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[k] / np.trace(spread), rel=1e-8)
        assert r.n == n and r.identity_error < 1e-9


def test_whitening_of_odd_tables(spark):
    assert whitened(frame(spark, [])).collect() == []
    assert whitened(frame(spark, [(1, None), (None, [])])).collect() == []
    assert whitened(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    two = whitened(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0])])).collect()
    assert sorted((str(r.vec_id), r.component, r.n, abs(round(r.whitened, 9)), r.explained) for r in two) == [
        ("1", 1, 2, 1.0, 1.0), ("1", 1, 2, 1.0, 1.0), ("None", 1, 2, 1.0, 1.0)
    ]
    # 64 * 1e15 is beyond what a squared deviation of 64 bits can hold.
    large = whitened(frame(spark, [(1, [1e15, 2.0]), (2, [-1e15, 2.0]), (3, [1e30, 2.0])])).collect()
    assert [(r.vec_id, r.deviation) for r in sorted(large)] == [(1, None), (2, None)]


def test_moments_merge_as_if_they_were_one():
    values, weights = np.random.default_rng(2).normal(3, 1, (50, 4)), np.arange(1.0, 51)
    whole = moments_of(values, weights)
    parts = [moments_of(values[a:b], weights[a:b]) for a, b in ((0, 7), (7, 8), (8, 50))]
    assert np.allclose(merged_moments(parts), whole)


def plain_clusters(rows, number, rounds, length):
    points = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    first = sorted(points, key=lambda p: (hashlib.sha256(f"2:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    centroids = [p for _, p in first[:number]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, p in points:
            groups.setdefault(nearest(p)[1], []).append(p)
        for k, group in groups.items():
            centroids[k] = [sum(column) // len(group) for column in zip(*group, strict=True)]
    found = [(i, *nearest(p)) for i, p in points]
    inertia = {k: sum(d for _, d, c in found if c == k) for k in range(number)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(repr((i, c, d, inertia[c], sum(inertia.values()), digest[c])) for i, d, c in found)


@pytest.mark.parametrize("scale", [1.0, 2e4])
def test_clustering_against_all_distances(spark, scale):
    rows = [(i, [c * scale for c in v]) for i, v in random_vectors(500, 8, distinct=300)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, rows[3][1])]
    odd = [(2000, None), (2001, [1.0]), (2002, [None] * 8), (2003, [NAN] * 8), (2004, [INF] * 8), (2005, [1e30] * 8)]
    found = clustered(frame(spark, rows + odd).repartition(3), number=12, rounds=3, length=8).collect()
    assert sorted(repr(tuple(r)) for r in found) == plain_clusters(rows, 12, 3, 8)


def test_clustering_of_few_and_no_vectors(spark):
    assert clustered(frame(spark, [])).collect() == []
    found = clustered(frame(spark, [(1, [0.5] * 64), (2, [-0.5] * 64)])).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in found) == [(1, 0, 0), (2, 0, 0)]


def test_boxes_never_lose_the_nearest():
    rng = np.random.default_rng(7)
    centroids = rng.integers(-50, 50, (20, 3))
    fewer = 0
    for _ in range(200):
        values = rng.integers(-50, 50, 3) + rng.integers(-5, 6, (10, 3))
        left = candidates(values.min(axis=0), values.max(axis=0), centroids)
        fewer += len(left) < len(centroids)
        best = ((values[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)
        assert set(best) <= set(left.tolist())
    assert fewer > 150


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 3)])
def test_neighbours_on_the_curve_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = [key.tobytes() for key in curve_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_blocks_hold_neighbours(spark):
    rng = np.random.default_rng(1)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.integers(0, 1000, (3000, 2)))], "vec_id long, point array<long>")
    boxes = clustering._blocks(points, 2).collect()
    assert sorted(i for b in boxes for i in b.vec_ids) == list(range(3000))
    assert all(len(b.vec_ids) <= clustering.BLOCK for b in boxes)
    areas = [(b.high[0] - b.low[0]) * (b.high[1] - b.low[1]) for b in boxes]
    assert sum(areas) < 4 * 1_000_000
