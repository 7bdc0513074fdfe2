import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from fleethazard.llm.clustering import LIMIT, candidates, cluster_vectors, hilbert_keys, nearest

NAN, INF = float("nan"), float("inf")


def brute(rows, k, rounds, dims, scale=64):
    """Every vector against every centroid, in Python integers."""
    kept = [(i, [max(-LIMIT, min(LIMIT, math.floor(scale * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        return [(f.index(min(f)), min(f)) for f in far]

    for _ in range(rounds):
        home = [c for c, _ in assign()]
        for c in set(home):
            own = [v for (_, v), h in zip(kept, home) if h == c]
            centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    done = assign()
    total = Counter()
    for c, d in done:
        total[c] += d
    return [(i, c, d, total[c], sum(total.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for (i, _), (c, d) in zip(kept, done)]


def vectors(spark, rows):
    full = [(i, v, "x", 3, 0.5) for i, v in rows]
    df = spark.createDataFrame(full, "vec_id long, embedding array<double>, cluster string, n int, distance double")
    return df.repartition(3) if rows else df


def result(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_equals_brute_force(spark, block_rows):
    rng = random.Random(4)
    heart = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(heart)]) for i in range(400)]
    rows += [(1000 + i, heart[0]) for i in range(300)]  # copies: a third of all rows and more
    got = result(cluster_vectors(vectors(spark, rows), k=6, dims=8, block_rows=block_rows))
    assert got == Counter(brute(rows, 6, 3, 8))


def test_odd_rows(spark):
    one = [0.5, -0.25, 0.0, 1.0]
    rows = [(1, one), (1, one), (None, one), (None, [9.0] * 4), (2, None), (3, []), (4, [1.0] * 3), (5, [1.0, None, 1.0, 1.0]), (6, [NAN, 0.0, 0.0, 0.0]),
            (7, [INF, 0.0, 0.0, 0.0]), (8, [1e300, -1e300, 0.0, 0.0]), (9, [-0.001] * 4), (10, [3e9, 0.0, 0.0, 0.0])]
    got = result(cluster_vectors(vectors(spark, rows), k=3, dims=4))
    assert got == Counter(brute(rows, 3, 3, 4))
    assert sum(got.values()) == 7
    assert not result(cluster_vectors(vectors(spark, []), dims=4)) and not result(cluster_vectors(vectors(spark, rows[4:8]), dims=4))
    few = rows[:2] + rows[11:12]  # fewer vectors than centroids, and ties between equal centroids
    assert result(cluster_vectors(vectors(spark, few), k=16, dims=4)) == Counter(brute(few, 16, 3, 4))


def test_curve_visits_neighbours():
    """All cells once, and each step of the curve changes one coordinate by one."""
    for dims, bits in ((2, 4), (3, 2), (5, 1)):
        grid = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_keep_every_nearest_centroid():
    rng = np.random.default_rng(5)
    pruned = 0
    for _ in range(200):
        cells = rng.integers(-9, 9, (20, 3)) + rng.integers(-40, 40, 3)
        centroids = rng.integers(-50, 50, (12, 3))
        among = candidates(cells.min(axis=0), cells.max(axis=0), centroids)
        assert [a.tolist() for a in nearest(cells, centroids, among)] == [a.tolist() for a in nearest(cells, centroids, np.arange(12))]
        pruned += 12 - len(among)
    assert pruned > 1000
    big = np.array([[LIMIT, -LIMIT]]), np.array([[-LIMIT, LIMIT], [LIMIT, LIMIT - 1]])
    assert [int(x[0]) for x in nearest(*big, np.arange(2))] == [1, (2 * LIMIT - 1) ** 2]
