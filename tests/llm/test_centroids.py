import hashlib
import random

import numpy as np
import pytest

from trailmill.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cluster string, n string, c string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z", "c") for i, v in rows], SCHEMA)


def brute(rows, k, rounds, width, scale, seed):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    points = [v for _, v in sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for c, members in groups.items():
            points[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *near(v)) for i, v in kept]
    own = {}
    for _, d, c in found:
        own[c] = own.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, own[c], sum(own.values()), sha[c]) for i, d, c in found), key=str)


@pytest.mark.parametrize(("k", "width"), [(8, 5), (3, 2), (25, 5)])
def test_equal_to_brute_force(spark, k, width):
    rnd = random.Random(k)
    rows = [(i, [rnd.choice([0.0, 0.5, -0.25, rnd.gauss(i % 4, 0.2)]) for _ in range(width)]) for i in range(300)]
    rows += [(400, None), (401, [1.0] * (width + 1)), (402, [None] * width), (403, [float("nan")] * width), (404, []), (None, [0.125] * width), (3, rows[5][1]), rows[7], rows[7]]
    rows += [(500 + i, [0.5] * width) for i in range(20)]
    found = centroids.clustered(frame(spark, rows), k, 4, width, 1024.0, 3).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, k, 4, width, 1024.0, 3)


def test_few_and_no_vectors(spark):
    assert centroids.clustered(frame(spark, []), 8, 3, 2, 1024.0, 3).count() == 0
    rows = [(1, [0.5, 0.5]), (2, [0.25, 1.0])]
    assert sorted(map(tuple, centroids.clustered(frame(spark, rows), 8, 3, 2, 1024.0, 3).collect())) == brute(rows, 8, 3, 2, 1024.0, 3)


def test_tree_search_is_exact_and_leaves_nodes_out():
    rnd = np.random.default_rng(4)
    for k, width, reach in ((1, 3, 5), (8, 2, 3), (40, 3, 1_000), (64, 4, 10**7)):
        points = rnd.integers(-reach, reach, (k, width))
        points[k // 2] = points[0]  # a tie everywhere
        rows = np.concatenate([rnd.integers(-reach, reach, (500, width)), points])
        tree = centroids.vantage_tree(points)
        number, best, measured = centroids.nearest(rows, points, tree)
        every = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
        assert (best == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
        assert sorted(tree.point.tolist()) == list(range(k))
        if k >= 40:
            assert measured < 0.75 * len(rows) * k
