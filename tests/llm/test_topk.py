import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmill.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block string, score string"


def brute(rows, k, asked):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for at, (q, vector) in enumerate(usable):
        if q % asked == 0:
            scores = sorted((-sum(a * b for a, b in zip(vector, w)), i) for j, (i, w) in enumerate(usable) if j != at)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 8_192])
def test_equal_to_brute_force(spark, block):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, 0.0, 0.25, -0.5, rnd.uniform(-1, 1)]) for _ in range(6)]) for i in range(40)]
    rows += [(40, None), (41, [1.0, None]), (42, [float("nan")] * 6), (43, [float("inf")] * 6), (None, [1.0] * 6), (44, []), (45, [1.0, 2.0]), (46, [0.0] * 6)]
    rows += [rows[0], rows[0], (1, [5.0] * 6), (47, rows[2][1]), (48, rows[2][1]), (49, rows[2][1])]
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA)
    found = topk.top_k(df, F.col("vec_id") % 5 == 0, 4, block=block).collect()
    assert sorted(map(tuple, found)) == brute(rows, 4, 5)


def test_few_and_no_candidates(spark):
    one = spark.createDataFrame([(0, [1.0], 1, "x", "y", "z")], SCHEMA)
    assert topk.top_k(one, F.lit(True), 5).count() == 0
    assert topk.top_k(one.where("false"), F.lit(True), 5).count() == 0
    two = one.union(spark.createDataFrame([(1, [0.5], 1, "x", "y", "z")], SCHEMA))
    assert sorted(map(tuple, topk.top_k(two, F.lit(True), 5).collect())) == [(0, 1, 1, 256 * 128), (1, 1, 0, 256 * 128)]


def test_queries_in_several_blocks(spark, monkeypatch):
    from trailmill.llm import vectors

    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA)
    numbered = vectors.with_blocks
    monkeypatch.setattr(topk, "with_blocks", lambda q, name: numbered(q, name, 3))
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, 4, block=7).collect())) == brute(rows, 4, 5)
